"""Quality classifier: a sparse rule ensemble over text statistics.

A forest of shallow trees is grown on the labelled rows; every path from a root to a node becomes
a conjunctive rule, a lasso logistic regression weights the rules, and the rules with a weight
are compiled into one Spark column. Statistics are DataFrame expressions, training is pyspark.ml.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import SPACE_CLASS, fresh, remainder, stored
from alertlake.llm.quality_rules import SPACES, STOP_WORDS

FOLDS = 5
CUT = 0.3
#: Labelled rows that are trained on, at most in the mean: beyond it rows are chosen by a hash of their id.
MAX_TRAINING_ROWS = 200_000
TREES, DEPTH, SEED = 24, 3, 7
PENALTY = 0.001

STATISTICS = (
    "log_words",
    "mean_word",
    "symbol_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "distinct_share",
    "neighbour_share",
    "stop_share",
    "line_words",
    "duplicate_lines",
)


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of the STATISTICS as doubles, and its name. Null counts as empty text.

    All are finite; texts without words have zeros.
    """
    parts, name = fresh(docs.columns, "text_parts"), fresh(docs.columns, "statistics")
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    left = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    cut = F.struct(
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE_CLASS}+")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        left(r"[^#*$%&|<>@^~{}\[\]\\_=+]+").alias("symbols"),
        left(r"[^A-ZÀ-ÖØ-Þ]+").alias("upper"),
        left(r"[^0-9]+").alias("digits"),
        left(r"[^!?]+").alias("marks"),
    )
    p = F.col(parts)
    words, n = p["words"], F.greatest(F.size(p["words"]), F.lit(1)).cast("double")
    chars = F.length(F.concat_ws("", words))
    n_chars = F.greatest(chars, F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(p["lines"]), F.lit(1)).cast("double")
    known = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    made = {
        "log_words": F.log1p(F.size(words).cast("double")),
        "mean_word": chars / n,
        "symbol_share": p["symbols"] / n,
        "upper_share": p["upper"] / n_chars,
        "digit_share": p["digits"] / n_chars,
        "mark_share": p["marks"] / n,
        "distinct_share": F.size(F.array_distinct(words)) / n,
        "neighbour_share": F.size(F.filter(words, lambda w, i: (i > 0) & (F.get(words, i - 1) == w))) / n,
        "stop_share": F.size(F.filter(words, lambda w: w.isin(known))) / n,
        "line_words": F.size(words) / n_lines,
        "duplicate_lines": (F.size(p["lines"]) - F.size(F.array_distinct(p["lines"]))) / n_lines,
    }
    out = docs.withColumn(parts, cut)
    # Exploding one struct keeps Catalyst from copying the statistics into every rule of a filter.
    one = F.array(F.struct(*(made[x].cast("double").alias(x) for x in STATISTICS)))
    return out.select("*", F.explode(one).alias(name)).drop(parts), name


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    limit: float

    def holds(self, at: Column) -> Column:
        return at[self.statistic] > self.limit if self.above else at[self.statistic] <= self.limit


Rule = tuple[Condition, ...]


def rule_holds(rule: Rule, at: Column) -> Column:
    return reduce(lambda a, b: a & b, (c.holds(at) for c in rule))


def tree_paths(model) -> list[Rule]:
    """The conjunction that leads to each node of each tree, every one once, in a fixed order."""
    found: dict[Rule, None] = {}

    def walk(node, path: Rule) -> None:
        if path:
            found[tuple(sorted(set(path), key=lambda c: (c.statistic, c.above, c.limit)))] = None
        if node.numDescendants() > 0:
            split = node.split()
            name, limit = STATISTICS[split.featureIndex()], split.threshold()
            walk(node.leftChild(), (*path, Condition(name, False, limit)))
            walk(node.rightChild(), (*path, Condition(name, True, limit)))

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), ())
    return list(found)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``score`` is the chance of label 1."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, statistics: str) -> Column:
        at = F.col(statistics)
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule_holds(rule, at), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(training: DataFrame, statistics: str = "statistics", label: str = "label") -> RuleModel:
    """A model of the rows of ``training``; without both labels, the constant share of label 1."""
    at = F.col(statistics)
    training = training.select(F.col(label).cast("double").alias("label"), *(at[x].alias(x) for x in STATISTICS))
    n, ones = training.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = ones / n if n else 0.5
        return RuleModel({0.0: -30.0, 1.0: 30.0}.get(share, 0.0), ())
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(training)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, featureSubsetStrategy="sqrt", labelCol="label"
    ).fit(rows.select("label", "features"))
    rules = tree_paths(forest)
    if not rules:
        return RuleModel(_logit(ones / n), ())
    flat = F.struct(*(F.col(x) for x in STATISTICS))
    fired = rows.withColumn("at", flat).select(
        "label",
        array_to_vector(F.array(*(rule_holds(r, F.col("at")).cast("double") for r in rules))).alias("features"),
    )
    lasso = LogisticRegression(
        regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False, labelCol="label"
    ).fit(fired)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w != 0.0]
    return RuleModel(float(lasso.intercept), tuple(weights))


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def training_labels(labels: DataFrame, id_col: str = "doc_id", target: str = "quality") -> DataFrame:
    """(labelled, label) of the ids that are not held out, MAX_TRAINING_ROWS at most in the mean.

    Null labels and ids are left out; of several labels of one id the largest counts.
    """
    known = (
        labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col, FOLDS) != 0))
        .groupBy(F.col(id_col).alias("labelled"))
        .agg(F.max(target).alias("label"))
    )
    n = known.count()
    if n > MAX_TRAINING_ROWS:
        known = known.where(F.pmod(F.xxhash64("labelled"), F.lit(1_000_000)) < int(1e6 * MAX_TRAINING_ROWS / n))
    return known


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, statistics) of the rows of ``docs``, stored."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made, name = with_statistics(kept)
    return stored(made.select("id", F.col(name).alias("statistics")), "statistics")


def train(rows: DataFrame, known: DataFrame) -> RuleModel:
    """``rows`` as ``measured`` gives them, ``known`` as ``training_labels`` does."""
    training = rows.join(known, F.col("id") == F.col("labelled")).select("statistics", "label").persist()
    try:
        return fit(training)
    finally:
        training.unpersist()


def keep_predicted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``cut``; columns as given, null texts as empty ones.

    Only the rows to train on are measured first: their ids, a bounded number, go to the texts.
    """
    known = training_labels(labels)
    wanted = F.broadcast(known.select(F.col("labelled").alias("wanted")))
    labelled = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")
    model = train(measured(labelled), known)
    made, name = with_statistics(docs)
    return made.where(model.score(name) >= cut).drop(name)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: fold, score and prediction; empty texts are scored like others."""
    rows = measured(docs)
    model = train(rows, training_labels(labels))
    made = rows.select("id", model.score("statistics").alias("score"))
    return made.select(
        F.col("id").alias("doc_id"),
        (remainder("id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
