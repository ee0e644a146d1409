"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is a DataFrame expression; no rows leave their partition. Repeated word windows are
found inside the row: each window of eight words becomes a 64-bit hash, and only a text whose
hashes repeat sorts them to mark the words covered. (Two different windows of one text share a
hash with a chance of n*n/2**65, under 1e-10 for 20,000 words.)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import SPACE_CLASS, fresh

SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    *("the", "of", "and", "to", "in", "is", "that", "was", "for", "it", "with", "as", "be", "on", "are", "this"),
    *("der", "die", "das", "und", "ist", "nicht", "zu", "den", "mit", "von", "ein", "eine", "auf", "sich", "für", "im"),
    *("le", "la", "les", "de", "des", "et", "est", "en", "que", "une", "un", "dans", "pour", "qui", "sur", "pas"),
    *("el", "los", "las", "y", "una", "por", "con", "del", "se", "no", "su", "al"),
)


@dataclass(frozen=True)
class Rule:
    """``low * of <= scale * value <= high * of``, in whole numbers; None leaves a side open."""

    name: str
    value: str
    of: str | None = None
    scale: int = 1
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        value, of = F.col(self.value) * self.scale, F.col(self.of) if self.of else F.lit(1)
        sides = [] if self.low is None else [value >= of * self.low]
        sides += [] if self.high is None else [value <= of * self.high]
        return reduce(lambda a, b: a & b, sides, F.lit(True))

    def sql(self) -> str:
        of = self.of or "1"
        sides = [] if self.low is None else [f"{self.scale} * {self.value} >= {self.low} * {of}"]
        sides += [] if self.high is None else [f"{self.scale} * {self.value} <= {self.high} * {of}"]
        return "(" + (" AND ".join(sides) or "true") + ")"


#: The threshold table. Word lengths in tenths of a code point, ratios in percent.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", scale=10, low=20, high=150),
    Rule("symbols_per_word", "n_symbols", "n_words", scale=100, high=10),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("stop_word_share", "n_stop_words", "n_words", scale=100, low=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", scale=100, high=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", scale=100, high=30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", scale=100, high=90),
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, and only where the result is asked for."""
    return F.transform(F.array(value), use)[0]


def _covered(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def marked(pairs: Column) -> Column:
        same_before = lambda p, i: F.coalesce(F.get(pairs, i - 1)["g"] == p["g"], F.lit(False))
        same_after = lambda p, i: F.coalesce(F.get(pairs, i + 1)["g"] == p["g"], F.lit(False))
        return F.filter(pairs, lambda p, i: same_before(p, i) | same_after(p, i))

    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    places = F.sort_array(F.transform(_let(pairs, marked), lambda p: p["i"]))
    start = F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last"))
    total = F.aggregate(
        places,
        start,
        lambda a, p: F.struct(
            (a["sum"] + F.least(F.lit(WINDOW), p - a["last"])).alias("sum"), p.alias("last")
        ),
        lambda a: a["sum"],
    )
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(total)


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_stop_words",
    "n_ellipsis_lines",
    "n_bullet_lines",
)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the columns of MEASURES as long): a row for each row of ``docs``.

    Null and empty texts measure zero everywhere. Other columns are not carried.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    parts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE_CLASS}+")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
    )
    known = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    tail = lambda x: F.rtrim(x, F.lit(SPACES))
    head = lambda x: F.ltrim(x, F.lit(SPACES))
    hashed = parts.select(
        "id",
        F.size("words").alias("n_words"),
        F.length(F.concat_ws("", "words")).alias("word_chars"),
        "n_symbols",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: w.isin(known))).alias("n_stop_words"),
        F.size(F.filter("lines", lambda x: tail(x).endswith("...") | tail(x).endswith("…"))).alias("n_ellipsis_lines"),
        F.size(F.filter("lines", lambda x: F.substring(head(x), 1, 1).isin("-", "*", "•"))).alias("n_bullet_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.col("n_words") - WINDOW),
            lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    grams = hashed.select("*", windows.alias("grams")).drop("hashes")
    counted = grams.select("*", _covered(F.col("grams")).alias("n_repeat_words"))
    return counted.select("id", *(F.col(x).cast("long").alias(x) for x in MEASURES))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``base_failed``, ``failed_rules`` (names) and ``kept``, for each row of ``docs``."""
    failed = F.array_compact(F.array(*(F.when(~r.holds(), F.lit(r.name)) for r in rules)))
    made = measures(docs).select("*", base_failed().alias("base_failed"), failed.alias("failed_rules"))
    return made.select("*", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold all rules; columns as given. Rows with a null id stay.

    Rows that share an id stay if one of them is good.
    """
    key = fresh(docs.columns, "good_id")
    good = judged(docs).where("kept").select(F.col("id").alias(key)).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(F.col(key)), "left_semi")


def report(docs: DataFrame) -> DataFrame:
    made = judged(docs)
    return made.select(
        F.col("id").alias("doc_id"),
        *MEASURES[:5],
        "base_failed",
        "kept",
    )


def sql() -> str:
    """DuckDB SQL for ``report`` over documents."""
    known = ", ".join(f"'{w}'" for w in [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)])
    spaces = r"[\x20\x09-\x0D]"
    return rf"""
WITH parts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
base AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    len(list_filter(words, lambda w: w IN ({known}))) AS n_stop_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…){spaces}*$'))) AS n_ellipsis_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^{spaces}*[-*•]'))) AS n_bullet_lines, words
  FROM parts),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS t
  FROM (SELECT doc_id, words, unnest(range(1, n_words - 6)) AS i FROM base)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY doc_id),
counted AS (
  SELECT base.*, coalesce(n, 0) AS n_repeat_words, n_words < {MIN_WORDS} OR 100 * coalesce(n, 0) > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM base LEFT JOIN covered USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(r.sql() for r in RULES)} AS kept
FROM counted
"""
