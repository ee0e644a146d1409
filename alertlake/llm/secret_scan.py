"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by the SHA-256 of its content. A scan takes the pairs of blob
and rule version that the ledger does not hold, runs the rules over those blobs once, however many
paths have them, appends what it found, and joins the ledger back to all paths. Everything is a
DataFrame expression: matches and the gaps between them give the offsets.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import stored
from alertlake.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose group ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0



def _either_case(words: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in words)


#: The base kinds, in their order. Runs of 24 or more hexadecimal digits, and of 20 or more
#: characters after AKIA, are what is left of all runs when the short ones are dropped.
BASE = (
    Rule(
        "assign",
        "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: What this scanner adds to them.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED

SPAN = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("end", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)
#: Unseen hashes (32 bytes each) up to this many are sent to the texts; more are joined by a shuffle.
BROADCAST_BLOBS = 250_000

LEDGER = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("rule_version", T.StringType()),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def version_of(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def blob_of(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def findings(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) for each of the blobs (blob, text), spans by start and rule order.

    Offsets are code points, the end exclusive; matches of one rule are leftmost and do not
    overlap. Only texts with a match are cut into matches and gaps.
    """

    def hits(rank: int, rule: Rule):
        gaps = F.split("text", rule.pattern, -1)
        whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        judged = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
        parts = F.zip_with(
            F.slice(gaps, 1, F.size(whole)),
            F.arrays_zip(whole.alias("whole"), judged.alias("judged")),
            lambda g, h: F.struct(
                F.length(g).cast("long").alias("gap"),
                F.length(h["whole"]).cast("long").alias("size"),
                (F.length(h["judged"]) >= rule.least).alias("kept"),
                F.lit(rank).alias("rank"),
            ),
        )
        numbered = F.transform(parts, lambda p, i: F.struct(*(p[x].alias(x) for x in ("gap", "size", "kept", "rank")), i.alias("i")))
        none = F.array().cast("array<struct<gap:bigint,size:bigint,kept:boolean,rank:int,i:int>>")
        return F.when(F.col("text").rlike(rule.pattern), numbered).otherwise(none)

    all_hits = F.concat(*(hits(k, r) for k, r in enumerate(rules)))
    rows = blobs.select("blob", F.inline_outer(all_hits))
    so_far = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    spans = rows.select("blob", "rank", "kept", "size", end.alias("end"))
    span = F.struct(
        (F.col("end") - F.col("size")).alias("start"), F.col("rank"), F.col("end"), F.get(kinds, F.col("rank")).alias("kind")
    )
    return spans.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(F.col("kept"), span))).alias("spans"))


class Ledger:
    """Append-only table of what was found in which blob under which rule version.

    Each scan writes below a folder of its own and is complete once Spark has committed it; a scan
    that broke off leaves no rows, and repeating it scans what is still unseen.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """Empty before the first scan."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def unseen(self, versions: DataFrame, text_col: str, version: str) -> DataFrame | None:
        """(blob, text) of the blobs of ``versions`` that the ledger lacks, one row each; None if it has all.

        The ledger is asked by hashes alone, before any text moves. Where few enough hashes are
        unseen to send them to the texts, only texts that have one are shuffled.
        """
        blobs = versions.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
            F.unhex(F.sha2("text", 256)).alias("blob"), "text"
        )
        # Copies are reduced to one row in each map task before the texts are shuffled.
        once = lambda texts: texts.groupBy("blob").agg(F.first("text").alias("text"))
        known = self.rows().where(F.col("rule_version") == version).select("blob")
        if known.isEmpty():
            return once(blobs)
        wanted = stored(blobs.select("blob").distinct().join(known, "blob", "left_anti"), "unseen")
        n = wanted.count()
        if not n:
            return None
        if n <= BROADCAST_BLOBS:
            return once(blobs.join(F.broadcast(wanted), "blob", "left_semi"))
        return once(blobs).join(wanted, "blob", "left_semi")

    def scan(self, versions: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scans the unseen blobs of ``versions``, appends them, and returns the rows of the rule version."""
        version = version_of(rules)
        texts = self.unseen(versions, text_col, version)
        if texts is not None:
            rows = findings(texts, rules).select("blob", F.lit(version).alias("rule_version"), "spans")
            rows.write.mode("append").partitionBy("rule_version").parquet(self.path)
        return self.rows().where(F.col("rule_version") == version)

    def found_in(self, versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
        """(id, blob, spans) for each row of ``versions``: the findings joined back to all paths."""
        version = version_of(rules)
        paths = versions.select(F.col(id_col).alias("id"), blob_of(F.col(text_col)).alias("blob"))
        # A blob scanned twice by scans that ran side by side has equal rows; one is enough.
        some = self.rows().where((F.col("rule_version") == version) & (F.size("spans") > 0))
        once = some.groupBy("blob").agg(F.first("spans").alias("spans"))
        return paths.join(once, "blob", "left").select(
            "id", "blob", F.coalesce("spans", F.array().cast(T.ArrayType(SPAN))).alias("spans")
        )


def written(spans, kinds: list[str] | None = None):
    """kind:start:end of the spans, in their order, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(kinds)) if kinds else spans
    return F.concat_ws(
        ",",
        F.transform(
            chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )


def report(versions: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """A row for each row of ``versions`` (doc_id, text): counts and spans.

    Null texts are the empty blob; empty texts have no spans; repeated rows stay, scanned once.
    """
    spark = versions.sparkSession
    ledger = Ledger(spark, ledger_path or scratch_path(spark, "blob-ledger"))
    ledger.scan(versions)
    found = ledger.found_in(versions)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(written(F.col("spans"), [r.kind for r in BASE]), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def sql() -> str:
    """DuckDB SQL for ``report`` over documents."""

    def rows(rank: int, r: Rule) -> str:
        pattern = "'" + r.pattern.replace("'", "''") + "'"
        return (
            f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least,"
            f" unnest(string_split_regex(text, {pattern})[:len(regexp_extract_all(text, {pattern}))]) AS gap,"
            f" unnest(regexp_extract_all(text, {pattern})) AS hit,"
            f" unnest(regexp_extract_all(text, {pattern}, {r.group})) AS judged,"
            f" unnest(range(1, len(regexp_extract_all(text, {pattern})) + 1)) AS i FROM docs"
        )

    hits = "\n  UNION ALL ".join(rows(k, r) for k, r in enumerate(RULES))
    counts = ", ".join(f"CAST(coalesce(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}" for r in BASE)
    sums = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({hits}),
ends AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM hits),
kept AS (SELECT doc_id, rank, kind, CAST(stop - length(hit) AS BIGINT) AS start,
  kind || ':' || CAST(CAST(stop - length(hit) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR) AS t
  FROM ends WHERE length(judged) >= least),
found AS (SELECT doc_id, {sums}, string_agg(t, ',' ORDER BY start, rank) AS spans,
  string_agg(t, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base FROM kept GROUP BY doc_id)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (doc_id)
"""
