"""SimHash near-dedup by pivot distance tables.

A fingerprint's distances to reference fingerprints are computed once. Two fingerprints at
distance d differ by at most d in every coordinate, so a pair whose largest coordinate
difference is above the limit is discarded, and only survivors are compared bit by bit.

Distances over all 64 bits spread too little to be looked up by equality. The bits are therefore
cut into ``BANDS`` bands: two fingerprints within 3 bits agree on at least three of six bands, so
for one of the twenty choices of three bands their distances to every reference, taken over those
bands alone, are equal. This vector of distances is the join key; no bucket is cut. The pair is
made under the first choice only that holds for it, so that no link is made twice.

Only distinct fingerprints take part, so a group of copies is one row. Components are found by
alternating star contraction in Spark, with every round written to the shared folder.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import fresh, raw_texts, slices, stored

SHINGLE = 3
SEED = 42
LIMIT = 3
BANDS = (11, 11, 11, 11, 10, 10)
N_TABLE = 16
N_KEY = 10
#: Hashes of one text that are held as bit counts at once.
HASHES_AT_ONCE = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _references(n: int, seed: int) -> list[int]:
    """``n`` 64-bit reference fingerprints from a counter."""
    return [xxhash.xxh64_intdigest(str(i).encode(), seed=seed) for i in range(n)]


_STARTS = [sum(BANDS[:i]) for i in range(len(BANDS))]
MASKS = [
    sum(((1 << BANDS[i]) - 1) << _STARTS[i] for i in chosen)
    for chosen in itertools.combinations(range(len(BANDS)), len(BANDS) - LIMIT)
]
TABLE = _references(N_TABLE, 1)
KEYS = _references(N_KEY, 2)

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
_BYTE = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(raw: bytes | None) -> int:
    """64 bits, unsigned; a bit is 1 if set in over half the hashes of the word shingles."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = words[at : at + HASHES_AT_ONCE + SHINGLE - 1]
        runs = zip(*(part[k:] for k in range(SHINGLE)), strict=False) if len(words) >= SHINGLE else [words]
        hashes = np.array([digest(join(run), SEED) for run in runs], dtype=">u8")
        seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=2048)
        counts += (seen.reshape(8, 256) @ _BITS).ravel()
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): a row for each row of ``docs``; fp is the fingerprint as a signed long."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([kept.schema["id"], T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [_signed(fingerprint(raw)) for raw in raw_texts(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.int64())], names=["id", "fp"])

    return kept.mapInArrow(run, schema)


def distance(a: Column, b: Column | int) -> Column:
    return F.bit_count(a.bitwiseXOR(F.lit(_signed(b)) if isinstance(b, int) else b))


def _packed(distances: list[Column], bits: int) -> Column:
    shifted = [F.shiftleft(d.cast("long"), i * bits) for i, d in enumerate(distances)]
    return reduce(lambda x, y: x.bitwiseOR(y), shifted)


def pivot_tables(distinct: DataFrame) -> DataFrame:
    """(fp, near, far): distances to the ``N_TABLE`` references, eight to a long."""
    fp = F.col("fp")
    half = [distance(fp, r) for r in TABLE]
    return distinct.select("fp", _packed(half[:8], 8).alias("near"), _packed(half[8:], 8).alias("far"))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b), a < b: the pairs of distinct fingerprints at ``LIMIT`` or fewer differing bits."""
    fp = F.col("fp")
    keys = [
        F.struct(
            F.lit(k).alias("choice"),
            _packed([distance(fp.bitwiseAND(F.lit(_signed(m))), r & m) for r in KEYS], 6).alias("key"),
        )
        for k, m in enumerate(MASKS)
    ]
    rows = pivot_tables(distinct).select("fp", "near", "far", F.inline(F.array(*keys)))
    a, b = rows.alias("a"), rows.alias("b")
    both = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = F.coalesce(*(F.when(both.bitwiseAND(F.lit(_signed(m))) == 0, k) for k, m in enumerate(MASKS)))

    def coordinate(side: str, i: int) -> Column:
        packed = F.col(f"{side}.near" if i < 8 else f"{side}.far")
        return F.shiftrightunsigned(packed, i % 8 * 8).bitwiseAND(F.lit(255))

    close = [F.abs(coordinate("a", i) - coordinate("b", i)) <= LIMIT for i in range(N_TABLE)]
    survives = reduce(lambda x, y: x & y, close)
    return a.join(
        b,
        (F.col("a.choice") == F.col("b.choice"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & survives
        & (F.bit_count(both) <= LIMIT)
        & (first == F.col("a.choice")),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b) but the roots.

    Large-star and small-star steps in turn until nothing changes; a component's edges then all
    lead to its smallest node. Each round is stored, so a lost executor repeats one round at most.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    for _ in range(rounds):
        if not now[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "links")
        before, now = now, state(edges)
        if before == now:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component): a row for each row of ``docs``.

    ``component`` is the smallest id of the rows whose fingerprints can be reached by links, the
    row's own included. Texts without words (null ones too) have fingerprint zero and are linked
    like any other. Null ids keep their row and are no one's component unless all are null.
    Rows with the same id and different texts are documents of their own.
    """
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select("fp", "component")
    return fps.join(named, "fp").select("id", "fp", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest id of each component; columns as given.

    Rows with a null id all stay, as they can't be named. Rows that share an id go together, and
    only if a smaller id stands for each of them.
    """
    made = groups(docs, id_col, text_col)
    gone = made.groupBy("id").agg(F.max("component").alias("kept")).where("id > kept").select("id")
    key = fresh(docs.columns, "gone_id")
    return docs.join(gone.withColumnRenamed("id", key), F.col(id_col) == F.col(key), "left_anti")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def report(docs: DataFrame) -> DataFrame:
    made = groups(docs)
    return made.select(
        F.col("id").alias("doc_id"), hex_of(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )
