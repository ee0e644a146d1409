"""Hard negatives of labelled vectors, scored exactly by a residue-number-system GEMM.

Components become whole numbers, floor(``scale`` * x). A block of anchors is multiplied with a block of
rows modulo several small primes: residues are centred, so that a float32 product over a slice of the
components stays below 2**24 and is exact, and slices are reduced before they are added. Garner's form of
the Chinese remainder theorem rebuilds the signed score from the residues. As many primes are taken as
the largest possible score of the two blocks asks for.

Anchors and rows meet in tiles, one block of each, cogrouped by Spark; a tile holds a bounded number of
rows of either side, whatever the labels and ids are. The first pass finds each anchor's positives in
tiles, keeping a few for each anchor; the second knows their scores and keeps, for each pair, the first
rows inside its window. Rows of all tiles are then ranked by a window over the pair.

Defined results: rows with a null label or vector, or with a component that is null or not finite (also
once scaled), take no part. Vectors of unequal lengths are compared over their common components; an
empty vector scores zero. A null id comes after all others among equal scores and is never an anchor.
Rows that share an id are separate rows; "other" leaves out one copy of the anchor. Anchors with the same
id, label and vector are one anchor. Scores outside 64 bits count as the largest or smallest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertlake.llm.common import read, stored

#: Components of a tile's side, and rows of a block of rows at least: small tables still use many tasks.
BLOCK_CELLS = 1 << 24
BLOCK_ROWS, BLOCKS = 2048, 256
#: Scores that are held at once inside a tile.
SCORES_AT_ONCE = 1 << 21
_EXACT = 1 << 24  # whole numbers up to here are exact in float32


def _primes(below: int = 2048) -> list[int]:
    """Odd primes: the largest below 256 first, then larger ones for scores that need them."""
    sieve = np.ones(below, bool)
    for n in range(2, math.isqrt(below) + 1):
        sieve[n * n :: n] = False
    found = [int(n) for n in np.flatnonzero(sieve) if n > 2]
    return [p for p in reversed(found) if p < 256] + [p for p in found if p > 256]


def moduli(bound: int) -> list[int]:
    """Primes whose product tells all scores from -bound to bound apart."""
    taken, product = [], 1
    for p in _primes():
        taken.append(p)
        product *= p
        if product > 2 * bound:
            return taken
    raise ValueError("scores need more primes than there are below 2048")


def _centred(values: np.ndarray, p: int) -> np.ndarray:
    """Residues between -(p-1)/2 and (p-1)/2; exact for whole numbers of any size."""
    rest = np.mod(values, p)
    return np.where(rest > p // 2, rest - p, rest).astype(np.float32)


def _product(left: np.ndarray, right: np.ndarray, p: int) -> np.ndarray:
    """``left @ right.T`` modulo p, as whole numbers from 0 to p - 1."""
    width = max(1, _EXACT // (p // 2) ** 2)
    a, b = _centred(left, p), _centred(right, p)
    total = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, a.shape[1], width):
        total += (a[:, start : start + width] @ b[:, start : start + width].T).astype(np.int64) % p
    return total % p


def largest(left: np.ndarray, right: np.ndarray) -> int:
    """No score of the two blocks is larger than this, either way."""
    top = lambda x: int(np.abs(x).max(initial=0))
    return max(1, left.shape[1] * top(left) * top(right))


def scores(left: np.ndarray, right: np.ndarray, bound: int, wide: bool) -> np.ndarray:
    """Exact inner products of the rows of ``left`` and ``right`` (whole numbers held as float64).

    ``wide``: as Python's integers, for scores that do not leave room in 64 bits.
    """
    primes = moduli(bound)
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        rest = _product(left, right, p)
        weight, sofar = 1, np.zeros_like(rest)
        for digit, q in zip(digits, primes[:k]):
            sofar = (sofar + digit * weight) % p
            weight = weight * q % p
        digits.append((rest - sofar) % p * pow(weight, -1, p) % p)
    value = np.zeros(digits[0].shape, object if wide else np.int64)
    weight = 1
    for digit, p in zip(digits, primes):
        value = value + digit.astype(value.dtype) * weight
        weight *= p
    return np.where(value > weight // 2, value - weight, value)


def _matrix(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """Rows of whole numbers; components beyond ``width`` are left out, missing ones are zero."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    made = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = place < width
    made[row[inside], place[inside]] = flat[inside]
    return made


def _blocks(left: pa.Table, right: pa.Table, width: int, scale: int, same_label: bool) -> Iterator[tuple]:
    """(vectors, anchor rows, row numbers of the other side, rows, bound, keys): anchors of one label at a time.

    The rows are in the order of their ids. A key is ``score * n - place``, so that keys in descending order
    are scores in descending order, then ids in ascending order.
    """
    if not len(left) or not len(right):
        return
    right = right.sort_by([("id", "ascending")])  # nulls are last
    a, b = _matrix(left["vec"], width, scale), _matrix(right["vec"], width, scale)
    own, theirs = left["label"].to_numpy(), right["label"].to_numpy()
    for label in np.unique(own):
        of = np.flatnonzero(own == label)
        against = np.flatnonzero((theirs == label) == same_label)
        if not len(against):
            continue
        n = len(against)
        step = max(1, SCORES_AT_ONCE // n)
        for start in range(0, len(of), step):
            part = of[start : start + step]
            bound = largest(a[part], b[against])
            wide = bound * max(4 * n, 4096) >= 1 << 62
            keys = scores(a[part], b[against], bound, wide) * n - np.arange(n)
            yield a[part], part, against, right, bound, keys


_LONG = (1 << 63) - 1


def _as_long(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def _emitted(schema: pa.Schema, columns: list[list]) -> pa.Table:
    return pa.table([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _taken(keys: np.ndarray, right: pa.Table, against: np.ndarray) -> tuple[list, list]:
    """Ids and scores of sorted keys."""
    n = len(against)
    place = [int(-k % n) for k in keys]
    found = [(int(k) + p) // n for k, p in zip(keys, place)]
    ids = right["id"].take(pa.array(against[place])).to_pylist() if place else []
    return ids, [_as_long(x) for x in found]


def _first_positives(width: int, scale: int, wanted: int):
    schema = pa.schema(
        [("anchor", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("itself", pa.bool_())]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for vectors, part, against, rows, _, keys in _blocks(left, right, width, scale, True):
            best = -np.sort(-keys, axis=1)[:, : wanted + 1]  # one may be the anchor itself
            asked = left.select(["anchor", "id"]).take(pa.array(part)).to_pylist()
            for one, vector, line in zip(asked, vectors, best):
                own = _as_long(sum(int(x) ** 2 for x in vector))
                ids, found = _taken(line, rows, against)
                out[0] += [one["anchor"]] * len(ids)
                out[1] += ids
                out[2] += found
                out[3] += [i == one["id"] and x == own for i, x in zip(ids, found)]
        return _emitted(schema, out)

    return run


def _first_negatives(width: int, scale: int, wanted: int, low: int, high: int):
    schema = pa.schema(
        [("anchor", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for _, part, against, rows, bound, keys in _blocks(left, right, width, scale, False):
            n = len(against)
            keys = np.sort(keys, axis=1)
            asked = left.select(["anchor", "positives"]).take(pa.array(part)).to_pylist()
            for one, line in zip(asked, keys):
                for positive in one["positives"]:
                    # low * ps <= 100 * score <= high * ps, in whole scores
                    least, most = -(-low * positive["score"] // 100), high * positive["score"] // 100
                    if least > most:
                        continue
                    # keys of one score lie between score * n - n + 1 and score * n
                    edges = (max(-bound, min(bound + 1, x)) for x in (least, most + 1))
                    begin, end = (int(np.searchsorted(line, x * n - n + 1)) for x in edges)
                    ids, found = _taken(line[max(begin, end - wanted) : end][::-1], rows, against)
                    out[0] += [one["anchor"]] * len(ids)
                    out[1] += [positive["place"]] * len(ids)
                    out[2] += ids
                    out[3] += found
        return _emitted(schema, out)

    return run


def _usable(df: DataFrame, id_col: str, label: Column, vec_col: str, scale: int) -> DataFrame:
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < F.lit(float("inf")))
    return df.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec")
    ).where(F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite))


def mine(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label: Column | None = None,
    vec_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the column ``id``. Negatives of a pair are the ``negatives`` first rows of
    another label whose score is from ``low`` to ``high`` percent of the positive's.
    """
    spark = df.sparkSession
    rows = _usable(df, id_col, F.col("label") if label is None else label, vec_col, scale)
    asking = stored(
        rows.where(anchors & F.col("id").isNotNull())
        .groupBy("id", "label", "vec")
        .agg(F.lit(1).alias("one"))
        .select(F.monotonically_increasing_id().alias("anchor"), "id", "label", "vec"),
        "anchors",
    )
    size = asking.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    n_anchors, width = int(size[0]), max(1, int(size[1]))
    n_rows = rows.count()
    side = max(1, BLOCK_CELLS // width)
    n_blocks = max(1, math.ceil(n_rows / max(BLOCK_ROWS, min(side, n_rows // BLOCKS))))
    n_groups = max(1, math.ceil(n_anchors / side))

    def tiled(frame: DataFrame, number: Column, own: int, other: int, own_first: bool) -> DataFrame:
        """Every row once for each block of the other side."""
        mine_, theirs = F.pmod(F.xxhash64(number), F.lit(own)), F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        cut = frame.select("*", mine_.alias("_own"), theirs.alias("_other"))
        a, b = ("_own", "_other") if own_first else ("_other", "_own")
        return cut.withColumns({"group": F.col(a).cast("long"), "block": F.col(b).cast("long")}).drop("_own", "_other")

    row_number = F.monotonically_increasing_id()
    blocks = tiled(rows, row_number, n_blocks, n_groups, False).groupBy("group", "block")

    def against_all(left: DataFrame, run, schema: str) -> DataFrame:
        groups = tiled(left, F.col("anchor"), n_groups, n_blocks, True).groupBy("group", "block")
        return groups.cogroup(blocks).applyInArrow(run, schema)

    # Positives. The anchor itself may be among the first; one copy of it goes.
    found = against_all(
        asking, _first_positives(width, scale, positives), "anchor long, id long, score long, itself boolean"
    )
    order = [F.desc("score"), F.asc_nulls_last("id")]
    first = found.select("*", F.row_number().over(Window.partitionBy("anchor").orderBy(*order)).alias("place"))
    kept = (
        first.where(F.col("place") <= positives + 1)
        .groupBy("anchor")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"),
            F.min(F.when(F.col("itself"), F.col("place"))).alias("own_place"),
        )
    )
    others = F.filter("found", lambda x: ~x["place"].eqNullSafe(F.col("own_place")))
    with_positives = stored(
        asking.join(kept, "anchor")
        .select("anchor", "id", "label", "vec", F.slice(others, 1, positives).alias("positives"))
        .where(F.size("positives") > 0),
        "positives",
    )
    # Negatives, each tile's first of a pair, then the first of all tiles.
    run = _first_negatives(width, scale, negatives, low, high)
    near = against_all(with_positives, run, "anchor long, place int, id long, score long")
    by_pair = Window.partitionBy("anchor", "place").orderBy(*order)
    ranked = near.select("*", F.row_number().over(by_pair).alias("rank")).where(F.col("rank") <= negatives)
    pairs = with_positives.select("anchor", F.col("id").alias("anchor_id"), F.explode("positives").alias("p"))
    pairs = pairs.select(
        "anchor", "anchor_id", F.col("p.place").alias("place"),
        F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"),
    )
    return ranked.join(pairs, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)


SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
    row_number() OVER () AS n
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.n AS a, a.vec_id AS anchor_id, r.n AS r, r.vec_id AS id, a.label = r.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(r.v)) + 1), lambda i: a.v[i] * r.v[i])), 0) AS BIGINT) AS score
  FROM usable a, usable r WHERE a.vec_id % 100 = 0 AND a.n <> r.n),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS place FROM scored WHERE same
  QUALIFY place <= 5),
found AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON p.a = n.a AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= 10
"""
