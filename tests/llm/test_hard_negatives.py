"""Hard negatives against plain Python over whole numbers of any size."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertlake.llm import hard_negatives

LONG = (1 << 63) - 1


def brute_force(rows, scale=256, positives=5, negatives=10):
    """Rows are (id, label, vector)."""
    usable = []
    for i, label, vec in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        usable.append((i, label, [math.floor(scale * x) for x in vec]))

    def ranked(anchor, others):
        scored = [(max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(anchor[2], r[2])))), r[0]) for r in others]
        return sorted(scored, key=lambda x: (-x[0], x[1] is None, x[1] or 0))

    out, seen = [], []
    for k, anchor in enumerate(usable):
        if anchor[0] is None or anchor[0] % 100 or anchor in seen:
            continue
        seen.append(anchor)
        near = ranked(anchor, [r for j, r in enumerate(usable) if j != k and r[1] == anchor[1]])
        far = ranked(anchor, [r for r in usable if r[1] != anchor[1]])
        for score, i in near[:positives]:
            inside = [x for x in far if 30 * score <= 100 * x[0] <= 90 * score][:negatives]
            out += [(anchor[0], i, n, j, score, s) for n, (s, j) in enumerate(inside, 1)]
    return sorted(out, key=str)


def vectors(seed, n, size=12):
    r = random.Random(seed)
    return [(i, r.randrange(3), [r.gauss(0.2, 0.3) for _ in range(size)]) for i in range(n)]


def odd_rows():
    rows = vectors(1, 230)
    same = rows[100][2]
    rows += [(100, rows[100][1], same), (900, 0, []), (901, 0, [1.0]), (902, 1, same + [5.0] * 4), (None, 1, same)]
    rows += [(903, None, same), (904, 1, None), (905, 1, [None, 1.0]), (906, 1, [float("nan")])]
    rows += [(907, 2, [float("-inf")]), (300, 1, same), (300, 2, same), (None, 2, [0.1] * 12)]
    return rows + [(i, i % 3, same) for i in range(1000, 1030)]  # ties


def frame(spark, rows):
    """With columns whose names the operator uses itself."""
    schema = "vec_id long, label int, embedding array<float>, anchor string, score int, place int, `group` int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema).repartition(5)


def as_floats(rows):
    """The vectors as 32-bit floats hold them."""
    held = lambda x: x if x is None else float(np.float32(x))
    return [(i, label, vec if vec is None else [held(x) for x in vec]) for i, label, vec in rows]


def mined(df, **more):
    found = hard_negatives.mine(df, F.col("id") % 100 == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("side", [1 << 24, 600])
def test_equals_brute_force_in_one_and_in_many_tiles(spark, monkeypatch, side):
    monkeypatch.setattr(hard_negatives, "BLOCK_CELLS", side)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", min(side, 2048) // 12)
    monkeypatch.setattr(hard_negatives, "SCORES_AT_ONCE", side)
    rows = odd_rows()
    want = brute_force(as_floats(rows))
    assert len(want) > 100
    assert mined(frame(spark, rows)) == want


def test_components_of_any_size(spark):
    rows = vectors(2, 60) + [(200, 1, [1e30, -2e30, 3.0]), (201, 1, [1e30, 5.0]), (202, 0, [5e29]), (203, 2, [3e38] * 9)]
    rows += [(300, 0, [4e6] * 12), (301, 0, [4.1e6] * 12), (302, 1, [2e6] * 12), (303, 2, [1e-30] * 12)]
    assert mined(frame(spark, rows)) == brute_force(as_floats(rows))


def test_no_rows_and_no_anchors(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(1, 1, [1.0]), (2, 2, [1.0]), (None, 1, [1.0])])) == []
    # two copies of the anchor are other rows
    assert mined(frame(spark, [(100, 1, [1.0])] * 3 + [(7, 2, [0.5])])) == [(100, 100, 1, 7, 65536, 32768)] * 2


@pytest.mark.parametrize("top", [3, 300, 40_000, 10**9, 10**15, 10**25])
def test_residues_rebuild_exact_scores(top):
    r = random.Random(top)
    left, right = ([[r.randint(-top, top) for _ in range(70)] for _ in range(n)] for n in (9, 11))
    a, b = np.array(left, float), np.array(right, float)
    left, right = ([[int(x) for x in row] for row in m.tolist()] for m in (a, b))
    bound = hard_negatives.largest(a, b)
    got = hard_negatives.scores(a, b, bound, wide=bound >= 1 << 50)
    assert got.tolist() == [[sum(x * y for x, y in zip(u, v)) for v in right] for u in left]
    assert math.prod(hard_negatives.moduli(bound)) > 2 * bound
