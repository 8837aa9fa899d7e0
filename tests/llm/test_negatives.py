import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row string, block int"


def plain(rows, positives=5, wanted=5):
    """All scores of all anchors, in memory."""
    used = [
        (i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * x))) for x in v], l) for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (anchor, a, label) in enumerate(used):
        if anchor % 100:
            continue
        scored = sorted(
            (-max(-(1 << 61), min(1 << 61, sum(x * y for x, y in zip(a, v)))), i, other == label)
            for m, (i, v, other) in enumerate(used) if m != k)
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            near = [s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p][:wanted]
            out += [(anchor, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


def found(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "mine", 3) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.mine(frame, F.col("vec_id") % 100 == 0, **more).collect())


@pytest.mark.parametrize("least_rows", [16, 10_000])
@pytest.mark.parametrize("grid", [0, 2])
def test_like_all_scores(spark, monkeypatch, least_rows, grid):
    monkeypatch.setattr(negatives, "LEAST_ROWS", least_rows)
    rng = np.random.default_rng(grid)
    rows = []
    for k in range(600):
        v = rng.normal(size=6) / 3
        rows.append((k * 5, (np.round(v * grid) / grid if grid else v).tolist(), int(rng.integers(3))))  # a grid makes ties
    assert found(spark, rows) == plain(rows) != []


def test_scores_are_worked_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 4096)
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=4).tolist(), int(rng.integers(2))) for k in range(1000)]
    assert found(spark, rows, positives=3, negatives=2) == plain(rows, 3, 2)


def test_copies_of_one_vector(spark):
    rng = random.Random(1)
    rows = [(k, [0.5, 0.25, -0.5], k % 2) for k in range(400)] + [(1000 + k, [rng.random() for _ in range(3)], 1) for k in range(100)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 1.0], 1), (100, [], 1), (200, [-1.0, -1.0], 1), (300, [1.0], 2), (7, [1.0, 1.5], 2),
        (7, [1.0, 1.5], 2), (8, None, 1), (9, [1.0, None], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 2), (12, [1.0, 1.9], None),
        (None, [1.0, 1.9], 2), (13, [1e7, 1e7], 2), (400, [1e7, 1.1e7], 2), (14, [1e7, 1e7], 1), (500, [3e300, 0.0], 2), (15, [1e300, 1.0], 1), (16, [1e300, 1.0], 2),
    ]
    assert found(spark, rows) == plain(rows) != []


def test_no_rows_and_no_anchors(spark):
    assert found(spark, []) == found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    out = negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_keys_sort_as_named():
    rng = random.Random(3)
    some = [(rng.choice([-5, 0, 7, 2**62]), rng.choice([-(2**61), -1, 0, 1, 2**61]), rng.randrange(-3, 3), rng.random() < 0.5) for _ in range(300)]
    keys = negatives.pack(*[np.array(c) for c in zip(*some)])
    assert [tuple(x) for x in zip(*(c.tolist() for c in negatives.unpack(keys)))] == some
    raw = keys.to_pylist()
    assert sorted(range(300), key=lambda k: raw[k]) == sorted(range(300), key=lambda k: (some[k][0], -some[k][1], not some[k][3], some[k][2]))
