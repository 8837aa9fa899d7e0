"""Exact sums against fractions, in any order and partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.sums import exact_sums, merged, partial_sums, totals


def plain(values):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(math.isnan(v) for v in known) or {math.inf, -math.inf} <= set(known):
        return math.nan
    special = [v for v in known if math.isinf(v)]
    if special:
        return special[0]
    total = sum(map(Fraction, known))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def groups():
    rng = random.Random(7)
    any_double = lambda: math.ldexp(rng.choice([-1, 1]) * rng.randrange(1 << 52, 1 << 53), rng.randrange(-1074, 970))
    out = {
        "money": [round(rng.uniform(-1e5, 1e5), 2) for _ in range(500)], "tiny": [1e-30] * 1000, "cancel": [1e300, 2e15, -1e300],
        "order": [1e300, -1e300, 2e15], "null": [None, None], "zero": [0.0, -0.0, None], "gone": [1.5, -1.5], "half": [2.0**53, 1.0, 2.0**-1074],
        "even": [2.0**53, 1.0], "below": [-(2.0**53), -1.0, -(2.0**-1074)], "over": [1.7e308, 1.7e308], "back": [1.7e308, 1.7e308, -1.7e308],
        "least": [5e-324] * 3, "largest": [1.7976931348623157e308], "nan": [1.0, math.nan], "inf": [1.0, math.inf], "both": [math.inf, -math.inf],
        "powers": [math.ldexp(s, e) for e in range(-1074, 1024) for s in (1, -1)][1:], "edges": [math.nextafter(2.0**e, 0) for e in range(-100, 100)],
    }
    for k in range(40):
        values = [any_double() for _ in range(rng.randrange(1, 40))]
        out[f"any{k}"] = values + [-v for v in values if rng.random() < 0.7]
    for k in range(20):
        out[f"near{k}"] = [math.ldexp(rng.randrange(-(1 << 53), 1 << 53), rng.randrange(-70, -10)) for _ in range(200)]
    return out


def same(a, b):
    return a is None and b is None or a is not None and b is not None and (a == b or math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("seed", [1, 2])
def test_like_fractions(spark, seed):
    rows = [(k, v, None if v is None else -v) for k, values in groups().items() for v in values]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(3 + 4 * seed)
    got = {r.k: r for r in exact_sums(df, ["k"], {"total": F.col("v"), "other": F.col("w")}, rows="n", least={"low": F.col("v")}, most={"high": F.col("v")}).collect()}
    for k, values in groups().items():
        assert same(got[k].total, plain(values)), k
        assert same(got[k].other, plain([None if v is None else -v for v in values])), k
        assert got[k].n == len(values)
    assert (got["money"].low, got["money"].high) == (min(groups()["money"]), max(groups()["money"]))


def test_merged_parts_of_many_rows(spark):
    rows = spark.range(100_000).select((F.col("id") % 1000).alias("key"), (F.col("id") % 3).alias("g"), F.when(F.col("id") % 2 == 0, F.lit(0.1)).otherwise(F.lit(1e16)).alias("v"))
    parts = partial_sums(rows, ["key", "g"], {"v": F.col("v")})
    got = {r.g: r.v for r in totals(merged(parts, ["g"]), ["g"], ["v"]).collect()}
    want = {g: float(sum(Fraction(0.1) if i % 2 == 0 else Fraction(1e16) for i in range(g, 100_000, 3))) for g in range(3)}
    assert got == want


def test_no_group_and_no_rows(spark):
    df = spark.createDataFrame([], "k string, v double")
    (row,) = exact_sums(df, [], {"total": F.col("v")}, rows="n").collect()
    assert (row.total, row.n) == (None, 0)
    assert exact_sums(df, ["k"], {"total": F.col("v")}).collect() == []
    by = exact_sums(spark.createDataFrame([(None, 1.5), (None, 2.0)], "k string, v double"), [F.upper("k").alias("u")], {"t": F.col("v")})
    assert [tuple(r) for r in by.collect()] == [(None, 3.5)]
