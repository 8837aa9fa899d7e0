"""Sets of keys as bits: no key is lost, few others pass, distinct counts are exact."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import membership
from ledgerloom.operators.returns import sale_terms
from ledgerloom.queries import QUERIES, flows
from ledgerloom.sources import staging

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [1, 300, 50_000])
def test_no_key_is_lost_and_few_others_pass(spark, rows):
    facts = spark.range(200_000).select(F.concat(F.lit("P"), "id").alias("order"), (F.col("id") % 7).cast("int").alias("item"))
    keys = facts.filter(F.substring("order", 2, 9).cast("int") < rows).select(F.col("order").alias("of"), F.col("item").alias("line"))
    kept = membership.possibly_in(facts, {"order": "of", "item": "line"}, keys.unionByName(keys), rows)
    assert kept.columns == facts.columns
    assert kept.join(keys, (F.col("of") == F.col("order")) & (F.col("line") == F.col("item"))).count() == rows
    assert kept.count() - rows <= 0.02 * (200_000 - rows)


def test_a_full_filter_lets_more_pass_but_loses_none(spark, monkeypatch):
    monkeypatch.setattr(membership, "MOST_BLOCKS", 1)
    facts = spark.range(100_000)
    keys = facts.filter("id % 4 = 0")
    kept = membership.possibly_in(facts, {"id": "id"}, keys, 25_000)
    assert kept.filter("id % 4 = 0").count() == 25_000


def test_nulls_empty_tables_and_other_types(spark):
    facts = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "n int, name string")
    keys = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (1, "a")], "n int, name string")
    both = {"n": "n", "name": "name"}
    assert [tuple(r) for r in membership.possibly_in(facts, both, keys, 4).collect()] == [(1, "a")]
    assert membership.possibly_in(facts, both, keys.limit(0), 0).count() == 0
    assert membership.possibly_in(facts.limit(0), both, keys, 4).count() == 0
    with pytest.raises(ValueError, match="different types"):
        membership.possibly_in(facts, {"n": "n"}, keys.withColumn("n", F.col("n").cast("long")), 4)


def test_sales_without_a_return_are_left_out_before_the_shuffle(spark):
    path = staging.fresh_path(spark, "bloom-sales")
    spark.range(100_000).select(F.col("id").alias("sale"), (F.col("id") * 2.0).alias("price")).write.parquet(path)
    sales = spark.read.parquet(path)
    returns = spark.range(1_000).select((F.col("id") * 100).alias("of"))
    plain = sale_terms(sales, returns, {"of": "sale"}, {"price": "p"})
    thinned = sale_terms(sales, returns, {"of": "sale"}, {"price": "p"}, 1_000)
    assert sorted(map(str, plain.collect())) == sorted(map(str, thinned.collect())) and thinned.count() == 1_000
    plan = thinned._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and "bit_or" in plan


def test_distinct_counts_of_any_grouping(spark):
    rows = [(g, k, -k if k is not None and k % 3 == 0 else k) for g in ("a", "b", None) for k in [None, 0, 1, 63, 64, 64, 65, 2**40, -1, -64, -65]]
    fact = spark.createDataFrame(rows + [("a", 7, None)], "g string, k long, other long")
    words = membership.member_words(fact, ["g"], ["k", "other"])
    for by in (["g"], []):
        got = {tuple(r) for r in membership.distinct_members(words, by).collect()}
        tall = fact.selectExpr("g", "inline(array(struct('k' AS c, k AS v), struct('other' AS c, other AS v)))")
        assert got == {tuple(r) for r in tall.groupBy(*by, "c").agg(F.countDistinct("v")).collect()}
    assert membership.member_words(fact.limit(0), ["g"], ["k"]).count() == 0


def test_a_set_is_no_larger_than_its_dense_keys(spark):
    fact = spark.range(64_000).select((F.col("id") % 6_400).alias("k"))
    assert membership.member_words(fact, [], ["k"]).count() == 100


def test_balance_of_two_sets(spark):
    used = spark.createDataFrame([(k,) for k in (1, 1, 2, 64, 70, -1, None, 2**35)], "k long")
    known = spark.createDataFrame([(k,) for k in (1, 2, 3, 64, 500, None)], "k long")
    words = [membership.member_words(x, [], ["k"]) for x in (used, known)]
    assert [tuple(r) for r in membership.member_balance(*words).collect()] == [("k", 3, 3, 2)]
    assert [tuple(r) for r in membership.member_balance(words[0], words[1].limit(0)).collect()] == [("k", 0, 6, 0)]
    assert membership.member_balance(words[0].limit(0), words[1].limit(0)).count() == 0


@pytest.mark.parametrize("rows", [1, 300, 50_000])
def test_a_condition_says_which_keys_may_be_named(spark, rows):
    facts = spark.range(200_000).select(F.concat(F.lit("P"), "id").alias("order"), (F.col("id") % 7).cast("int").alias("item"))
    keys = facts.filter(F.substring("order", 2, 9).cast("int") < rows).select(F.col("order").alias("of"), F.col("item").alias("line"))
    kept = facts.filter(membership.possibly_among({"order": "of", "item": "line"}, keys.unionByName(keys), rows))
    assert kept.join(keys, (F.col("of") == F.col("order")) & (F.col("line") == F.col("item"))).count() == rows
    assert kept.count() - rows <= 0.02 * (200_000 - rows)
    assert facts.filter(membership.possibly_among({"order": "of", "item": "line"}, keys.limit(0), 0)).count() == 0


def test_a_crowded_condition_loses_no_key(spark, monkeypatch):
    monkeypatch.setattr(membership, "MOST_BLOCKS", 1)
    facts = spark.range(100_000)
    assert facts.filter(membership.possibly_among({"id": "id"}, facts.filter("id % 4 = 0"), 25_000)).filter("id % 4 = 0").count() == 25_000


def test_landed_sales_without_a_return_are_left_out_at_the_scan(spark):
    """Below the order of each line, the reading of its fields and the removal of copies, in each of the three layouts."""
    for flow in (flows.valued_returns(spark, SF), QUERIES["q_orphan_returns"](spark, SF)):
        plan = flow._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scans = [line for line in plan if "l_orderkey" in line and "% 3)" in line and "Filter" in line]
        assert len(scans) in (3, 6) and all("scalar-subquery" in line for line in scans), scans
