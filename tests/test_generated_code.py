"""Code that Spark generates for the sales flow stays small enough to be compiled, and rows are parsed once."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import parsing
from ledgerloom.operators.sums import exact_sums
from ledgerloom.plans import retail
from ledgerloom.queries import QUERIES, flows

SF = "/root/testdata/sf0.001"
JVM_LIMIT = 8000


@pytest.fixture
def fixed_plans(spark):
    """Spark shows generated code for plans that are not adaptive."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def method_sizes(df, capsys):
    capsys.readouterr()
    df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]


def test_landed_and_valid_sales_are_compiled(fixed_plans, capsys):
    for flow in (flows.landed, flows.valid):
        sizes = method_sizes(flow(fixed_plans, SF), capsys)
        assert sizes and max(sizes) < JVM_LIMIT, (flow.__name__, sizes)


def test_sums_are_compiled(fixed_plans, capsys):
    values = fixed_plans.range(100).selectExpr("id % 3 AS k", "id / 7 AS a", "id * 1e10 AS b")
    sizes = method_sizes(exact_sums(values, ["k"], {"a": F.col("a"), "b": F.col("b")}), capsys)
    assert sizes and max(sizes) < JVM_LIMIT, sizes


def test_filter_of_valid_sales_stays_above_the_removal_of_duplicates(spark):
    plan = flows.valid(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("moeda_invalida") < plan.index("Aggregate")


def test_bound_values_keep_nulls_and_odd_texts(spark):
    rows = spark.createDataFrame([(None,), (" ",), ("R$ 1.234,56",), ("1e999",), ("31/02/2024",), ("7/3/2024",)], "t string")
    read = rows.select(parsing.currency_text(F.col("t")), parsing.flexible_date(F.col("t")).cast("string")).collect()
    assert [tuple(r) for r in read] == [
        (None, None), (None, None), (1234.56, None), (None, None), (None, None), (None, "2024-03-07")]


def test_codes_in_use_are_compiled_and_not_shuffled(fixed_plans, capsys):
    """Distinct keys of valid sales need no removal of copies; rejected sales give no key."""
    codes = retail.used_codes(flows.landed(fixed_plans, SF))
    sizes = method_sizes(codes, capsys)
    assert sizes and max(sizes) < JVM_LIMIT, sizes
    assert "Aggregate" not in codes._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in codes.dropna(how="all").distinct().collect()} == {
        tuple(r) for r in flows.sales(fixed_plans, SF).select(*codes.columns).distinct().collect()}
    plan = QUERIES["q_orphans"](fixed_plans, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "_copies" not in plan


def test_shared_codes_are_looked_for_at_the_scan(spark):
    """Only sales whose salesperson code may be shared are read and made unique, and no flagged one is lost."""
    few = retail.sales_of_shared_codes(flows.landed(spark, SF), flows.people(spark, SF))
    plan = few._jdf.queryExecution().optimizedPlan().toString().splitlines()
    scans = [line for line in plan if "l_orderkey" in line and "% 3)" in line and "Filter" in line]
    assert len(scans) == 3 and all("scalar-subquery" in line for line in scans), scans
    flagged = {tuple(r) for r in few.filter("id_vendedor_ambiguo").select("safra", "id_pedido", "item").collect()}
    assert flagged and flagged == {
        tuple(r) for r in flows.sales(spark, SF).filter("id_vendedor_ambiguo").select("safra", "id_pedido", "item").collect()}
