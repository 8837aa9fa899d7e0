"""What each row of a large table costs: nothing is parsed by interpreted code or more often than needed."""

import datetime as dt
import re

from pyspark.sql import functions as F

from ledgerloom.functions import parsing, text
from ledgerloom.operators import asof
from ledgerloom.queries import flows

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fields_are_read_by_compiled_code(spark):
    """Lambdas are interpreted: no pattern, trim or cast of a landed sale may stand inside one."""
    inside = re.findall(r"lambdafunction\((.*?), lambda", optimized(flows.landed(spark, SF)))
    assert inside and not [code for code in inside if "(" in code], inside


def test_days_of_quotes_are_parsed_once_each(spark):
    """A filter of the parsed day stays above the aggregate that makes the days distinct."""
    plan = optimized(flows.quotes(spark, SF).filter(F.col("data_cotacao") < F.lit("9999-12-31").cast("date")))
    assert "RLIKE" in plan and "RLIKE" not in plan[plan.index("Aggregate"):]


def test_numbers_and_spaces_at_the_edge(spark):
    numbers = {"1.": 1.0, ".5": 0.5, "-2e3": -2000.0, "+7": 7.0, "1e999": None, "0x1p3": None, "0X1P3": None, "1d": None, "2F": None, "nan": None,
               "-Infinity": None, "+ 5": None, ".": None, "": None, "1/2": None, "1e5.": None, "٣": None, "　 1,5\x1f": 1.5, "\t1 2": None}
    rows = spark.createDataFrame(list(numbers), "string").select("value", parsing.decimal_comma(F.col("value")).alias("x"))
    assert {r.value: r.x for r in rows.collect()} == numbers
    spaced = ["", " ", " a ", " é ", "a\x85", "\x7f ", " ~!"]
    read = spark.createDataFrame(spaced, "string").select("value", text.strip_space(F.col("value")).alias("x")).collect()
    assert {r.value: r.x for r in read} == {s: s.strip() for s in spaced}


def test_intervals_make_a_row_a_year(spark):
    """An assignment of two years over 24 months of sales is two rows, and a crowded year stays bounded."""
    day, months = dt.date, [dt.date(y, m, 1) for y in (2020, 2021) for m in range(1, 13)]
    names = {"key": "k", "start": "s", "stop": "e", "is_open": "o", "values": ["v"], "months": months}
    spans = [("a", day(2020, 1, 1), day(2021, 12, 31), False, 0)]
    spans += [("b", day(2020, 1, 1) + dt.timedelta(n % 300), day(2020, 6, 1) + dt.timedelta(n * 7 % 500), False, n) for n in range(2000)]
    held = spark.createDataFrame(spans, "k string, s date, e date, o boolean, v int")
    laid = asof.interval_calendar(held, **names)
    assert {(r._key, r._year.year): len(r._pieces) <= 366 for r in laid.collect()} == {(k, y): True for k in "ab" for y in (2020, 2021)}
    days = [day(2019, 12, 30) + dt.timedelta(n) for n in range(800)]
    fact = spark.createDataFrame([("b", d) for d in days], "k string, d date")
    got = asof.asof_interval(fact, held, key="k", day="d", interval_key="k", start="s", stop="e", is_open="o", values={"v": "v"})
    best = {d: max(((s, v) for k, s, e, _, v in spans if k == "b" and s <= d <= e), default=(None, None))[1] for d in days}
    assert {r.d: r.v for r in got.collect()} == best
