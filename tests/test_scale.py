"""What must hold at any size: split skew, exact other ways, no Python in plans, no pairwise joins."""

import datetime as dt
import pathlib
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import asof, keys, quality, returns
from ledgerloom.operators.sums import exact_sums, merged, partial_sums, totals
from ledgerloom.plans import retail
from ledgerloom.queries import QUERIES, flows
from ledgerloom.sources import staging


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, and skew thresholds low enough for test data."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_fact(spark):
    """A third of the rows hold one key, a third no key at all."""
    path = staging.fresh_path(spark, "hot")
    spark.range(60_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 5000)).alias("code"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def dimension(spark):
    return spark.range(1, 5000).select(F.concat(F.lit("k"), "id").alias("code"), F.col("id").alias("sk")).unionByName(
        spark.range(1).select(F.lit("hot").alias("code"), F.lit(9999).cast("long").alias("sk")))


def test_key_resolution_splits_hot_keys(shuffled_joins):
    fact = hot_fact(shuffled_joins)
    resolved = keys.resolve_key(fact, dimension(shuffled_joins), code="code", dim_code="code", dim_sk="sk", out="key")
    assert "skew=true" in final_plan(resolved)
    counts = {r.key: r.n for r in resolved.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert counts[9999] == 20_000 and sum(counts.values()) == 60_000


def test_duplicate_flag_splits_hot_keys(shuffled_joins):
    flagged = quality.flag_duplicates(hot_fact(shuffled_joins), "code", "dup")
    assert "skew=true" in final_plan(flagged)
    assert flagged.filter("dup").count() == 40_000


@pytest.mark.parametrize("days", [28, 45])
def test_interval_lookup_splits_hot_keys(shuffled_joins, days):
    """Varying days of one month, and of two."""
    fact = hot_fact(shuffled_joins).withColumn(
        "day", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % days).cast("int")))
    held = dimension(shuffled_joins).select(
        "code", F.lit("2019-01-01").cast("date").alias("s"), F.lit("2020-12-31").cast("date").alias("e"),
        F.lit(False).alias("o"), "sk")
    got = asof.asof_interval(fact, held, key="code", day="day", interval_key="code", start="s", stop="e", is_open="o",
                             values={"sk": "held"})
    assert "skew=true" in final_plan(got)
    assert got.filter("held = 9999").count() == 20_000 and got.count() == 60_000


def test_months_are_gathered_by_the_write(spark):
    days = [dt.date(2020, 1, 31), dt.date(2999, 12, 1), None, dt.date(2020, 1, 1), dt.date(2019, 5, 9)]
    fact = spark.createDataFrame([("k", d, n) for n, d in enumerate(days)], "code string, day date, id int").repartition(3)
    kept, months = staging.staged_with_months(fact, "months", "day")
    assert months == [dt.date(2019, 5, 1), dt.date(2020, 1, 1), dt.date(2999, 12, 1)]
    assert kept.count() == 5 and staging.staged_with_months(fact.limit(0), "none", "day")[1] == []
    held = spark.createDataFrame([("k", dt.date(2019, 5, 9), dt.date(2020, 1, 30), False, 1), ("k", dt.date(2020, 1, 31), None, True, 2)],
                                 "code string, s date, e date, o boolean, sk int")
    names = {"key": "code", "day": "day", "interval_key": "code", "start": "s", "stop": "e", "is_open": "o", "values": {"sk": "held"}}
    known, read = (sorted((r.id, r.held) for r in asof.asof_interval(kept, held, **names, months=m).collect()) for m in (months, None))
    assert known == read == [(0, 2), (1, 2), (2, None), (3, 1), (4, 1)]


def test_interval_pieces_do_not_follow_outlier_dates(spark):
    day = dt.date
    held = spark.range(50).select(
        F.concat(F.lit("k"), "id").alias("code"), F.lit(day(2020, 1, 1)).alias("s"),
        F.when(F.col("id") == 0, F.lit(day(2999, 12, 31))).otherwise(F.lit(day(9999, 12, 31))).alias("e"),
        (F.col("id") > 0).alias("o"), "id")
    laid = asof.interval_calendar(held, key="code", start="s", stop="e", is_open="o", values=["id"],
                                  months=[day(2019, 12, 1), day(2020, 2, 1), day(2024, 7, 1)])
    assert laid.count() == 100


def test_rate_lookup_by_shuffle(shuffled_joins):
    spark = shuffled_joins
    quotes = spark.range(0, 900, 2).select(
        F.date_add(F.lit("2020-01-03").cast("date"), F.col("id").cast("int")).alias("q"), F.lit("hot").alias("c"),
        (F.col("id") + 0.5).cast("double").alias("r"))
    rated = asof.asof_rates(hot_fact(spark), quotes, day="day", currency="code", quote_day="q", quote_currency="c",
                            quote_rate="r", out="rate")
    row = rated.agg(F.count("*"), F.count("rate")).first()
    assert "SortMergeJoin" in final_plan(rated) and row[0] == 60_000 and 0 < row[1] < 20_000


def test_numbering_by_ranges(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("code"), F.col("id"))
    ranged = keys.with_surrogate_key(df, ["code"], "sk", partitions=7)
    codes = sorted(r.code for r in df.collect())
    assert {r.code: r.sk for r in ranged.collect()} == {c: k + 1 for k, c in enumerate(codes)}
    assert ranged.columns == ["code", "id", "sk"]
    assert keys.with_surrogate_key(df.filter("id < 0"), ["code"], "sk").count() == 0


def test_sums_round_no_addend_and_bear_any_number(spark):
    def total(values):
        return spark.createDataFrame([(v,) for v in values], "v double").transform(exact_sums, [], {"v": F.col("v")}).first()[0]

    assert round(total([10.004] * 12) - 120.048, 9) == 0
    assert abs(total([1e-9] * 1000) - 1e-6) < 1e-18
    assert total([1e25, 1.5, None]) == 1e25 and total([1e300, -1e300, 2.25]) == 2.25
    assert total([None]) is None and total([-0.75, -1.5]) == -2.25


def test_fractions_of_a_key_add_up_beyond_ten_thousand(spark):
    """Partial sums of one key with 50,000 rows, and of a group of such keys."""
    rows = spark.range(100_000).select((F.col("id") % 2).alias("key"), F.lit(0.5).alias("v"))
    parts = partial_sums(rows, ["key"], {"v": F.col("v")})
    for ansi in ("true", "false"):
        with_conf = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = totals(merged(parts, []), [], ["v"]).first()[0]
        finally:
            spark.conf.set("spark.sql.ansi.enabled", with_conf)
        assert got == 50_000.0


def test_shared_folder_is_read_from_the_session(spark):
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = staging.staged(spark.range(3).withColumn("d", F.lit(dt.date(2024, 1, 1))), "kept")
    assert kept.count() == 3 and all(
        staging.shared_folder(spark) in path for path in kept.inputFiles())


def test_a_hot_sale_key_is_split(shuffled_joins):
    """A third of the sales has one order number, which a return names: the join to the named keys splits it."""
    spark = shuffled_joins
    sales = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("order"), (F.col("id") % 2).alias("item"),
        F.sha2(F.col("id").cast("string"), 512).alias("terms"))
    named = spark.createDataFrame([("hot", 0), ("hot", 1), ("hot", 1), ("1", 1), (None, 1), ("none", 0)], "o string, i long").unionByName(
        spark.range(40_000, 80_000).select(F.col("id").cast("string").alias("o"), (F.col("id") % 2).alias("i")))
    found = returns.sale_terms(sales, named, {"o": "order", "i": "item"}, {"terms": "t"})
    got = {(r["_key_order"], r["_key_item"]): (r["_rows"], r["_terms"].t) for r in found.filter("_key_order in ('hot', '1')").collect()}
    assert {k: v[0] for k, v in got.items()} == {("hot", 0): 10_000, ("hot", 1): 10_000, ("1", 1): 1}
    assert "skew=true" in final_plan(found)


def test_routes_are_pruned(spark):
    tagged = quality.tag_rejects(spark.range(100).select((F.col("id") % 5).alias("x")), {"zero": F.col("x") == 0})
    kept = staging.staged(quality.routed(tagged), "routes", [quality.ROUTE])
    accepted, refused = quality.split_routed(kept)
    assert (accepted.count(), accepted.columns, refused.count(), refused.columns) == (80, ["x"], 20, ["x", "motivo_rejeicao"])
    assert "PartitionFilters: [isnotnull(rota" in refused._jdf.queryExecution().executedPlan().toString()


SF = "/root/testdata/sf0.001"


def test_facts_look_keys_up_without_the_treated_dimension(spark):
    """The same numbers as the dimension's, from the columns that it is ordered by and nothing else."""
    dims = ((flows.d_customers, "id_cliente", "sk_cliente", 4), (flows.d_products, "id_produto_chave", "sk_produto", 4))
    for (build, code, sk, width), found in zip(dims, flows.member_keys(spark, SF), strict=True):
        real = build(spark, SF).filter(F.col(sk) > 0)
        assert len(found.columns) == width
        assert {tuple(r) for r in found.select(code, sk).collect()} == {tuple(r) for r in real.select(code, sk).collect()}


def test_reconciliation_values_the_returns_once(spark):
    """One table of typed returns and one of valued ones is written, and both totals read it."""
    def staged(label):
        return {p.name for p in pathlib.Path(staging.run_folder(spark).removeprefix("file:")).glob(f"{label}-*")}

    before = staged("typed-returns"), staged("valued-returns")
    rows = {r.check_name: (r.n_rows, r.total) for r in QUERIES["q_reconcile_returns"](spark, SF).collect()}
    assert rows["silver.devolucoes"] == rows["gold.fDevolucoes"] and rows["gold.fVendas"][0] > 0
    assert [len(staged(label) - old) for label, old in zip(("typed-returns", "valued-returns"), before)] == [1, 1]


def test_one_shuffle_brings_the_interval_and_the_key(shuffled_joins):
    """As two lookups would, also for a row without a day or code, a code of one side only and a code of two members; hot keys are split."""
    spark = shuffled_joins
    day = dt.date
    fact = spark.createDataFrame(
        [(n, code, when) for n, (code, when) in enumerate([
            ("a", day(2020, 5, 1)), ("a", None), (None, day(2020, 5, 1)), (None, None), ("only", day(2020, 5, 1)), ("bare", day(2020, 5, 1)),
            ("twice", day(2020, 5, 1)), ("a", day(2031, 1, 1)), ("a", day(9999, 3, 1)), ("none", day(2020, 5, 1))])], "n int, code string, day date")
    held = spark.createDataFrame(
        [("a", day(2020, 1, 1), day(2020, 6, 1), False, 1), ("a", day(2030, 1, 1), None, True, 2), ("only", day(2020, 1, 1), None, True, 3),
         ("twice", day(2020, 1, 1), None, True, 4)], "code string, s date, e date, o boolean, v int")
    members = spark.createDataFrame([("a", 11), ("bare", 12), ("twice", 13), ("twice", 14), (None, 15)], "code string, sk long")
    names = {"key": "code", "day": "day", "interval_key": "code", "start": "s", "stop": "e", "is_open": "o", "values": {"v": "held"}}
    beside = keys.unique_lookup(members, "code", "sk")
    for months in (None, [], [day(2020, 5, 1), day(2031, 1, 1), day(9999, 3, 1)]):
        once = keys.resolve_key(asof.asof_interval(fact, held, **names, months=months, beside=beside), None, code="code", out="key")
        apart = keys.resolve_key(asof.asof_interval(fact, held, **names, months=months), members, code="code", dim_code="code", dim_sk="sk", out="key")
        assert once.columns == apart.columns and sorted(once.collect()) == sorted(apart.collect())
    assert [r.key for r in once.orderBy("n").collect()] == [11, 11, -1, -1, -1, 12, -1, 11, 11, -1]
    everyone = dimension(spark)
    wide = asof.asof_interval(
        hot_fact(spark), everyone.select("code", F.lit(day(2019, 1, 1)).alias("s"), F.lit(day(2023, 1, 1)).alias("e"), F.lit(False).alias("o"), F.col("sk").alias("v")),
        **names, beside=keys.unique_lookup(everyone, "code", "sk"))
    assert "skew=true" in final_plan(wide) and wide.filter("_sk = 9999 AND held = 9999").count() == 20_000


def shuffle_ids(spark):
    return set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet().toString()[4:-1].split(", "))


def test_a_long_write_leaves_no_shuffles_behind(spark, monkeypatch):
    monkeypatch.setattr(staging, "BRIEF", 0)
    before = shuffle_ids(spark)
    kept = staging.staged(spark.range(1000).repartition(3, "id"), "released")
    late = time.monotonic() + 20
    while shuffle_ids(spark) - before and time.monotonic() < late:
        time.sleep(0.1)
    assert not shuffle_ids(spark) - before and kept.count() == 1000


def test_the_sales_are_shuffled_for_product_and_customer_only(shuffled_joins):
    """One exchange of the whole sales by product and one by customer; the salespeople's joins have two by their own probe."""
    spark = shuffled_joins
    day = "date'2020-05-01'"
    kinds = {"item": "1", "data_emissao": f"date_add({day}, cast(id % 2 AS int))", "quantidade_absoluta": "1", "id_vendedor_ambiguo": "false"}
    names = [c for c in retail.SALES_FACT if not c.startswith("sk_") and c not in ("vendedor_fonte", "id_vendedor_atribuicao")]
    sold = spark.range(20).repartition(2).selectExpr(*[f"{kinds.get(c, 'cast(id AS string)')} AS {c}" for c in [*names, "id_vendedor_ambiguo"]])
    assigned = spark.range(9).selectExpr("cast(id AS string) AS id_cliente", "cast(id + 1 AS string) AS id_vendedor", f"{day} AS vigencia_inicio", "date'2020-05-31' AS vigencia_fim",
                                         "false AS vigencia_aberta", "false AS id_vendedor_ambiguo")
    dims = [spark.range(10).selectExpr(f"cast(id AS string) AS {code}", f"id + 1 AS {sk}") for code, sk in
            (("id_cliente", "sk_cliente"), ("id_produto_chave", "sk_produto"), ("id_vendedor", "sk_vendedor"))]
    fact = retail.sales_fact(sold, assigned, *dims, [dt.date(2020, 5, 1)])
    plan = fact._jdf.queryExecution().executedPlan().toString()
    by = [re.sub(r"#\d+", "", keys_) for keys_ in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    assert len([k for k in by if k.startswith("id_cliente, _probe")]) == 1 and by.count("_probe") == 2
    row = fact.filter("id_pedido = '3'").first()
    assert (row.sk_produto, row.sk_cliente, row.id_vendedor_atribuicao, row.sk_vendedor_responsavel, row.sk_vendedor_pedido) == (4, 4, "4", 5, 4)


def test_the_fact_alone_writes_its_sales_before_prices(spark, monkeypatch):
    """Amounts that follow from other columns are in neither the written table nor its shuffles."""
    landed = flows.valid(spark, SF).filter("id_pedido LIKE 'PV1%'")
    monkeypatch.setattr(flows, "valid", lambda *_: landed)
    seen = []
    monkeypatch.setattr(flows, "staged_with_months", lambda df, label, day: (seen.append(df.columns), (df, [dt.date(1995, 1, 1)]))[1])
    assert flows.f_sales(spark, SF).columns == retail.SALES_FACT
    assert len(seen) == 1 and not {"receita_bruta", "receita_liquida", "taxa_cambio_aplicada"} & set(seen[0])


def written(spark, label):
    return {p.name for p in pathlib.Path(staging.run_folder(spark).removeprefix("file:")).glob(f"{label}-*")}


def test_the_facts_are_counted_one_after_the_other(spark, monkeypatch):
    """A grain is written before the next fact's plan runs, so its shuffles can go."""
    sales = spark.range(9).selectExpr("'s' AS safra", "cast(id % 8 AS string) AS id_pedido", "1 AS item")
    monkeypatch.setattr(flows, "kept_sales_and_months", lambda *_: (sales, []))
    monkeypatch.setattr(flows, "f_sales", lambda *_: sales)
    monkeypatch.setattr(flows, "f_returns", lambda *_: spark.range(4).select(F.col("id").alias("id_devolucao")))
    before = written(spark, "grain")
    rows = {tuple(r) for r in QUERIES["q_fact_grain"](spark, SF).collect()}
    assert rows == {("fVendas", 9, 8), ("fDevolucoes", 4, 4)} and len(written(spark, "grain") - before) == 2


def test_totals_are_written_one_after_the_other(spark, monkeypatch):
    amounts = spark.range(4).selectExpr("id + 0.25D AS receita_devolucao_liquida", "id + 0.5D AS receita_liquida")
    for owner, name, out in ((flows, "kept_sales_and_months", (amounts, [])), (flows, "valued_returns", amounts), (flows, "member_keys", (None, None)),
                             (flows, "portfolio", None), (flows, "d_people", None), (retail, "returns_fact", amounts), (retail, "sales_fact", amounts)):
        monkeypatch.setattr(owner, name, lambda *_, out=out: out)
    before = written(spark, "total")
    rows = {tuple(r) for r in QUERIES["q_reconcile_returns"](spark, SF).collect()}
    assert rows == {("silver.devolucoes", 4, 7.0), ("gold.fDevolucoes", 4, 7.0), ("gold.fVendas", 4, 8.0)}
    assert len(written(spark, "total") - before) == 3


def test_sales_go_once_their_fact_has_them(spark, monkeypatch):
    """The reconciliation keeps the sales with their product keys, not the table before it beside them."""
    day = F.lit(dt.date(2020, 5, 1))
    monkeypatch.setattr(flows, "sales", lambda *_: spark.range(7).select(day.alias("data_emissao")))
    monkeypatch.setattr(flows, "member_keys", lambda *_: (None, None))
    monkeypatch.setattr(retail, "with_product_key", lambda sold, _: sold)
    monkeypatch.setattr(retail, "with_party_keys", lambda sold, *_: sold.select(*[F.lit(0).alias(c) for c in retail.SALES_FACT]))
    for name in ("portfolio", "d_people"):
        monkeypatch.setattr(flows, name, lambda *_: None)
    for name in ("monthly", "f_targets"):
        monkeypatch.setattr(flows, name, lambda *_: spark.range(3))
    tables = written(spark, "sales")
    rows = {r.check_name: r.n_rows for r in QUERIES["q_reconcile_written"](spark, SF).collect()}
    assert rows == {"silver.vendas": 7, "gold.fVendas": 7, "silver.metas_mensais": 3, "gold.fMetas": 3}
    assert {name.rsplit("-", 1)[0] for name in written(spark, "sales") - tables} == {"sales-products"}
