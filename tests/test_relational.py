"""Tiny tables per relational operator: nulls, ties, orphans, duplicates, boundaries."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.operators import asof, calendar, keys, marts, quality, returns, targets

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_rates(spark):
    quotes = spark.createDataFrame(
        [(D(2024, 1, 5), "USD", 5.0), (D(2024, 1, 8), "USD", 6.0), (D(2024, 1, 8), "USD", 5.5), (None, "USD", 9.0)],
        "q date, c string, r double")
    fact = spark.createDataFrame(
        [(1, D(2024, 1, 5), "USD"), (2, D(2024, 1, 6), "usd "), (3, D(2024, 1, 7), "USD"), (4, D(2024, 1, 8), "USD"),
         (5, D(2024, 1, 4), "USD"), (6, D(2030, 1, 1), "USD"), (7, D(2024, 1, 6), "BRL"), (8, D(2024, 1, 6), None),
         (9, None, "USD"), (10, D(2024, 1, 6), "EUR")], "id int, d date, m string")

    def convert():
        return rows(asof.convert_currency(
            fact, quotes, day="d", currency="m", base="BRL", quote_day="q", quote_currency="c", quote_rate="r",
            out="rate").select("id", "rate"), "id")

    expected = [(1, 5.0), (2, 5.0), (3, 5.0), (4, 6.0), (5, None), (6, 6.0), (7, 1.0), (8, None), (9, None), (10, None)]
    assert convert() == expected
    quotes = quotes.unionByName(spark.createDataFrame([(D(9999, 12, 31), "USD", 7.0)], quotes.schema))
    assert convert() == expected


def test_rates_without_quotes(spark):
    quotes = spark.createDataFrame([], "q date, c string, r double")
    fact = spark.createDataFrame([(1, D(2024, 1, 5), "USD")], "id int, d date, m string")
    got = asof.asof_rates(fact, quotes, day="d", currency="m", quote_day="q", quote_currency="c", quote_rate="r", out="x")
    assert got.collect()[0].x is None


def _interval(spark, facts, intervals):
    fact = spark.createDataFrame(facts, "id int, k string, d date")
    table = spark.createDataFrame(intervals, "k string, who string, s date, e date").withColumn(
        "o", F.col("e") == F.lit(fv.OPEN_END).cast("date"))
    got = asof.asof_interval(
        fact, table, key="k", day="d", interval_key="k", start="s", stop="e", is_open="o", values={"who": "held"})
    return rows(got.select("id", "held"), "id")


def test_interval(spark):
    intervals = [
        ("a", "A1", D(2024, 1, 1), D(2024, 1, 10)), ("a", "A2", D(2024, 1, 8), D(9999, 12, 31)),
        ("b", "B1", D(2024, 1, 1), D(2024, 1, 10)), ("b", "B2", D(2024, 1, 20), D(2024, 3, 31)),
        ("c", "C1", D(2023, 1, 1), D(9999, 12, 31)), ("c", "C2", D(2024, 1, 5), D(2024, 1, 7)),
        ("d", "D1", D(2024, 1, 1), None), ("d", "D2", None, D(2024, 2, 1)), ("d", "D3", D(2024, 2, 1), D(2024, 1, 1)),
        (None, "N", D(2024, 1, 1), D(9999, 12, 31)),
    ]
    facts = [
        (1, "a", D(2024, 1, 7)), (2, "a", D(2024, 1, 8)), (3, "a", D(2024, 1, 10)), (4, "a", D(2050, 6, 1)),
        (5, "b", D(2024, 1, 10)), (6, "b", D(2024, 1, 15)), (7, "b", D(2024, 2, 15)), (8, "b", D(2024, 4, 1)),
        (9, "c", D(2024, 1, 6)), (10, "c", D(2024, 1, 8)), (11, "c", D(2022, 12, 31)), (12, "d", D(2024, 1, 15)),
        (13, "zz", D(2024, 1, 1)), (14, None, D(2024, 1, 1)), (15, "a", None),
    ]
    assert _interval(spark, facts, intervals) == [
        (1, "A1"), (2, "A2"), (3, "A2"), (4, "A2"), (5, "B1"), (6, None), (7, "B2"), (8, None), (9, "C2"),
        (10, "C1"), (11, None), (12, None), (13, None), (14, None), (15, None)]


def test_interval_against_brute_force(spark):
    draw = random.Random(7)
    origin = D(2020, 1, 1)
    intervals = []
    for n in range(120):
        start = origin + dt.timedelta(days=draw.randrange(900))
        end = D(9999, 12, 31) if draw.random() < 0.2 else start + dt.timedelta(days=draw.randrange(-3, 400))
        intervals.append((f"k{draw.randrange(4)}", f"w{n:03d}", start, end))
    facts = [(i, f"k{draw.randrange(5)}", origin + dt.timedelta(days=draw.randrange(-30, 1500))) for i in range(800)]

    def best(key, day):
        held = [(s, w) for k, w, s, e in intervals if k == key and s <= day <= e]
        return max(held)[1] if held else None

    assert _interval(spark, facts, intervals) == [(i, best(k, d)) for i, k, d in facts]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")], "k string, o int, v string")
    assert rows(asof.latest_per_key(df, ["k"], ["o"]), "k") == [("a", 2, "z"), ("b", None, "q")]


def test_resolve_key(spark):
    dim = spark.createDataFrame([("V1", 1), ("V2", 2), ("V2", 3), ("N/A", 0), ("V1_AMB", -2)], "code string, sk long")
    fact = spark.createDataFrame(
        [(1, None, False), (2, "V2", True), (3, "V9", False), (4, "V1", None), (5, "V2", False), (6, "N/A", False)],
        "id int, c string, amb boolean")
    got = keys.resolve_key(fact, dim, code="c", dim_code="code", dim_sk="sk", out="sk", ambiguous="amb", missing=0)
    assert rows(got.select("id", "sk"), "id") == [(1, 0), (2, -2), (3, -1), (4, 1), (5, -1), (6, -1)]
    plain = keys.resolve_key(fact, dim, code="c", dim_code="code", dim_sk="sk", out="sk")
    assert rows(plain.select("id", "sk"), "id") == [(1, -1), (2, -1), (3, -1), (4, 1), (5, -1), (6, -1)]


def test_surrogate_and_sentinels(spark):
    df = spark.createDataFrame([("c", True), ("a", False), ("b", True)], "code string, f boolean")
    numbered = keys.with_surrogate_key(df, ["code"], "sk")
    dim = keys.with_sentinels(numbered, [{"sk": -1, "code": "N/A"}])
    assert rows(dim, "sk") == [("N/A", None, -1), ("a", False, 1), ("b", True, 2), ("c", True, 3)]


def test_hierarchy(spark):
    df = spark.createDataFrame(
        [("h", None, "Head"), ("b", "h", "Branch"), ("o", "gone", "Orphan"), ("b2", "b", "Deep"), ("n", None, None),
         ("u", "n", "Under")],
        "id string, up string, name string")
    got = keys.flatten_hierarchy(
        df, member="id", parent="up", name="name", group="g", group_name="gn", is_head="head", orphan="lost",
        orphan_label=fv.ORPHAN_PARENT_LABEL)
    assert rows(got.select("id", "g", "gn", "head", "lost"), "id") == [
        ("b", "h", "Head", False, False), ("b2", "b", "Branch", False, False), ("h", "h", "Head", True, False),
        ("n", "n", None, True, False), ("o", "gone", "Matriz não encontrada (gone)", False, True),
        ("u", "n", "Under", False, False)]


def test_conformed_dimension(spark):
    one = spark.createDataFrame([("Sul", "Varejo"), ("Sul", None), ("Norte", "Governo")], "r string, s string")
    two = spark.createDataFrame([("Sul", "Varejo"), ("Sul", "Atacado")], "r string, s string")
    assert rows(keys.conformed_dimension([one, two], ["r", "s"], "sk"), "sk") == [
        ("Norte", "Governo", 1), ("Sul", "Atacado", 2), ("Sul", "Varejo", 3)]


def test_duplicates(spark):
    df = spark.createDataFrame([("k", 1), ("k", 1), ("k", 2), ("z", 3), (None, 4), (None, 5), ("", 6), ("", 7)], "k string, v int")
    assert quality.drop_exact_duplicates(df).count() == 7
    assert rows(quality.flag_duplicates(df, "k", "dup").select("v", "dup"), "v") == [
        (1, True), (1, True), (2, True), (3, False), (4, False), (5, False), (6, False), (7, False)]
    assert rows(quality.repeated_keys(df.filter("k <> ''"), ["k"])) == [("k", 3)]
    flagged = quality.flag_duplicates(df, "k", "dup")
    used = quality.flag_ambiguous(spark.createDataFrame([("k",), ("z",), (None,)], "c string"), "c", flagged, "k", "dup", "amb")
    assert rows(used, "c") == [(None, False), ("k", True), ("z", False)]
    accounting = quality.duplicate_accounting(df.filter("k <> ''"), ["k"])
    assert rows(accounting, "k") == [("k", 3, 2, 1), ("z", 1, 1, 0)]


def test_rejects(spark):
    df = spark.createDataFrame([(1, 1.0, "x"), (None, None, None), (2, None, "x")], "q int, p double, d string")
    rules = {fv.MISSING_QUANTITY: F.col("q").isNull(), fv.MISSING_PRICE: F.col("p").isNull(),
             fv.INVALID_DATE: F.col("d").isNull()}
    valid, rejected = quality.split_rejects(df, rules)
    assert rows(valid) == [(1, 1.0, "x")]
    assert rows(rejected.select("motivo_rejeicao"), "motivo_rejeicao") == [
        ("quantidade_ausente; valor_ausente; data_invalida",), ("valor_ausente",)]


def test_orphan_keys(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    dim = spark.createDataFrame([("a",)], "pk string")
    assert rows(quality.orphan_keys(fact, "fk", dim, "pk")) == [("b",)]
    assert quality.orphan_keys(fact, "fk", dim, "pk", ignore_nulls=False).count() == 2


def test_returns(spark):
    sales = spark.createDataFrame(
        [("p1", 1, "2024", 10.0, 0.1, 2.0, "Faturado", 5), ("p2", 1, "2025", 10.0, 0.0, 1.0, "Cancelado", 5),
         ("p3", 1, "2025", 10.0, 0.0, 1.0, None, 5), ("p4", 1, "2024", 1.0, 0.0, 1.0, "Faturado", 5),
         ("p4", 1, "2025", 2.0, 0.0, 1.0, "Faturado", 5)],
        "ped string, item int, safra string, preco double, desc double, taxa double, st string, qtd int")
    back = spark.createDataFrame(
        [(1, "p1", 1, 2), (2, "p2", 1, 2), (3, "gone", 1, 2), (4, "p1", 1, 6), (5, "p3", 1, 1), (6, "p4", 1, 1)],
        "id int, ped_o string, item int, q int")
    terms = {c: f"{c}_o" for c in ("safra", "preco", "desc", "taxa", "st", "qtd")}
    got = returns.value_returns(
        back, sales, on={"ped_o": "ped", "item": "item"}, terms=terms, quantity="q", layout="safra_o",
        price="preco_o", discount="desc_o", rate="taxa_o", status="st_o", billed="qtd_o")
    picked = got.select(
        "id", "pedido_origem_encontrado", "quantidade_excede_faturado", "devolucao_de_pedido_cancelado",
        "origem_ambigua", "receita_devolucao_bruta", "receita_devolucao_liquida")
    assert rows(picked, "id") == [
        (1, True, False, False, False, 40.0, 36.0), (2, True, False, True, False, 0.0, 0.0),
        (3, False, False, None, False, None, None), (4, True, True, False, False, 120.0, 108.0),
        (5, True, False, False, False, 10.0, 10.0), (6, True, False, False, True, 2.0, 2.0)]
    orphans = returns.orphan_returns(got, ["id", "ped_o", "item"])
    landed = spark.createDataFrame([("gone", 1), ("gone", 1)], "ped string, item int")
    assert rows(returns.explain_orphans(orphans, landed, {"ped_o": "ped", "item": "item"}, "out").select("id", "out")) == [
        (3, True)]


def _grid(spark):
    months = [m.capitalize() for m in fv.MONTH_NUMBERS]
    names = ["Regiao", "Segmento", *months, "Meta_Ano"]
    values = [
        ("SUL", "ATACADO", *["R$ 1.000,50"] * 11, None, "12000"),
        ("NORTE", "GOVERNO", *["10"] * 12, "120.0"),
        ("Total Geral ", None, *["1.010,50"] * 11, "10", "12.120,00"),
        (None, None, *[None] * 12, None),
        ("Obs: texto", None, *[None] * 12, None),
    ]
    return spark.createDataFrame(values, ", ".join(f"{n} string" for n in names))


def test_targets(spark):
    typed = targets.typed_grid(_grid(spark), 2024)
    detail, totals = targets.detail_rows(typed), targets.totals_rows(typed)
    assert (detail.count(), totals.count()) == (2, 1)
    monthly = targets.monthly_targets(detail)
    assert monthly.count() == 24
    december = monthly.filter("mes = 12").select("regiao", "meta_mensal", "data_referencia")
    assert rows(december, "regiao") == [("Norte", 10.0, D(2024, 12, 1)), ("Sul", None, D(2024, 12, 1))]
    annual = targets.annual_targets(detail)
    assert rows(annual, "regiao") == [(2024, "Norte", "Governo", 120.0), (2024, "Sul", "Atacado", 12000.0)]
    assert {r.diferenca for r in targets.control_totals(monthly, totals).collect()} == {0.0}
    assert [(r.regiao, r.diferenca) for r in targets.annual_divergence(monthly, annual).collect()] == [("Sul", 994.5)]
    assert rows(targets.undefined_targets(monthly)) == [("Sul", "Atacado", 12, 1)]


def test_calendar(spark):
    days = calendar.date_spine(calendar.literal_bounds(spark, "2023-01-01", "2027-03-31"), "start", "stop")
    off = spark.createDataFrame(
        [(D(2024, 1, 1), "Ano novo"), (D(2024, 1, 1), "Confraternização"), (D(2024, 5, 1), "Trabalho")],
        "data date, descricao string")
    cal = calendar.calendar(days, off)
    assert cal.count() == 1551
    one = cal.filter("data = '2024-01-01'").collect()
    assert len(one) == 1 and one[0].flag_feriado_nacional and not one[0].flag_dia_util and one[0].nome_feriado == "Ano novo"
    assert rows(calendar.working_days(cal), "label_ano_fiscal")[0] == ("FY2023", 90, 65)
    assert calendar.between_days(cal, "2026-03-28", "2026-04-03").count() == 7
    named = calendar.calendar(days, off, names={"January": "Janeiro"}).filter("mes = 1").select("nome_mes").distinct()
    assert rows(named) == [("Janeiro",)]


def test_attainment_blank_without_target(spark):
    goal = spark.createDataFrame([("a", 10.0), ("b", None), ("c", 0.0), ("d", 5.0)], "k string, t double")
    done = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("c", 1.0)], "k string, v double")
    got = marts.attainment(done, goal, ["k"], "v", "t", "pct")
    assert rows(got.select("k", "pct"), "k") == [("a", 0.5), ("b", None), ("c", None), ("d", None)]
