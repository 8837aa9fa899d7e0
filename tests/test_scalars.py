"""Golden literals of the scalar operators."""

import datetime as dt
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions import dates, money, parsing, text
from ledgerloom.sources.landing import sanitize_name


def apply(spark, fn, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


DATES = {
    "44648": dt.date(2022, 3, 28), "2024": dt.date(1905, 7, 16), "1000": dt.date(1902, 9, 26),
    "05/06/2024": dt.date(2024, 6, 5), "5/6/2024": dt.date(2024, 6, 5), "2024-2-3": dt.date(2024, 2, 3),
    "03-04-2024": dt.date(2024, 4, 3), "07/jan/20": dt.date(2020, 1, 7), "07/JAN/20": dt.date(2020, 1, 7),
    "  29/02/2024\t": dt.date(2024, 2, 29), "1/dez/99": dt.date(2099, 12, 1), "999999": dt.date(4637, 11, 25),
    "07/xyz/20": None, "31/02/2024": None, "0000-01-01": None, "01/01/0000": None, "2024/01/02": None,
    "07/01/20": None, "5/6-2024": None, "2024-13-01": None, "2024-1-1x": None, "123": None, "1234567": None,
    "nan": None, "": None, "   ": None, None: None,
}


def test_flexible_date(spark):
    assert apply(spark, parsing.flexible_date, list(DATES)) == list(DATES.values())


def test_flexible_date_limits(spark):
    assert apply(spark, lambda c: parsing.flexible_date(c, min_serial=10000), ["2024", "44648"]) == [
        None, dt.date(2022, 3, 28)]
    assert apply(spark, lambda c: parsing.flexible_date(c, century=1900), ["7/mar/98"]) == [dt.date(1998, 3, 7)]


def test_decimal_comma(spark):
    given_values = ["5,25", "5.25", "1.234,56", "nan", "", "abc", None, " -3,5 ", "1d", "inf", "1e3"]
    assert apply(spark, parsing.decimal_comma, given_values) == [
        5.25, 5.25, None, None, None, None, None, -3.5, None, None, 1000.0]


def test_currency_text(spark):
    given_values = ["R$ 5.478,44", "135,33", "0.1250", "2599100.0", "R$ 1.135.400,00", "R$ 5.478", "nan", "", None,
                    "1,2,3", "-R$ 5,00", "-5,00", "1,234.5"]
    assert apply(spark, parsing.currency_text, given_values) == [
        5478.44, 135.33, 0.125, 2599100.0, 1135400.0, 5.478, None, None, None, None, None, -5.0, 1.2345]


def test_match_key(spark):
    given_values = ["Poder Público", "Atac.", "CENTRO-OESTE", "  a   b ", None, "São João", "Indústria"]
    assert apply(spark, text.match_key, given_values) == [
        "poder publico", "atac", "centro oeste", "a b", "", "sao joao", "industria"]


def test_fold_table_pairs_letters():
    assert len(text.FOLD_FROM) >= len(text.FOLD_TO)  # what has no partner is dropped
    assert dict(zip(text.FOLD_FROM, text.FOLD_TO))["ç"] == "c"


def test_every_code_point_folds(spark):
    points = [chr(p) for p in range(1, 0x30000) if not 0xD800 <= p < 0xE000]
    texts = ["x".join(points[k : k + 64]) for k in range(0, len(points), 64)]
    texts.append("й ά ﬁ ℌ ½ ㎏ 각 ﷺ e\u0301")
    assert apply(spark, text.fold_accents, texts) == [
        "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]


def test_any_finite_number_is_read(spark):
    values = ["1e100", "9" * 300, "1e400", "9" * 400, "-1e-300", "1e999999999999", "12,5e1"]
    assert apply(spark, parsing.decimal_comma, values) == [1e100, float("9" * 300), None, None, -1e-300, None, 125.0]


def test_canonical(spark):
    segments = ["ATACADO", "Atac.", "gov", "Poder Publico", "Outro", None]
    assert apply(spark, lambda c: text.canonical(c, fv.SEGMENT_VARIANTS), segments) == [
        "Atacado", "Atacado", "Governo", "Governo", None, None]
    regions = ["Nord este", "NE", "sudest", "CO", "centro-oeste", "x"]
    assert apply(spark, lambda c: text.canonical(c, fv.REGION_VARIANTS), regions) == [
        "Nordeste", "Nordeste", "Sudeste", "Centro-Oeste", "Centro-Oeste", None]
    assert apply(spark, lambda c: text.canonical(c, fv.STATUS_VARIANTS), ["A", " inativo "]) == ["Ativo", "Inativo"]


def test_title_name(spark):
    names = ["ECLIPSE GROUP LTDA", "x eireli", "a  me", "y epp", "z s/a", None, "me me", "d'agua 3m", "AÇÚCAR é"]
    assert apply(spark, text.title_name, names) == [
        "Eclipse Group Ltda", "X EIRELI", "A ME", "Y EPP", "Z S/A", None, "ME ME", "D'Agua 3M", "Açúcar É"]


def test_digits_and_blank(spark):
    assert apply(spark, text.digits, ["12.345.678/0001-90", None]) == ["12345678000190", None]
    assert apply(spark, text.blank_to_null, [" ", "", " x "]) == [None, None, "x"]


def test_column_names():
    assert sanitize_name("Meta Ano") == "Meta_Ano"
    assert sanitize_name(" a(b)=c ") == "a_b__c"


def test_fiscal_parts(spark):
    days = [dt.date(2026, 3, 31), dt.date(2026, 4, 1), dt.date(2025, 4, 1), dt.date(2026, 12, 31)]
    parts = lambda c: F.array(dates.fiscal_year(c), dates.fiscal_month(c), dates.fiscal_quarter(c))
    assert apply(spark, parts, days, "date") == [[2026, 12, 4], [2027, 1, 1], [2026, 1, 1], [2027, 9, 3]]
    assert apply(spark, dates.is_weekend, [dt.date(2026, 3, 31), dt.date(2026, 3, 29)], "date") == [False, True]


def test_revenue(spark):
    rows = spark.createDataFrame(
        [("2024", -2, 100.0, 5.0, 0.0, None), ("2024", 2, 100.0, 5.0, 0.125, None), ("2025", 2, 100.0, 5.0, None, "Faturado"),
         ("2025", 2, 100.0, 5.0, 0.5, None)],
        "safra string, q int, p double, r double, d double, s string")
    status = money.unified_status(F.col("safra") == "2024", F.col("q"), F.col("s"))
    gross = money.gross_revenue(F.abs("q"), F.col("p"), F.col("r"), money.is_cancelled(status))
    got = rows.select(status, gross, money.net_of_discount(gross, F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        ("Cancelado", 0.0, 0.0), ("Faturado", 1000.0, 875.0), ("Faturado", 1000.0, None), (None, 1000.0, 500.0)]


def _plain_key(value):
    folded = "".join(ch for ch in unicodedata.normalize("NFKD", value) if not unicodedata.combining(ch))
    spaced = folded.strip().lower().replace(".", " ").replace("-", " ")
    return " ".join(spaced.split())


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="aÀçÕü .- \tZ9ñ", max_size=12), min_size=150, max_size=200))
def test_match_key_property(spark, values):
    assert apply(spark, text.match_key, values) == [_plain_key(v) for v in values]


@pytest.mark.parametrize("bad", ["x", "1.5", "", None])
def test_whole_number(spark, bad):
    assert apply(spark, parsing.whole_number, [bad, " 7 ", "-3"]) == [None, 7, -3]
