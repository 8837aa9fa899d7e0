"""Sales flow: harmonise, remove duplicates, reject, convert, price, attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.operators.sums import exact_sums
from ledgerloom.plans import retail
from ledgerloom.queries import flows, roles
from ledgerloom.queries.clean_sql import LINES, PORTFOLIO, SALES, exact, with_
from ledgerloom.queries.registry import query

_COMMON = """safra, id_pedido, item, data_emissao, id_cliente, id_produto, id_vendedor, quantidade, valor_unitario,
  desconto_fracao, moeda, canal"""
_SOURCE_STATUS = "CASE WHEN safra <> '2024' THEN status_pedido END AS status_pedido_origem"


@query("q_harmonize", with_(LINES) + f"""
SELECT {_COMMON}, {_SOURCE_STATUS}, id_filial, frete_rateado
FROM line, unnest(range(copies)) AS u(c)""")
def harmonize(spark: SparkSession, sf: str) -> DataFrame:
    return flows.landed(spark, sf)


@query("q_discount_unit", f"""
SELECT CASE l_orderkey % 3 WHEN 0 THEN '2024' WHEN 1 THEN '2025' ELSE '2026' END AS safra, count(*) AS n_rows,
  max(l_discount) AS highest, round({exact("l_discount")}, 4) AS total
FROM lineitem, unnest(range(CASE WHEN l_orderkey % 3 = 1 AND (l_orderkey + l_partkey) % 29 = 0 THEN 2 ELSE 1 END))
  AS u(c) GROUP BY 1""")
def discount_unit(spark: SparkSession, sf: str) -> DataFrame:
    share = F.col("desconto_fracao")
    return exact_sums(flows.landed(spark, sf), ["safra"], {"total": share}, rows="n_rows", most={"highest": share}).withColumn(
        "total", F.round("total", 4))


@query("q_dedup", with_(LINES) + f"SELECT {_COMMON}, {_SOURCE_STATUS}, id_filial, frete_rateado FROM line")
def dedup(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_exact_duplicates(flows.landed(spark, sf))


@query("q_dedup_accounting", with_(LINES) + """
SELECT safra, CAST(sum(copies) AS BIGINT) AS rows_before, count(*) AS rows_after,
  CAST(sum(copies) - count(*) AS BIGINT) AS rows_removed FROM line GROUP BY 1""")
def dedup_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_accounting(flows.landed(spark, sf), ["safra"])


@query("q_rejects", with_(LINES) + f"""
SELECT {_COMMON}, motivo_rejeicao FROM tagged WHERE motivo_rejeicao <> ''""")
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return flows.rejected(spark, sf).drop("status_pedido_origem", "id_filial", "frete_rateado")


@query("q_reject_counts", with_(LINES) + """
SELECT 'vendas' AS fonte, safra, motivo_rejeicao AS motivo, count(*) AS quantidade FROM tagged
WHERE motivo_rejeicao <> '' GROUP BY safra, motivo_rejeicao""")
def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reject_counts(flows.rejected(spark, sf), "vendas").orderBy("safra", "motivo")


@query("q_fx_asof", with_(SALES) + """
SELECT safra, id_pedido, item, data_emissao, moeda, taxa_cambio_aplicada FROM rated""")
def fx_asof(spark: SparkSession, sf: str) -> DataFrame:
    return retail.rated_sales(flows.valid(spark, sf), flows.quotes(spark, sf)).select(
        "safra", "id_pedido", "item", "data_emissao", "moeda", "taxa_cambio_aplicada")


@query("q_fx_currencies", """
WITH day AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
quote AS (
  SELECT 'USD' AS cur, d, CAST(CAST(4500 + ((d - DATE '1990-01-01') * 7919) % 2000 AS DOUBLE) / 1000 AS DOUBLE) AS rate
  FROM day WHERE isodow(d) <= 5 AND d >= DATE '1995-01-16'
  UNION ALL SELECT 'EUR', d, CAST(CAST(5500 + ((d - DATE '1990-01-01') * 104729) % 2000 AS DOUBLE) / 1000 AS DOUBLE)
  FROM day WHERE day(d) % 3 = 1 AND d >= DATE '1994-06-01')
SELECT o_orderkey, o.cur AS moeda, CASE WHEN o.cur = 'BRL' THEN 1.0::DOUBLE ELSE q.rate END AS taxa
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
        CASE o_custkey % 4 WHEN 0 THEN 'BRL' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS cur FROM orders) o
ASOF LEFT JOIN quote q ON o.cur = q.cur AND o.d >= q.d""")
def fx_currencies(spark: SparkSession, sf: str) -> DataFrame:
    """Two quoted currencies with days of their own, the base currency, and one without quotes."""
    from ledgerloom.operators.asof import convert_currency

    dated = roles.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate AS date) AS d",
        "element_at(array('BRL', 'USD', 'EUR', 'GBP'), cast(o_custkey % 4 AS int) + 1) AS moeda")
    days = dated.select("d").distinct()
    usd = days.filter("dayofweek(d) BETWEEN 2 AND 6 AND d >= date'1995-01-16'").selectExpr(
        "'USD' AS cur", "d AS quoted", "(4500 + (datediff(d, date'1990-01-01') * 7919) % 2000) / 1000D AS rate")
    eur = days.filter("day(d) % 3 = 1 AND d >= date'1994-06-01'").selectExpr(
        "'EUR' AS cur", "d AS quoted", "(5500 + (datediff(d, date'1990-01-01') * 104729) % 2000) / 1000D AS rate")
    return convert_currency(
        dated, usd.unionByName(eur), day="d", currency="moeda", base="BRL", quote_day="quoted", quote_currency="cur",
        quote_rate="rate", out="taxa").select("o_orderkey", "moeda", "taxa")


@query("q_status", with_(LINES) + """
SELECT safra, status_pedido, count(*) AS n_rows, CAST(sum(abs(quantidade)) AS BIGINT) AS quantidade
FROM tagged WHERE motivo_rejeicao = '' GROUP BY 1, 2""")
def status(spark: SparkSession, sf: str) -> DataFrame:
    return retail.priced_sales(flows.valid(spark, sf).withColumn("taxa_cambio_aplicada", F.lit(1.0))).groupBy(
        "safra", "status_pedido").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantidade_absoluta").alias("quantidade"))


@query("q_revenue", with_(SALES) + f"""
SELECT safra, count(*) AS n_rows, round({exact("receita_bruta")}, 4) AS receita_bruta, round({exact("receita_liquida")}, 4) AS receita_liquida,
  round({exact("receita_liquida")}, 2) AS receita_liquida_total FROM sale GROUP BY 1""")
def revenue(spark: SparkSession, sf: str) -> DataFrame:
    summed = exact_sums(
        flows.sales(spark, sf), ["safra"], {c: F.col(c) for c in ("receita_bruta", "receita_liquida")}, rows="n_rows")
    return summed.select(
        "safra", "n_rows", F.round("receita_bruta", 4).alias("receita_bruta"), F.round("receita_liquida", 4).alias("receita_liquida"),
        F.round("receita_liquida", 2).alias("receita_liquida_total"))


_SALE_COLUMNS = ["safra", "id_pedido", "item", "data_emissao", "id_cliente", "id_produto", "id_produto_chave",
                 "id_vendedor", "id_vendedor_ambiguo", "quantidade", "quantidade_absoluta", "valor_unitario",
                 "desconto_fracao", "moeda", "canal", "id_filial", "frete_rateado", "taxa_cambio_aplicada",
                 "status_pedido", "receita_bruta", "receita_liquida"]


@query("q_sales", with_(SALES) + f"SELECT {', '.join(_SALE_COLUMNS)} FROM sale")
def sales(spark: SparkSession, sf: str) -> DataFrame:
    return flows.sales(spark, sf).select(*_SALE_COLUMNS)


ATTRIBUTION = """
held AS (
  SELECT s.*, p.id_vendedor AS via_carteira
  FROM (SELECT *, row_number() OVER () AS rid FROM sale) s
  LEFT JOIN portfolio p ON s.id_cliente = p.id_cliente AND p.vigencia_inicio <= s.data_emissao
    AND p.vigencia_fim >= s.data_emissao
  QUALIFY row_number() OVER (PARTITION BY s.rid ORDER BY p.vigencia_inicio DESC NULLS LAST) = 1),
attributed AS (
  SELECT *, coalesce(via_carteira, id_vendedor) AS id_vendedor_atribuicao,
    CASE WHEN via_carteira IS NOT NULL THEN via_carteira IN (SELECT id_vendedor FROM shared)
      ELSE id_vendedor_ambiguo END AS vendedor_ambiguo_atribuicao,
    CASE WHEN via_carteira IS NOT NULL THEN 'carteira_historica'
      WHEN id_vendedor IS NOT NULL THEN 'pedido_original_sem_carteira' ELSE 'sem_vendedor' END AS vendedor_fonte
  FROM held)"""


@query("q_interval_asof", with_(PORTFOLIO) + """
SELECT o_orderkey, o_custkey, p.id_vendedor, p.vigencia_inicio
FROM orders LEFT JOIN portfolio p ON 'C' || o_custkey = p.id_cliente
  AND p.vigencia_inicio <= CAST(o_orderdate AS DATE) AND p.vigencia_fim >= CAST(o_orderdate AS DATE)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY p.vigencia_inicio DESC NULLS LAST) = 1""")
def interval_asof(spark: SparkSession, sf: str) -> DataFrame:
    from ledgerloom.operators.asof import asof_interval

    dated = roles.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.concat(F.lit("C"), "o_custkey").alias("buyer"),
        F.col("o_orderdate").cast("date").alias("day"))
    assigned = flows.portfolio(spark, sf).withColumn("since", F.col("vigencia_inicio"))
    return asof_interval(
        dated, assigned, key="buyer", day="day", interval_key="id_cliente", start="vigencia_inicio",
        stop="vigencia_fim", is_open="vigencia_aberta",
        values={"id_vendedor": "id_vendedor", "since": "vigencia_inicio"}).drop("buyer", "day")


@query("q_attribution", with_(SALES, PORTFOLIO, ATTRIBUTION) + """
SELECT safra, id_pedido, item, id_vendedor_atribuicao, vendedor_ambiguo_atribuicao, vendedor_fonte FROM attributed""")
def attribution(spark: SparkSession, sf: str) -> DataFrame:
    sold, months = flows.kept_sales_and_months(spark, sf)
    return retail.attributed_sales(sold, flows.portfolio(spark, sf), months).select(
        "safra", "id_pedido", "item", "id_vendedor_atribuicao", "vendedor_ambiguo_atribuicao", "vendedor_fonte")


@query("q_latest_per_key", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    from ledgerloom.operators.asof import latest_per_key as latest

    dated = roles.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest(dated, ["o_custkey"], ["o_orderdate", "o_orderkey"])
