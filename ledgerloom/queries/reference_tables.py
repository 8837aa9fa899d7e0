"""Reference tables and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import calendar, quality
from ledgerloom.plans import retail
from ledgerloom.queries import flows, roles
from ledgerloom.queries.clean_sql import CUSTOMERS, PORTFOLIO, SALES, with_
from ledgerloom.queries.registry import query

_PERSON = """
person AS (SELECT s_suppkey, s_name, s_nationkey,
  'V' || (s_suppkey - CASE WHEN s_suppkey % 10 = 9 THEN 1 ELSE 0 END) AS id_vendedor FROM supplier)"""


@query("q_customers", with_(CUSTOMERS) + """
SELECT id_cliente, razao_social, cnpj_limpo, segmento, regiao, uf, cidade, data_cadastro, id_matriz, situacao,
  regiao_inferida_por_uf, length(cnpj_limpo) = 14 AS cnpj_valido,
  cnpj_limpo <> '' AND count(*) OVER (PARTITION BY cnpj_limpo) > 1 AS cnpj_duplicado FROM cust""")
def customers(spark: SparkSession, sf: str) -> DataFrame:
    return flows.customers(spark, sf).select(
        "id_cliente", "razao_social", "cnpj_limpo", "segmento", "regiao", "uf", "cidade", "data_cadastro",
        "id_matriz", "situacao", "regiao_inferida_por_uf", "cnpj_valido", "cnpj_duplicado")


@query("q_products", """
SELECT 'P' || p_partkey AS id_produto_chave, p_name AS descricao, p_brand AS linha,
  p_retailprice AS custo_padrao, CASE WHEN p_partkey % 91 <> 5 THEN p_retailprice END AS preco_lista,
  p_partkey % 10 = 0 AS descontinuado, p_partkey % 78 = 0 AS categoria_inferida_por_subcategoria FROM part""")
def products(spark: SparkSession, sf: str) -> DataFrame:
    return flows.products(spark, sf).select(
        "id_produto_chave", "descricao", "linha", "custo_padrao", "preco_lista", "descontinuado",
        "categoria_inferida_por_subcategoria")


@query("q_salespeople", with_(_PERSON) + """
SELECT id_vendedor, s_name AS nome, lower(s_name) || '@example.com' AS email_corporativo, 'Vendedor' AS cargo,
  'R' || (s_nationkey % 5) AS regiao, 'V' || (s_suppkey % 7) AS id_gestor,
  CAST(DATE '1992-03-01' + CAST(s_suppkey % 900 AS INTEGER) AS DATE) AS data_admissao,
  CASE WHEN s_suppkey % 7 = 0 THEN CAST(DATE '2000-01-15' + CAST(s_suppkey % 300 AS INTEGER) AS DATE) END
    AS data_desligamento,
  s_suppkey % 7 <> 0 AS vendedor_ativo, count(*) OVER (PARTITION BY id_vendedor) > 1 AS id_vendedor_duplicado
FROM person""")
def salespeople(spark: SparkSession, sf: str) -> DataFrame:
    return flows.people(spark, sf)


@query("q_portfolio", with_(_PERSON, PORTFOLIO) + """
SELECT id_cliente, id_vendedor, vigencia_inicio, vigencia_fim, vigencia_fim = DATE '9999-12-31' AS vigencia_aberta,
  id_vendedor IN (SELECT id_vendedor FROM person GROUP BY 1 HAVING count(*) > 1) AS id_vendedor_ambiguo
FROM portfolio""")
def portfolio(spark: SparkSession, sf: str) -> DataFrame:
    return flows.portfolio(spark, sf)


@query("q_quotes", with_(SALES) + """
SELECT d AS data_cotacao, 'USD' AS moeda, rate AS taxa_ptax_venda FROM quote""")
def quotes(spark: SparkSession, sf: str) -> DataFrame:
    return flows.quotes(spark, sf)


@query("q_holidays", """
SELECT d AS data, 'Feriado ' || strftime(d, '%d/%m') || ' ' || copy AS descricao,
  CASE WHEN day(d) = 7 THEN 'Nacional' ELSE 'Estadual' END AS abrangencia
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) JOIN (VALUES ('A'), ('B')) AS t(copy)
  ON copy = 'A' OR month(d) = 9
WHERE day(d) IN (7, 20)""")
def holidays(spark: SparkSession, sf: str) -> DataFrame:
    return retail.holidays(roles.holidays(spark, sf))


@query("q_access_rules", """
SELECT lower(s_name) || '@example.com' AS email, s_name AS nome, 'Gerente' AS perfil,
  'R' || (s_nationkey % 5) AS regiao_permitida, 'TODOS' AS segmento_permitido, s_suppkey % 4 <> 0 AS ativo
FROM supplier""")
def access_rules(spark: SparkSession, sf: str) -> DataFrame:
    return retail.access_rules(roles.access_rules(spark, sf))


_CALENDAR = """
cal AS (
  SELECT CAST(g AS DATE) AS data,
    CAST(strftime(g, '%Y%m%d') AS INTEGER) AS data_sk, CAST(year(g) AS INTEGER) AS ano,
    CAST(month(g) AS INTEGER) AS mes, CAST(day(g) AS INTEGER) AS dia, CAST(quarter(g) AS INTEGER) AS trimestre,
    monthname(g) AS nome_mes, strftime(g, '%b') AS nome_mes_abrev, strftime(g, '%Y-%m') AS ano_mes,
    dayname(g) AS nome_dia_semana, CAST(dayofweek(g) + 1 AS INTEGER) AS numero_dia_semana,
    isodow(g) > 5 AS flag_fim_de_semana,
    CAST(year(g) + CASE WHEN month(g) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS ano_fiscal,
    CAST((month(g) + 8) % 12 + 1 AS INTEGER) AS mes_fiscal,
    CAST(((month(g) + 8) % 12) // 3 + 1 AS INTEGER) AS trimestre_fiscal,
    'FY' || (year(g) + CASE WHEN month(g) >= 4 THEN 1 ELSE 0 END) AS label_ano_fiscal,
    h.d IS NOT NULL AS flag_feriado_nacional,
    CASE WHEN h.d IS NOT NULL THEN 'Feriado ' || strftime(g, '%d/%m') || ' A' END AS nome_feriado,
    isodow(g) <= 5 AND h.d IS NULL AS flag_dia_util
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS g FROM orders)
  LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE day(o_orderdate) = 7) h
    ON h.d = CAST(g AS DATE))"""


@query("q_calendar", with_(_CALENDAR) + """
SELECT c.*, coalesce(n, 0) AS n_orders FROM cal c
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) ON d = data""")
def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    per_day = roles.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("data")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return flows.order_calendar(spark, sf).join(per_day, "data", "left").na.fill(0, ["n_orders"])


@query("q_fiscal_days", with_(_CALENDAR) + """
SELECT label_ano_fiscal, count(*) AS dias_total, count(*) FILTER (WHERE flag_dia_util) AS dias_uteis
FROM cal GROUP BY 1""")
def fiscal_days(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.working_days(flows.order_calendar(spark, sf))


@query("q_fiscal_boundary", with_(_CALENDAR) + """
SELECT data, ano, mes, ano_fiscal, label_ano_fiscal, mes_fiscal, trimestre_fiscal, nome_dia_semana FROM cal
WHERE data BETWEEN DATE '1998-03-28' AND DATE '1998-04-03'""")
def fiscal_boundary(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.between_days(flows.order_calendar(spark, sf), "1998-03-28", "1998-04-03").select(
        "data", "ano", "mes", "ano_fiscal", "label_ano_fiscal", "mes_fiscal", "trimestre_fiscal",
        "nome_dia_semana").orderBy("data")


@query("q_dup_flag", with_(CUSTOMERS, _PERSON) + """
SELECT 'salesperson' AS kind, s_name AS member, count(*) OVER (PARTITION BY id_vendedor) > 1 AS duplicated
FROM person
UNION ALL
SELECT 'customer', id_cliente, cnpj_limpo <> '' AND count(*) OVER (PARTITION BY cnpj_limpo) > 1 FROM cust""")
def dup_flag(spark: SparkSession, sf: str) -> DataFrame:
    persons = flows.people(spark, sf).select(
        F.lit("salesperson").alias("kind"), F.col("nome").alias("member"),
        F.col("id_vendedor_duplicado").alias("duplicated"))
    return persons.unionByName(flows.customers(spark, sf).select(
        F.lit("customer").alias("kind"), F.col("id_cliente").alias("member"),
        F.col("cnpj_duplicado").alias("duplicated")))


@query("q_coverage", with_(CUSTOMERS) + """
SELECT 'segmento' AS field, 'Outros' AS original, count(*) AS n_rows FROM cust WHERE segmento IS NULL
HAVING count(*) > 0
UNION ALL
SELECT 'regiao', CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '  ' END, count(*) FROM cust WHERE regiao IS NULL
GROUP BY 2""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    treated = flows.customers(spark, sf)
    parts = [
        quality.unmapped(treated, field, f"{field}_original").select(
            F.lit(field).alias("field"), F.col(f"{field}_original").alias("original"), "n_rows")
        for field in ("segmento", "regiao", "situacao", "data_cadastro")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
