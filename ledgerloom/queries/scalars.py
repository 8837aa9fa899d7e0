"""Scalar operators: text, numbers and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates, parsing, text
from ledgerloom.queries import flows, roles
from ledgerloom.queries.clean_sql import CUSTOMERS, with_
from ledgerloom.queries.registry import query

_LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("q_flexible_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def flexible_date(spark: SparkSession, sf: str) -> DataFrame:
    written = roles.table(spark, sf, "orders").selectExpr(
        "o_orderkey", f"""CASE WHEN o_orderkey % 97 = 0
            THEN element_at(array('31/02/1999', '0000-01-01', '1999/01/02', 'nan', ''), cast(o_orderkey % 5 AS int) + 1)
            ELSE {roles.written_date("cast(o_orderdate AS date)", "o_orderkey")} END AS written""")
    return written.select("o_orderkey", parsing.flexible_date(F.col("written")).alias("parsed"))


@query("q_currency_text", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_orderkey % 71 <> 0 THEN l_extendedprice END AS parsed FROM lineitem""")
def currency_text(spark: SparkSession, sf: str) -> DataFrame:
    written = roles.table(spark, sf, "lineitem").selectExpr(
        *_LINE_ID, f"""if(l_orderkey % 71 = 0, if(l_linenumber % 2 = 0, 'nan', 'n/d'),
            concat(' ', {roles.written_money("l_extendedprice", "l_orderkey")})) AS written""")
    return written.select(*_LINE_ID, parsing.currency_text(F.col("written")).alias("parsed"))


@query("q_decimal_comma", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_orderkey % 3 = 0 AND l_extendedprice >= 1000 THEN NULL ELSE l_extendedprice END AS parsed
FROM lineitem""")
def decimal_comma(spark: SparkSession, sf: str) -> DataFrame:
    amount = "cast(l_extendedprice AS decimal(18, 2))"
    written = roles.table(spark, sf, "lineitem").selectExpr(*_LINE_ID, f"""CASE l_orderkey % 3
        WHEN 0 THEN translate(format_number({amount}, 2), ',.', '.,')
        WHEN 1 THEN replace(cast({amount} AS string), '.', ',')
        ELSE concat(' ', cast({amount} AS string)) END AS written""")
    return written.select(*_LINE_ID, parsing.decimal_comma(F.col("written")).alias("parsed"))


@query("q_match_key", """
SELECT 'C' || c_custkey AS id_cliente,
  CASE WHEN c_custkey % 101 = 0 THEN 'outros'
    WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_custkey % 2 = 0 THEN 'atac' ELSE 'atacado' END
    WHEN c_mktsegment = 'FURNITURE' THEN CASE WHEN c_custkey % 2 = 0 THEN 'poder publico' ELSE 'gov' END
    WHEN c_mktsegment = 'HOUSEHOLD' THEN CASE WHEN c_custkey % 2 = 0 THEN 'industria' ELSE 'ind' END
    ELSE 'varejo' END AS segment_key,
  CASE WHEN c_custkey % 45 = 7 THEN ''
    WHEN n_regionkey = 0 THEN 'norte'
    WHEN n_regionkey = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'nord este' ELSE 'ne' END
    WHEN n_regionkey = 2 THEN CASE WHEN c_custkey % 2 = 0 THEN 'sudest' ELSE 'se' END
    WHEN n_regionkey = 3 THEN 'sul'
    ELSE CASE WHEN c_custkey % 2 = 0 THEN 'centro oeste' ELSE 'co' END END AS region_key
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def match_key(spark: SparkSession, sf: str) -> DataFrame:
    return roles.customers(spark, sf).select(
        F.trim("id_cliente").alias("id_cliente"),
        text.match_key(F.col("segmento")).alias("segment_key"),
        text.match_key(F.col("regiao")).alias("region_key"),
    )


@query("q_canonicalize", with_(CUSTOMERS) + """
SELECT id_cliente, segmento, CASE WHEN c_custkey % 45 <> 7 THEN regiao END AS regiao, situacao FROM cust""")
def canonicalize(spark: SparkSession, sf: str) -> DataFrame:
    from ledgerloom import fixed_values as fv

    return roles.customers(spark, sf).select(
        F.trim("id_cliente").alias("id_cliente"),
        text.canonical(F.col("segmento"), fv.SEGMENT_VARIANTS).alias("segmento"),
        text.canonical(F.col("regiao"), fv.REGION_VARIANTS).alias("regiao"),
        text.canonical(F.col("situacao"), fv.STATUS_VARIANTS).alias("situacao"),
    )


@query("q_title_name", with_(CUSTOMERS) + "SELECT id_cliente, razao_social FROM cust")
def title_name(spark: SparkSession, sf: str) -> DataFrame:
    return roles.customers(spark, sf).select(
        F.trim("id_cliente").alias("id_cliente"), text.title_name(F.col("razao_social")).alias("razao_social"))


@query("q_blank_digits", with_(CUSTOMERS) + """
SELECT id_cliente, cnpj_limpo, length(cnpj_limpo) = 14 AS cnpj_valido, id_matriz FROM cust""")
def blank_digits(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = text.digits(F.col("cnpj"))
    return roles.customers(spark, sf).select(
        F.trim("id_cliente").alias("id_cliente"), cleaned.alias("cnpj_limpo"),
        (F.length(cleaned) == 14).alias("cnpj_valido"),
        text.blank_to_null(F.col("id_matriz")).alias("id_matriz"))


@query("q_infer_fallback", with_(CUSTOMERS) + """
SELECT id_cliente AS member, regiao AS value, regiao_inferida_por_uf AS inferred FROM cust
UNION ALL
SELECT 'P' || p_partkey, """ + "CASE p_size % 15 {} END".format(" ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(roles.SUBCATEGORY_CATEGORIES.values()))) + """,
  p_partkey % 78 = 0 FROM part""")
def infer_fallback(spark: SparkSession, sf: str) -> DataFrame:
    by_state = flows.customers(spark, sf).select(
        F.col("id_cliente").alias("member"), F.col("regiao").alias("value"),
        F.col("regiao_inferida_por_uf").alias("inferred"))
    by_subcategory = flows.products(spark, sf).select(
        F.col("id_produto_chave").alias("member"), F.col("categoria").alias("value"),
        F.col("categoria_inferida_por_subcategoria").alias("inferred"))
    return by_state.unionByName(by_subcategory)


@query("q_scalar_misc", """
SELECT o_orderkey, o_orderpriority AS trimmed, upper(o_orderpriority) AS uppered, lower(o_orderpriority) AS lowered,
  CAST(o_orderkey AS INTEGER) AS whole, abs(CAST(o_custkey AS INTEGER) - 500) AS distance,
  CAST(ceil(month(o_orderdate) / 3.0) AS INTEGER) AS quarter_up,
  lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month_text,
  CASE WHEN o_orderstatus = 'F' THEN 'final' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS status,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS iso,
  coalesce(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END, DATE '2000-01-01') AS filled,
  make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1) AS first_of_month,
  'fixed' AS tag
FROM orders""")
def scalar_misc(spark: SparkSession, sf: str) -> DataFrame:
    landed = roles.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        "concat('  ', o_orderpriority, ' ') AS priority", "concat(' ', o_orderkey) AS number",
        "if(o_orderkey % 4 = 0, '  ', date_format(o_orderdate, 'yyyy-MM-dd')) AS day")
    iso = parsing.iso_date(F.col("day"))
    month = F.month("o_orderdate")
    return landed.select(
        "o_orderkey",
        F.trim("priority").alias("trimmed"),
        F.upper(F.trim("priority")).alias("uppered"),
        F.lower(F.trim("priority")).alias("lowered"),
        parsing.whole_number(F.col("number")).alias("whole"),
        F.abs(F.col("o_custkey").cast("int") - 500).alias("distance"),
        F.ceil(month / 3).cast("int").alias("quarter_up"),
        F.lpad(month.cast("string"), 2, "0").alias("month_text"),
        F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "open")
        .otherwise("other").alias("status"),
        iso.alias("iso"),
        F.coalesce(iso, F.lit("2000-01-01").cast("date")).alias("filled"),
        parsing.month_start(F.year("o_orderdate"), month).alias("first_of_month"),
        F.lit("fixed").alias("tag"),
    )


@query("q_fiscal_parts", """
SELECT o_orderkey,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS ano_fiscal,
  CAST((month(o_orderdate) + 8) % 12 + 1 AS INTEGER) AS mes_fiscal,
  CAST(((month(o_orderdate) + 8) % 12) // 3 + 1 AS INTEGER) AS trimestre_fiscal,
  'FY' || (year(o_orderdate) + CASE WHEN month(o_orderdate) >= 4 THEN 1 ELSE 0 END) AS label_ano_fiscal,
  isodow(o_orderdate) > 5 AS flag_fim_de_semana
FROM orders""")
def fiscal_parts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return roles.table(spark, sf, "orders").select(
        "o_orderkey", dates.fiscal_year(d).alias("ano_fiscal"), dates.fiscal_month(d).alias("mes_fiscal"),
        dates.fiscal_quarter(d).alias("trimestre_fiscal"), dates.fiscal_label(d).alias("label_ano_fiscal"),
        dates.is_weekend(d).alias("flag_fim_de_semana"))
