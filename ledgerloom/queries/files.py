"""Sources and sinks: extracts are written from the tables in each charset and delimiter, then landed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import parsing
from ledgerloom.operators import targets
from ledgerloom.plans import retail
from ledgerloom.queries import roles
from ledgerloom.queries.clean_sql import LINES, TARGETS, with_
from ledgerloom.queries.registry import query
from ledgerloom.sources import landing, tables
from ledgerloom.sources.staging import fresh_path, staged


def _written(df: DataFrame, label: str, **options) -> str:
    """Write ``df`` as delimited text in a new folder of the shared folder."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(header=True, **options).csv(path)
    return path


@query("q_land_delimited", with_(LINES) + """
SELECT safra, id_pedido, item, data_emissao, id_cliente, id_produto, id_vendedor, quantidade, valor_unitario,
  desconto_fracao, moeda, canal, CASE WHEN safra <> '2024' THEN status_pedido END AS status_pedido_origem, id_filial,
  frete_rateado, 'vendas_' || safra || '.csv' AS _source_file FROM (SELECT *, unnest(range(copies)) FROM line)""")
def land_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """The three yearly extracts as ``;`` ISO-8859-1, ``,`` UTF-8 and ``|`` UTF-8 with a byte-order mark.

    The second one is a folder of files whose columns stand in two orders.
    """
    first, second, third = roles.sales_tables(spark, sf)
    odd = F.crc32("id_pedido") % 2 == 1
    folder = _written(second.filter(odd), "v25", sep=",")
    second.filter(~odd).select(*reversed(second.columns)).write.options(header=True, sep=",").mode("append").csv(folder)
    marked = third.withColumnRenamed("id_pedido", landing.BOM + "id_pedido")
    specs = [
        landing.DelimitedSource("vendas_2024", _written(first, "v24", sep=";", encoding="ISO-8859-1"),
                                ";", "ISO-8859-1", source_name="vendas_2024.csv"),
        landing.DelimitedSource("vendas_2025", folder, source_name="vendas_2025.csv"),
        landing.DelimitedSource("vendas_2026", _written(marked, "v26", sep="|"), "|", source_name="vendas_2026.csv"),
    ]
    landed = landing.land(spark, specs)
    return retail.landed_sales(list(landed.values()), keep=["_source_file"])


@query("q_land_multiline", """
SELECT c_custkey, c_name || chr(10) || 'São "' || c_mktsegment || '"; Nº ' || c_nationkey AS note,
  'clientes.csv' AS source FROM customer""")
def land_multiline(spark: SparkSession, sf: str) -> DataFrame:
    notes = roles.table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("\nSão \""), "c_mktsegment", F.lit('"; Nº '), "c_nationkey").alias("note"))
    path = _written(notes, "notes", sep=";", encoding="ISO-8859-1", quoteAll=True)
    landed = landing.land_delimited(spark, landing.DelimitedSource(
        "notas", path, ";", "ISO-8859-1", multi_line=True, source_name="clientes.csv"))
    return landed.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "note", F.col("_source_file").alias("source"))


@query("q_land_grid", with_(TARGETS) + """
SELECT ano, regiao, segmento, mes, meta_mensal, 'Metas' AS sheet FROM monthly""")
def land_grid(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet with three title lines above its header, landed and unpivoted."""
    grid = roles.target_sheets(spark, sf)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in grid.columns]
    lines = grid.select(F.lit(2).alias("part"), F.concat_ws(";", *cells).alias("text"))
    title = spark.range(1).select(
        F.lit(1).alias("part"),
        F.concat_ws("\n", F.lit("Metas comerciais;;"), F.lit(";;"), F.lit("Valores em BRL;;"),
                    F.lit(";".join(c.replace("_", " ") for c in grid.columns))).alias("text"))
    path = fresh_path(spark, "sheet")
    # A sheet is one file by nature: 242 lines per year, whatever the size of the orders.
    title.unionByName(lines).coalesce(1).sortWithinPartitions("part").select("text").write.text(path)
    landed = landing.land_grid(spark, landing.GridSource(
        "metas", f"{path}/*.txt", sheet="Metas", source_name="metas_comerciais.xlsx"))
    typed = targets.typed_grid(landed.withColumn("ano", parsing.whole_number(F.col("ano"))))
    tall = targets.months_to_rows(targets.detail_rows(typed), ["ano", "regiao", "segmento", "_source_sheet"], "meta_mensal")
    return tall.withColumnRenamed("_source_sheet", "sheet")


@query("q_land_text", """
SELECT 'Premissa ' || n_nationkey || ': ' || n_name AS texto_premissa FROM nation
UNION ALL SELECT o_orderpriority || ' - ' || o_orderkey FROM orders""")
def land_text(spark: SparkSession, sf: str) -> DataFrame:
    """Free text with blank lines between the paragraphs."""
    notes = roles.table(spark, sf, "nation").select(
        F.concat(F.lit("Premissa "), "n_nationkey", F.lit(": "), "n_name", F.lit("\n  \n")).alias("text"))
    more = roles.table(spark, sf, "orders").select(
        F.concat("o_orderpriority", F.lit(" - "), "o_orderkey", F.lit("\n")).alias("text"))
    path = fresh_path(spark, "premissas")
    notes.unionByName(more).write.text(path)
    return landing.land_text(spark, landing.TextSource("metas_premissas", path)).select("texto_premissa")


@query("q_save", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderstatus AS status FROM orders""")
def save(spark: SparkSession, sf: str) -> DataFrame:
    """A table saved twice, the second time with another schema and partitioned, then read back."""
    name = f"saved_{uuid.uuid4().hex}"
    path = fresh_path(spark, name)
    orders = roles.table(spark, sf, "orders")
    tables.save_table(orders.select("o_orderkey"), name, path=path)
    wanted = orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice",
        F.col("o_orderstatus").alias("status"))
    tables.save_table(wanted, name, partition_by=["status"], path=path)
    folder = tables.current_version(spark, name).rpartition("__")[2]
    # the names go, the files stay until the session's staged files go
    spark.sql(f"DROP VIEW {name}")
    for version in tables.versions(spark, name):
        spark.sql(f"DROP TABLE {version}")
    return spark.read.parquet(f"{path}/{folder}")


@query("q_inventory", """
SELECT 'clientes' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'produtos', count(*) FROM part UNION ALL SELECT 'vendedores', count(*) FROM supplier""")
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    namespace = f"landed_{uuid.uuid4().hex}"
    tables.create_namespace(spark, namespace)
    for name, df in (("clientes", roles.customers(spark, sf)), ("produtos", roles.products(spark, sf)),
                     ("vendedores", roles.salespeople(spark, sf))):
        tables.save_table(df, f"{namespace}.{name}", path=fresh_path(spark, name))
    counted = staged(tables.inventory(spark, namespace), "inventory")
    spark.sql(f"DROP SCHEMA {namespace} CASCADE")
    return counted
