"""Returns and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import targets
from ledgerloom.operators.sums import exact_sums
from ledgerloom.plans import retail
from ledgerloom.queries import flows, roles
from ledgerloom.queries.clean_sql import RETURNS, TARGETS, exact, with_
from ledgerloom.queries.registry import query

_RETURN_COLUMNS = [
    "id_devolucao", "id_pedido_origem", "item", "data_devolucao", "quantidade_devolvida", "motivo", "safra_origem",
    "valor_unitario_origem", "desconto_fracao_origem", "moeda_origem", "taxa_cambio_origem", "status_pedido_origem",
    "quantidade_faturada_origem", "pedido_origem_encontrado", "quantidade_excede_faturado",
    "devolucao_de_pedido_cancelado", "origem_ambigua", "receita_devolucao_bruta", "receita_devolucao_liquida"]


@query("q_returns", with_(RETURNS) + f"SELECT {', '.join(_RETURN_COLUMNS)} FROM ret")
def valued_returns(spark: SparkSession, sf: str) -> DataFrame:
    return flows.valued_returns(spark, sf).select(*_RETURN_COLUMNS)


@query("q_orphan_returns", with_(RETURNS) + """
SELECT id_devolucao, id_pedido_origem, item, data_devolucao, quantidade_devolvida, motivo,
  EXISTS (SELECT 1 FROM line l WHERE l.id_pedido = id_pedido_origem AND l.item = ret.item)
    AS existe_no_bruto_mas_foi_excluida
FROM ret WHERE NOT pedido_origem_encontrado""")
def orphan_returns(spark: SparkSession, sf: str) -> DataFrame:
    orphans = retail.orphan_returns(flows.valued_returns(spark, sf))
    return retail.explained_orphans(orphans, flows.landed(spark, sf))


@query("q_orphan_reasons", with_(RETURNS) + """
SELECT motivo, count(*) AS quantidade FROM ret WHERE NOT pedido_origem_encontrado GROUP BY 1""")
def orphan_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return retail.orphan_returns(flows.valued_returns(spark, sf)).groupBy("motivo").agg(
        F.count(F.lit(1)).alias("quantidade")).orderBy(F.desc("quantidade"), "motivo")


@query("q_return_flags", with_(RETURNS) + f"""
SELECT pedido_origem_encontrado, quantidade_excede_faturado, devolucao_de_pedido_cancelado, count(*) AS n_rows,
  round({exact("receita_devolucao_bruta")}, 4) AS receita_devolucao_bruta,
  round({exact("receita_devolucao_liquida")}, 2) AS total_devolvido
FROM ret GROUP BY 1, 2, 3""")
def return_flags(spark: SparkSession, sf: str) -> DataFrame:
    summed = exact_sums(
        flows.valued_returns(spark, sf), ["pedido_origem_encontrado", "quantidade_excede_faturado", "devolucao_de_pedido_cancelado"],
        {"receita_devolucao_bruta": F.col("receita_devolucao_bruta"), "total_devolvido": F.col("receita_devolucao_liquida")}, rows="n_rows")
    return summed.withColumns({
        "receita_devolucao_bruta": F.round("receita_devolucao_bruta", 4), "total_devolvido": F.round("total_devolvido", 2)})


@query("q_unpivot_targets", with_(TARGETS) + """
SELECT ano, regiao, segmento, mes, meta_mensal, data_referencia FROM monthly""")
def unpivot_targets(spark: SparkSession, sf: str) -> DataFrame:
    return flows.monthly(spark, sf)


@query("q_annual_targets", with_(TARGETS) + "SELECT ano, regiao, segmento, meta_ano FROM annual")
def annual_targets(spark: SparkSession, sf: str) -> DataFrame:
    return flows.annual(spark, sf)


@query("q_totals_row", with_(TARGETS) + """
SELECT ano, mes, CAST(sum(exact) AS DOUBLE) AS soma_calculada, CAST(sum(exact) AS DOUBLE) AS total_arquivo,
  CASE WHEN sum(exact) IS NOT NULL THEN 0.0::DOUBLE END AS diferenca FROM monthly GROUP BY 1, 2""")
def totals_row(spark: SparkSession, sf: str) -> DataFrame:
    totals = targets.control_totals(flows.monthly(spark, sf), flows.targets_totals(spark, sf))
    return totals.withColumn("soma_calculada", F.round("soma_calculada", 4)).orderBy("ano", "mes")


@query("q_annual_vs_months", with_(TARGETS) + """
SELECT ano, regiao, segmento, CAST(sum(exact) AS DOUBLE) AS soma_meses, any_value(meta_ano) AS meta_ano,
  round(any_value(meta_ano) - CAST(sum(exact) AS DOUBLE), 2) AS diferenca
FROM monthly JOIN annual USING (ano, regiao, segmento) GROUP BY 1, 2, 3
HAVING round(any_value(meta_ano) - CAST(sum(exact) AS DOUBLE), 2) <> 0""")
def annual_vs_months(spark: SparkSession, sf: str) -> DataFrame:
    divergent = targets.annual_divergence(flows.monthly(spark, sf), flows.annual(spark, sf))
    return divergent.withColumn("soma_meses", F.round("soma_meses", 4))


@query("q_undefined_targets", with_(TARGETS) + """
SELECT regiao, segmento, mes, count(*) AS n_undefined FROM monthly WHERE meta_mensal IS NULL GROUP BY 1, 2, 3""")
def undefined_targets(spark: SparkSession, sf: str) -> DataFrame:
    return targets.undefined_targets(flows.monthly(spark, sf)).orderBy("regiao", "segmento", "mes")


@query("q_target_coverage", with_(TARGETS) + """
SELECT ano, count(*) AS n_rows, count(DISTINCT (regiao, segmento)) AS members FROM monthly GROUP BY 1""")
def target_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return flows.monthly(spark, sf).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("regiao", "segmento").alias("members")).orderBy("ano")
