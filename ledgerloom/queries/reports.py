"""Quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.money import is_cancelled
from ledgerloom.operators import quality
from ledgerloom.operators.quality import KeyCheck
from ledgerloom.operators.sums import exact_sums
from ledgerloom.plans import retail
from ledgerloom.queries import flows, roles
from ledgerloom.queries.clean_sql import CUSTOMERS, DIMENSIONS, PORTFOLIO, RETURNS, SALES, TARGETS, exact, with_
from ledgerloom.queries.model import _FACT, _HIERARCHY, _MODEL
from ledgerloom.queries.registry import query
from ledgerloom.queries.sales import ATTRIBUTION
from ledgerloom.sources.staging import staged, staged_counted


@query("q_orphans", with_(SALES, PORTFOLIO) + """
SELECT 'fVendas' AS fato, 'id_cliente' AS coluna_fk, 'dClientes' AS dimensao_referenciada,
  count(DISTINCT id_cliente) AS chaves_distintas_orfas FROM sale
  WHERE id_cliente NOT IN (SELECT 'C' || c_custkey FROM customer)
UNION ALL SELECT 'fVendas', 'id_produto_chave', 'dProdutos', count(DISTINCT id_produto_chave) FROM sale
  WHERE id_produto_chave NOT IN (SELECT 'P' || p_partkey FROM part)
UNION ALL SELECT 'fVendas', 'id_vendedor', 'dVendedores', count(DISTINCT id_vendedor) FROM sale
  WHERE id_vendedor NOT IN (SELECT id_vendedor FROM person)
UNION ALL SELECT 'carteira_historica', 'id_cliente', 'dClientes', count(DISTINCT id_cliente) FROM portfolio
  WHERE id_cliente NOT IN (SELECT 'C' || c_custkey FROM customer)
UNION ALL SELECT 'carteira_historica', 'id_vendedor', 'dVendedores', count(DISTINCT id_vendedor) FROM portfolio
  WHERE id_vendedor NOT IN (SELECT id_vendedor FROM person)""")
def orphans(spark: SparkSession, sf: str) -> DataFrame:
    sold, assigned = retail.used_codes(flows.landed(spark, sf)), flows.portfolio(spark, sf)  # one pass over each
    buyers, goods, persons = flows.customers(spark, sf), flows.products(spark, sf), flows.people(spark, sf)
    return quality.orphan_key_report([
        KeyCheck("fVendas", sold, "id_cliente", "dClientes", buyers, "id_cliente"),
        KeyCheck("fVendas", sold, "id_produto_chave", "dProdutos", goods, "id_produto_chave"),
        KeyCheck("fVendas", sold, "id_vendedor", "dVendedores", persons, "id_vendedor"),
        KeyCheck("carteira_historica", assigned, "id_cliente", "dClientes", buyers, "id_cliente"),
        KeyCheck("carteira_historica", assigned, "id_vendedor", "dVendedores", persons, "id_vendedor"),
    ])


@query("q_ambiguous", with_(SALES, CUSTOMERS, PORTFOLIO) + f"""
SELECT 'clientes' AS tabela, 'cnpj_limpo' AS coluna, count(*) AS quantidade, '{fv.AMBIGUOUS_TAX_ID}' AS descricao
  FROM cust WHERE cnpj_limpo IN (SELECT cnpj_limpo FROM cust WHERE cnpj_limpo <> '' GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'vendedores', 'id_vendedor', count(*), '{fv.AMBIGUOUS_SALESPERSON}' FROM person
  WHERE id_vendedor IN (SELECT id_vendedor FROM shared)
UNION ALL SELECT 'vendas', 'id_vendedor', count(*), '{fv.AMBIGUOUS_SALES}' FROM sale WHERE id_vendedor_ambiguo
UNION ALL SELECT 'carteira_historica', 'id_vendedor', count(*), '{fv.AMBIGUOUS_PORTFOLIO}' FROM portfolio
  WHERE id_vendedor IN (SELECT id_vendedor FROM shared)""")
def ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    people = flows.people(spark, sf)
    return quality.ambiguous_key_report([
        ("clientes", "cnpj_limpo", flows.customers(spark, sf), "cnpj_duplicado", fv.AMBIGUOUS_TAX_ID),
        ("vendedores", "id_vendedor", people, "id_vendedor_duplicado", fv.AMBIGUOUS_SALESPERSON),
        ("vendas", "id_vendedor", retail.sales_of_shared_codes(flows.landed(spark, sf), people), "id_vendedor_ambiguo", fv.AMBIGUOUS_SALES),
        ("carteira_historica", "id_vendedor", flows.portfolio(spark, sf), "id_vendedor_ambiguo",
         fv.AMBIGUOUS_PORTFOLIO),
    ])


_VOLUME = with_(RETURNS) + """
SELECT 'vendas' AS fonte, safra, CAST(sum(copies) AS BIGINT) AS linhas_bronze,
  count(*) FILTER (WHERE motivo_rejeicao = '') AS linhas_validas,
  count(*) FILTER (WHERE motivo_rejeicao <> '') AS linhas_rejeitadas_ou_orfas,
  CAST(sum(copies) - count(*) AS BIGINT) AS duplicatas_removidas
FROM tagged GROUP BY safra
UNION ALL SELECT 'vendas', '2027', 0, 0, 0, 0
UNION ALL SELECT 'devolucoes', 'todas', count(*), count(*) FILTER (WHERE pedido_origem_encontrado),
  count(*) FILTER (WHERE NOT pedido_origem_encontrado), 0 FROM ret"""


@query("q_volume", _VOLUME)
def volume(spark: SparkSession, sf: str) -> DataFrame:
    tagged = staged(quality.routed(flows.tagged(spark, sf)), "tagged", [quality.ROUTE])
    accepted, refused = quality.split_routed(tagged)
    of_sales = quality.volume_report("vendas", flows.landed(spark, sf), accepted, refused, "safra", ["2024", "2025", "2026", "2027"])
    sold = retail.sales(accepted, flows.quotes(spark, sf), flows.people(spark, sf))
    valued = flows.valued_returns(spark, sf, sold)
    return of_sales.unionByName(
        quality.volume_of_split("devolucoes", "todas", valued, F.col("pedido_origem_encontrado")))


@query("q_volume_written", _VOLUME)
def volume_written(spark: SparkSession, sf: str) -> DataFrame:
    """The volume report of counts that the writes took: no table is read to be counted."""
    by_layout = quality.per_value("safra", ["2024", "2025", "2026", "2027"])
    landed, n_landed = staged_counted(flows.landed(spark, sf), "landed", by_layout)
    by_route = {f"{route} {name}": (F.col(quality.ROUTE) == route) & holds for name, holds in by_layout.items() for route in quality.ROUTES}
    tagged, n_tagged = staged_counted(quality.routed(retail.tagged_sales(landed)), "tagged", by_route, [quality.ROUTE])
    sold = retail.sales(quality.split_routed(tagged)[0], flows.quotes(spark, sf), flows.people(spark, sf))
    _, n_returned = staged_counted(flows.valued_returns(spark, sf, sold), "returned", {"found": F.col("pedido_origem_encontrado")})
    of_sales = {name: (n_landed[name], *(n_tagged[f"{route} {name}"] for route in quality.ROUTES)) for name in by_layout}
    of_returns = {"todas": (n_returned["rows"], n_returned["found"], n_returned["rows"] - n_returned["found"])}
    return quality.volume_of_counts(spark, "vendas", of_sales).unionByName(quality.volume_of_counts(spark, "devolucoes", of_returns))


_RECONCILE = with_(*_MODEL, PORTFOLIO, ATTRIBUTION, _FACT) + """
SELECT 'silver.vendas' AS check_name, count(*) AS n_rows FROM sale
UNION ALL SELECT 'gold.fVendas', count(*) FROM fact
UNION ALL SELECT 'silver.metas_mensais', count(*) FROM monthly
UNION ALL SELECT 'gold.fMetas', count(*) FROM monthly"""


@query("q_reconcile_written", _RECONCILE)
def reconcile_written(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each table before and after its keys, counted while the tables were written."""
    sold, n_sold = staged_counted(flows.sales(spark, sf), "sales")
    counted = {
        "silver.vendas": n_sold,
        "gold.fVendas": staged_counted(flows.f_sales_in_place_of(spark, sf, sold), "f-sales")[1],
        "silver.metas_mensais": staged_counted(flows.monthly(spark, sf), "monthly")[1],
        "gold.fMetas": staged_counted(flows.f_targets(spark, sf), "f-targets")[1],
    }
    return spark.createDataFrame([(name, n["rows"]) for name, n in counted.items()], "check_name string, n_rows long")


@query("q_reconcile", _RECONCILE)
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    sold = flows.kept_sales(spark, sf)
    return quality.row_counts({
        "silver.vendas": sold,
        "gold.fVendas": flows.f_sales(spark, sf, sold),
        "silver.metas_mensais": flows.monthly(spark, sf),
        "gold.fMetas": flows.f_targets(spark, sf),
    })


@query("q_period", with_(SALES) + """
SELECT 'vendas' AS fonte, CAST(min(data_emissao) AS VARCHAR) AS periodo_inicio,
  CAST(max(data_emissao) AS VARCHAR) AS periodo_fim FROM sale""")
def period(spark: SparkSession, sf: str) -> DataFrame:
    return quality.refresh_metadata(flows.sales(spark, sf), "data_emissao", "vendas").drop("atualizado_em")


_CHECKS = {
    "missing_rate": "SELECT count(*) FROM sale WHERE taxa_cambio_aplicada IS NULL",
    "cancelled_with_revenue": "SELECT count(*) FROM sale WHERE status_pedido = 'Cancelado' AND receita_bruta <> 0",
    "cancelled_sales": "SELECT count(*) FROM sale WHERE status_pedido = 'Cancelado'",
    "ambiguous_salesperson_sales": "SELECT count(*) FROM sale WHERE id_vendedor_ambiguo",
    "returns_over_billed": "SELECT count(*) FROM ret WHERE quantidade_excede_faturado",
    "returns_of_cancelled": "SELECT count(*) FROM ret WHERE devolucao_de_pedido_cancelado",
    "targets_without_member":
        "SELECT count(*) FROM monthly LEFT JOIN dregseg USING (regiao, segmento) WHERE sk_regiao_segmento IS NULL",
    "targets_without_annual": "SELECT count(*) FROM annual WHERE meta_ano IS NULL",
}


@query("q_quality_misc", with_(RETURNS, CUSTOMERS, TARGETS, DIMENSIONS) + "\nUNION ALL ".join(
    f"SELECT '{name}' AS check_name, ({sql}) AS n_rows" for name, sql in _CHECKS.items()))
def quality_misc(spark: SparkSession, sf: str) -> DataFrame:
    """Named counts, one aggregate per table; each fact is read once however many checks it takes part in."""
    cancelled = is_cancelled(F.col("status_pedido"))
    sold = flows.kept_sales(spark, sf)
    counted = [
        (sold, {
            "missing_rate": F.col("taxa_cambio_aplicada").isNull(),
            "cancelled_with_revenue": cancelled & (F.col("receita_bruta") != 0),
            "cancelled_sales": cancelled,
            "ambiguous_salesperson_sales": F.col("id_vendedor_ambiguo"),
        }),
        (flows.valued_returns(spark, sf, sold), {
            "returns_over_billed": F.col("quantidade_excede_faturado"),
            "returns_of_cancelled": F.coalesce("devolucao_de_pedido_cancelado", F.lit(False)),
        }),
        (flows.f_targets(spark, sf), {"targets_without_member": F.col("sk_regiao_segmento").isNull()}),
        (flows.annual(spark, sf), {"targets_without_annual": F.col("meta_ano").isNull()}),
    ]
    return quality.count_checks(counted)


@query("q_cancelled", with_(SALES) + f"""
SELECT safra, count(*) AS qtd, round({exact("receita_bruta")}, 4) AS receita_bruta_soma FROM sale
WHERE status_pedido = 'Cancelado' GROUP BY 1""")
def cancelled_sales(spark: SparkSession, sf: str) -> DataFrame:
    cancelled = flows.sales(spark, sf).filter(is_cancelled(F.col("status_pedido")))
    summed = exact_sums(cancelled, ["safra"], {"receita_bruta_soma": F.col("receita_bruta")}, rows="qtd")
    return summed.withColumn("receita_bruta_soma", F.round("receita_bruta_soma", 4)).orderBy("safra")


@query("q_samples", with_(CUSTOMERS, _HIERARCHY) + """
SELECT 'branch' AS kind, id_cliente AS member, nome_grupo_economico AS detail FROM (
  SELECT * FROM grouped WHERE id_matriz IS NOT NULL ORDER BY id_cliente LIMIT 10)
UNION ALL SELECT 'orphan_parent', id_cliente, nome_grupo_economico FROM grouped WHERE matriz_orfa
UNION ALL SELECT 'shared_tax_id', id_cliente, cnpj_limpo FROM (
  SELECT * FROM cust WHERE cnpj_limpo IN (
    SELECT cnpj_limpo FROM cust WHERE cnpj_limpo <> '' GROUP BY 1 HAVING count(*) > 1)
  ORDER BY cnpj_limpo, id_cliente LIMIT 20)
UNION ALL SELECT 'inferred_region', id_cliente, regiao FROM cust WHERE regiao_inferida_por_uf""")
def samples(spark: SparkSession, sf: str) -> DataFrame:
    """The listings a reviewer reads; the limits are those of the top-n listings themselves."""
    dim = flows.d_customers(spark, sf)

    def listed(df: DataFrame, kind: str, detail: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col("id_cliente").alias("member"), F.col(detail).alias("detail"))

    branches = dim.filter(F.col("id_matriz").isNotNull()).orderBy("id_cliente").limit(10)
    shared = dim.filter("cnpj_duplicado").orderBy("cnpj_limpo", "id_cliente").limit(20)
    return (
        listed(branches, "branch", "nome_grupo_economico")
        .unionByName(listed(dim.filter("matriz_orfa"), "orphan_parent", "nome_grupo_economico"))
        .unionByName(listed(shared, "shared_tax_id", "cnpj_limpo"))
        .unionByName(listed(dim.filter("regiao_inferida_por_uf"), "inferred_region", "regiao"))
    )


@query("q_orphan_return_sample", with_(RETURNS) + """
SELECT id_devolucao, data_devolucao, motivo FROM ret WHERE NOT pedido_origem_encontrado
ORDER BY data_devolucao, id_devolucao LIMIT 10""")
def orphan_return_sample(spark: SparkSession, sf: str) -> DataFrame:
    return retail.orphan_returns(flows.valued_returns(spark, sf)).select(
        "id_devolucao", "data_devolucao", "motivo").orderBy("data_devolucao", "id_devolucao").limit(10)


@query("q_table_counts", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def counts(spark: SparkSession, sf: str) -> DataFrame:
    from ledgerloom.sources.tables import table_counts

    names = ["customer", "part", "supplier", "orders", "lineitem"]
    return table_counts({name: roles.table(spark, sf, name) for name in names})
