"""The whole batch run: landed files to bronze, silver, quality and gold tables.

Every table is overwritten and read back by the steps after it, so a lost executor costs a step, not the run,
and joins are planned from the sizes of written files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.operators import calendar, quality, targets
from ledgerloom.operators.layouts import Layout
from ledgerloom.operators.quality import KeyCheck
from ledgerloom.plans import retail
from ledgerloom.sources.landing import land
from ledgerloom.sources.staging import staged
from ledgerloom.sources.tables import create_namespace, save_table, written_counts


class Layers:
    """Names the three namespaces and reads and writes their tables."""

    def __init__(self, spark: SparkSession, bronze: str = "bronze", silver: str = "silver", gold: str = "gold",
                 fmt: str = "parquet"):
        self.spark, self.bronze, self.silver, self.gold, self.fmt = spark, bronze, silver, gold, fmt
        for namespace in (bronze, silver, gold):
            create_namespace(spark, namespace)

    def read(self, namespace: str, table: str) -> DataFrame:
        return self.spark.table(f"{namespace}.{table}")

    def save(self, namespace: str, table: str, df: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
        return save_table(df, f"{namespace}.{table}", self.fmt, counts=counts)

    def counts(self, namespace: str, table: str, counts: Mapping[str, Column] | None = None) -> dict[str, int]:
        return written_counts(self.spark, f"{namespace}.{table}", counts)


@dataclass(frozen=True)
class Period:
    """What a run covers; a new year is a new layout, its file's shape, its target sheet and a later calendar."""

    layouts: Sequence[Layout] = tuple(retail.SALES_LAYOUTS)
    sales_files: Mapping[str, tuple[str, str]] = field(default_factory=lambda: retail.SALES_FILES)
    target_years: Sequence[int] = retail.TARGET_YEARS
    calendar_start: str = "2023-01-01"
    calendar_stop: str = "2027-03-31"
    multi_line: bool = True

    @property
    def sales_counts(self) -> dict[str, Column]:
        """What is counted while sales are written."""
        return quality.per_value("safra", [layout.name for layout in self.layouts])


def return_counts() -> dict[str, Column]:
    """What is counted while returns are written."""
    return {"encontradas": F.col("pedido_origem_encontrado")}


def run_bronze(layers: Layers, folder: str, period: Period = Period()) -> None:
    specs = retail.source_specs(folder, period.multi_line, period.sales_files, period.target_years)
    for table, df in land(layers.spark, specs).items():
        layers.save(layers.bronze, table, df)


def run_silver(layers: Layers, period: Period = Period()) -> None:
    def raw(table: str) -> DataFrame:
        return layers.read(layers.bronze, table)

    def save(table: str, df: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
        return layers.save(layers.silver, table, df, counts)

    days_off = save("feriados", retail.holidays(raw("feriados")))
    fx = save("cambio_usd", retail.quotes(raw("cambio_usd")))
    save("produtos", retail.products(raw("produtos")))
    people = save("vendedores", retail.salespeople(raw("vendedores")))
    save("carteira_historica", retail.portfolio(raw("carteira_historica"), people))
    save("seguranca_acessos", retail.access_rules(raw("seguranca_acessos")))
    save("clientes", retail.customers(raw("clientes")))
    days = calendar.date_spine(calendar.literal_bounds(layers.spark, period.calendar_start, period.calendar_stop), "start", "stop")
    national = days_off.filter(F.col("abrangencia") == fv.NATIONAL_SCOPE)
    save("dcalendario", calendar.calendar(days, national))

    landed = retail.landed_sales([raw(f"vendas_{layout.name}") for layout in period.layouts], period.layouts)
    valid, rejected = quality.split_routed(staged(quality.routed(retail.tagged_sales(landed)), "tagged-sales", [quality.ROUTE]))
    save("vendas_rejeitadas", rejected, period.sales_counts)
    sold = save("vendas", retail.sales(valid, fx, people), period.sales_counts)
    valued = save("devolucoes", retail.valued_returns(raw("devolucoes"), sold), return_counts())
    save("devolucoes_orfas", retail.orphan_returns(valued))

    grid = retail.target_grid({year: raw(f"metas_comerciais_{year}") for year in period.target_years})
    detail = targets.detail_rows(grid)
    save("metas_anuais", targets.annual_targets(detail))
    save("metas_mensais", targets.monthly_targets(detail))


def run_quality(layers: Layers, period: Period = Period()) -> None:
    def silver(table: str) -> DataFrame:
        return layers.read(layers.silver, table)

    sold, assigned = silver("vendas"), silver("carteira_historica")
    buyers, goods, people = silver("clientes"), silver("produtos"), silver("vendedores")
    valid, rejected = (layers.counts(layers.silver, table, period.sales_counts) for table in ("vendas", "vendas_rejeitadas"))
    of_sales = quality.volume_of_counts(layers.spark, "vendas", {
        name: (layers.counts(layers.bronze, f"vendas_{name}")["rows"], valid[name], rejected[name]) for name in period.sales_counts})
    returned = layers.counts(layers.silver, "devolucoes", return_counts())
    of_returns = quality.volume_of_counts(layers.spark, "devolucoes", {
        "todas": (returned["rows"], returned["encontradas"], returned["rows"] - returned["encontradas"])})
    reports = {
        "qualidade_volume_processado": of_sales.unionByName(of_returns),
        "qualidade_rejeicoes": quality.reject_counts(silver("vendas_rejeitadas"), "vendas"),
        "qualidade_chaves_orfas": quality.orphan_key_report([
            KeyCheck("fVendas", sold, "id_cliente", "dClientes", buyers, "id_cliente"),
            KeyCheck("fVendas", sold, "id_produto_chave", "dProdutos", goods, "id_produto_chave"),
            KeyCheck("fVendas", sold, "id_vendedor", "dVendedores", people, "id_vendedor"),
            KeyCheck("carteira_historica", assigned, "id_cliente", "dClientes", buyers, "id_cliente"),
            KeyCheck("carteira_historica", assigned, "id_vendedor", "dVendedores", people, "id_vendedor"),
        ]),
        "qualidade_chaves_ambiguas": quality.ambiguous_key_report([
            ("clientes", "cnpj_limpo", buyers, "cnpj_duplicado", fv.AMBIGUOUS_TAX_ID),
            ("vendedores", "id_vendedor", people, "id_vendedor_duplicado", fv.AMBIGUOUS_SALESPERSON),
            ("vendas", "id_vendedor", sold, "id_vendedor_ambiguo", fv.AMBIGUOUS_SALES),
            ("carteira_historica", "id_vendedor", assigned, "id_vendedor_ambiguo", fv.AMBIGUOUS_PORTFOLIO),
        ]),
        "qualidade_metadata_atualizacao": quality.refresh_metadata(sold, "data_emissao", "vendas"),
    }
    for table, report in reports.items():
        layers.save(layers.silver, table, report)


def run_gold(layers: Layers) -> None:
    def silver(table: str) -> DataFrame:
        return layers.read(layers.silver, table)

    def save(table: str, df: DataFrame) -> DataFrame:
        return layers.save(layers.gold, table, df)

    save("dCalendario", silver("dcalendario"))
    save("dSegurancaAcessos", silver("seguranca_acessos"))
    buyers = save("dClientes", retail.customer_dimension(silver("clientes")))
    goods = save("dProdutos", retail.product_dimension(silver("produtos")))
    people = save("dVendedores", retail.salesperson_dimension(silver("vendedores")))
    members = save("dRegiaoSegmento", retail.region_segment_dimension(silver("clientes"), silver("metas_anuais")))
    sold = save("fVendas", retail.sales_fact(silver("vendas"), silver("carteira_historica"), buyers, goods, people))
    save("fDevolucoes", retail.returns_fact(silver("devolucoes"), buyers, goods))
    save("fMetas", retail.targets_fact(silver("metas_mensais"), silver("metas_anuais"), members))


def run(spark: SparkSession, folder: str, period: Period = Period(), **names: str) -> Layers:
    """Land ``folder`` and build every table; ``names`` overrides the namespaces and the table format."""
    layers = Layers(spark, **names)
    run_bronze(layers, folder, period)
    run_silver(layers, period)
    run_quality(layers, period)
    run_gold(layers)
    return layers
