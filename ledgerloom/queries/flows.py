"""The plans of the package applied to the rendered test tables.

``kept`` tables are written once and read back, as the tables of a run are; queries that read sales once do
without.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.fixed_values import NATIONAL_SCOPE
from ledgerloom.operators import calendar, quality, targets
from ledgerloom.plans import retail
from ledgerloom.queries import roles
from ledgerloom.sources.staging import discard, staged, staged_with_months


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return retail.customers(roles.customers(spark, sf))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return retail.products(roles.products(spark, sf))


def people(spark: SparkSession, sf: str) -> DataFrame:
    return retail.salespeople(roles.salespeople(spark, sf))


def portfolio(spark: SparkSession, sf: str) -> DataFrame:
    return retail.portfolio(roles.portfolio(spark, sf), people(spark, sf))


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    return retail.quotes(roles.quotes(spark, sf))


def landed(spark: SparkSession, sf: str) -> DataFrame:
    return retail.landed_sales(roles.sales_tables(spark, sf))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    return retail.tagged_sales(landed(spark, sf))


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_tagged(tagged(spark, sf))[0]


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_tagged(tagged(spark, sf))[1]


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return retail.sales(valid(spark, sf), quotes(spark, sf), people(spark, sf))


def kept_sales(spark: SparkSession, sf: str) -> DataFrame:
    return staged(sales(spark, sf), "sales")


def kept_sales_and_months(spark: SparkSession, sf: str) -> tuple[DataFrame, list[date]]:
    return staged_with_months(sales(spark, sf), "sales", "data_emissao")


def valued_returns(spark: SparkSession, sf: str, sold: DataFrame | None = None) -> DataFrame:
    if sold is None:
        return retail.valued_returns_of_landed(roles.returned_lines(spark, sf), landed(spark, sf), quotes(spark, sf))
    return retail.valued_returns(roles.returned_lines(spark, sf), sold)


def targets_detail(spark: SparkSession, sf: str) -> DataFrame:
    return targets.detail_rows(targets.typed_grid(roles.target_sheets(spark, sf)))


def targets_totals(spark: SparkSession, sf: str) -> DataFrame:
    return targets.totals_rows(targets.typed_grid(roles.target_sheets(spark, sf)))


def annual(spark: SparkSession, sf: str) -> DataFrame:
    return targets.annual_targets(targets_detail(spark, sf))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return targets.monthly_targets(targets_detail(spark, sf))


def national_holidays(spark: SparkSession, sf: str) -> DataFrame:
    return retail.holidays(roles.holidays(spark, sf)).filter(F.col("abrangencia") == NATIONAL_SCOPE)


def order_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar over the days that the orders span."""
    span = roles.table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("stop"))
    return calendar.calendar(calendar.date_spine(span, "start", "stop"), national_holidays(spark, sf))


def d_customers(spark: SparkSession, sf: str) -> DataFrame:
    return retail.customer_dimension(customers(spark, sf))


def d_products(spark: SparkSession, sf: str) -> DataFrame:
    return retail.product_dimension(products(spark, sf))


def d_people(spark: SparkSession, sf: str) -> DataFrame:
    return retail.salesperson_dimension(people(spark, sf))


def d_region_segment(spark: SparkSession, sf: str) -> DataFrame:
    return retail.region_segment_dimension(customers(spark, sf), annual(spark, sf))


def member_keys(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Surrogate keys of customers and of products, for facts that need nothing else of these dimensions."""
    return retail.customer_keys(roles.customers(spark, sf)), retail.product_keys(roles.products(spark, sf))


def f_sales(spark: SparkSession, sf: str, sold: DataFrame | None = None, months: Sequence[date] | None = None) -> DataFrame:
    """Of ``sold``, or where nothing else needs the priced sales, of valid ones that are priced last."""
    if sold is not None:
        return retail.sales_fact(sold, portfolio(spark, sf), *member_keys(spark, sf), d_people(spark, sf), months)
    kept, months = staged_with_months(retail.flagged_sales(valid(spark, sf), people(spark, sf)), "valid-sales", "data_emissao")
    return retail.sales_fact_of_valid(
        kept, quotes(spark, sf), portfolio(spark, sf), *member_keys(spark, sf), d_people(spark, sf), months)


def f_sales_in_place_of(spark: SparkSession, sf: str, sold: DataFrame) -> DataFrame:
    """The fact of staged sales that nothing else reads: they are discarded once they are written with their product keys.

    So the two shuffles of the whole sales are never on disk together, nor with two tables of them.
    """
    buyers, goods = member_keys(spark, sf)
    keyed, months = staged_with_months(retail.with_product_key(sold, goods), "sales-products", "data_emissao")
    discard(sold)
    return retail.with_party_keys(keyed, portfolio(spark, sf), buyers, d_people(spark, sf), months).select(*retail.SALES_FACT)


def f_returns(spark: SparkSession, sf: str, sold: DataFrame | None = None) -> DataFrame:
    return retail.returns_fact(valued_returns(spark, sf, sold), *member_keys(spark, sf))


def realized(spark: SparkSession, sf: str, periods: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Net revenue per region, segment and period."""
    sold, buyers = kept_sales(spark, sf), d_customers(spark, sf)
    key = {"dim_code": "id_cliente", "dim_sk": "sk_cliente", "out": "sk_cliente"}
    keyed = retail.keys.resolve_key(sold, buyers, code="id_cliente", **key)
    returned = retail.keys.resolve_key(valued_returns(spark, sf, sold), buyers, code="id_cliente_origem", **key)
    return retail.realized_by_member(keyed, returned, buyers, periods)


def f_targets(spark: SparkSession, sf: str) -> DataFrame:
    return retail.targets_fact(monthly(spark, sf), annual(spark, sf), d_region_segment(spark, sf))
