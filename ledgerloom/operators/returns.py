"""Value returns at the terms of the sale they refer to, and explain those without one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import is_cancelled, net_of_discount
from ledgerloom.operators.joins import drop_side, inner_join_unique, left_join_unique, unique_side
from ledgerloom.operators.membership import possibly_in


def sale_terms(
    sales: DataFrame, returns: DataFrame, on: Mapping[str, str], terms: Mapping[str, str], n_returns: int | None = None
) -> DataFrame:
    """One row per sale key that a return names, with the sale's terms and the number of sales that share the key.

    Sales that no return names are left out before the aggregate, by a join to the named keys, each of which is one row;
    as in all joins to a ``unique_side``, a hot sale key can be split. Sales that share a key are settled by the order
    of their terms, so a return can never be multiplied. ``on`` maps return columns to sale columns.

    Where the number of returns is known, a Bloom filter of their keys thins the sales before that join shuffles them.
    """
    named = unique_side(returns.select(*[F.col(r).alias(s) for r, s in on.items()]), list(on.values()), [])
    picked = F.struct(*[F.col(source).alias(out) for source, out in terms.items()])
    thinned = sales if n_returns is None else possibly_in(sales, {s: r for r, s in on.items()}, returns, n_returns)
    found = thinned.select(*on.values(), picked.alias("_terms"))
    joined = inner_join_unique(found, named, {s: s for s in on.values()})
    # expressions over the join, so that the aggregate has its own exchange and AQE may split the join's hot keys
    wanted = joined.select(*[F.when(F.col("_rows") >= 1, F.col(s)).alias(s) for s in on.values()], "_terms")
    return unique_side(wanted, list(on.values()), [F.max("_terms").alias("_terms")])


def value_returns(
    returns: DataFrame,
    sales: DataFrame,
    *,
    on: Mapping[str, str],
    terms: Mapping[str, str],
    quantity: str,
    layout: str,
    price: str,
    discount: str,
    rate: str,
    status: str,
    billed: str,
    n_returns: int | None = None,
) -> DataFrame:
    """Left join to the sale, sanity flags, gross and net value.

    ``on`` maps return columns to sale columns, ``terms`` sale columns to the names they take here; the
    other names are columns after the join; ``n_returns`` is the number of returns, if known. A return of a cancelled sale is worth 0, one without a
    sale has no value. ``origem_ambigua`` marks returns whose key is shared by several sales.
    """
    right = sale_terms(sales, returns, on, terms, n_returns)
    joined = left_join_unique(returns, right, on).withColumns(
        {out: F.col("_terms").getField(out) for out in terms.values()})
    found = F.col(layout).isNotNull()
    cancelled = found & is_cancelled(F.col(status))
    gross = F.when(cancelled, F.lit(0.0)).when(found, F.col(quantity) * F.col(price) * F.col(rate))
    valued = joined.withColumns({
        "pedido_origem_encontrado": found,
        "quantidade_excede_faturado": found & (F.col(quantity) > F.col(billed)),
        "devolucao_de_pedido_cancelado": F.when(found, cancelled),
        "origem_ambigua": F.coalesce(F.col("_rows") > 1, F.lit(False)),
        "receita_devolucao_bruta": gross,
        "receita_devolucao_liquida": net_of_discount(gross, F.col(discount)),
    })
    return drop_side(valued, on, "_terms")


def orphan_returns(valued: DataFrame, columns: Sequence[str]) -> DataFrame:
    return valued.filter(~F.col("pedido_origem_encontrado")).select(*columns)


def explain_orphans(orphans: DataFrame, landed_keys: DataFrame, on: Mapping[str, str], flag: str) -> DataFrame:
    """Tell orphans whose sale never landed from those whose sale landed and was taken out on the way."""
    keys = unique_side(landed_keys.select(*on.values()), list(on.values()), [])
    return drop_side(left_join_unique(orphans, keys, on).withColumn(flag, F.col("_rows").isNotNull()), on)
