"""Net revenue series and target attainment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.sums import exact_sums


def signed_revenue(
    sales: DataFrame, returns: DataFrame, *, sale_day: str, sale_value: str, return_day: str, return_value: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Sales as positive and returns as negative amounts, each on its own day.

    The two facts are stacked, not joined: no key has to match and a day with only returns is kept.
    """
    plus = sales.select(F.col(sale_day).alias("data"), *keep, F.col(sale_value).alias("valor"))
    minus = returns.select(F.col(return_day).alias("data"), *keep, (-F.col(return_value)).alias("valor"))
    return plus.unionByName(minus)


def net_revenue_series(signed: DataFrame, by: Sequence, out: str = "receita_liquida_realizada") -> DataFrame:
    return exact_sums(signed, by, {out: F.col("valor")})


def attainment(
    realized: DataFrame, targets: DataFrame, keys: Sequence[str], realized_value: str, target_value: str, out: str
) -> DataFrame:
    """Realised / target per target row; NULL, not zero, where the target is undefined or zero."""
    return targets.join(realized, list(keys), "left").withColumn(
        out, F.col(realized_value).cast("double") / F.nullif(F.col(target_value).cast("double"), F.lit(0.0)))
