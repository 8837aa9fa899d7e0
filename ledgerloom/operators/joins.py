"""Left joins to a right side that an aggregate has made unique."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _marked(key: str) -> str:
    return f"_key_{key}"


def unique_side(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], max_rows: int | None = None) -> DataFrame:
    """One row per key with the given aggregates; keys held by more than ``max_rows`` rows match nothing.

    The join key is an expression over the aggregate, not the grouping column itself. A join on the grouping
    column would reuse the partitioning of the aggregate, and AQE splits a skewed join only where the
    exchange stands directly under it; this way it does, at the price of moving the small side once more.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    usable = F.col("_rows") >= 1 if max_rows is None else F.col("_rows") <= max_rows
    rest = [c for c in grouped.columns if c not in keys]
    return grouped.select(*[F.when(usable, F.col(k)).alias(_marked(k)) for k in keys], *rest)


def left_join_unique(df: DataFrame, side: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join of ``df`` to a ``unique_side``; ``on`` maps columns of ``df`` to its keys. Adds no rows."""
    same = [F.col(left) == F.col(_marked(right)) for left, right in on.items()]
    return df.join(side, same, "left")


def inner_join_unique(df: DataFrame, side: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """The rows of ``df`` whose keys a ``unique_side`` has."""
    return df.join(side, [F.col(left) == F.col(_marked(right)) for left, right in on.items()])


def drop_side(df: DataFrame, on: Mapping[str, str], *more: str) -> DataFrame:
    return df.drop("_rows", *[_marked(k) for k in on.values()], *more)
