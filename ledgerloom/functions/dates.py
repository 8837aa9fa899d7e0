"""Calendar parts of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year(d: Column, first_month: int = 4) -> Column:
    """The fiscal year carries the number of the calendar year it ends in."""
    shift = F.when(F.month(d) >= first_month, 1).otherwise(0) if first_month > 1 else F.lit(0)
    return (F.year(d) + shift).cast("int")


def fiscal_month(d: Column, first_month: int = 4) -> Column:
    return (F.pmod(F.month(d) - F.lit(first_month), F.lit(12)) + 1).cast("int")


def fiscal_quarter(d: Column, first_month: int = 4) -> Column:
    return F.ceil(fiscal_month(d, first_month) / 3).cast("int")


def fiscal_label(d: Column, first_month: int = 4, prefix: str = "FY") -> Column:
    return F.concat(F.lit(prefix), fiscal_year(d, first_month).cast("string"))


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)
