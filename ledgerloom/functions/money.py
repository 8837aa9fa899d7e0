"""Revenue rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.fixed_values import BILLED, CANCELLED


def is_cancelled(status: Column, cancelled: str = CANCELLED) -> Column:
    """Two-valued test: a missing status is not a cancellation."""
    return F.coalesce(status == cancelled, F.lit(False))


def unified_status(sign_rules: Column, quantity: Column, source_status: Column) -> Column:
    """Layouts without a status column mark a cancellation by a negative quantity."""
    by_sign = F.when(quantity < 0, F.lit(CANCELLED)).otherwise(F.lit(BILLED))
    return F.when(sign_rules, by_sign).otherwise(source_status)


def gross_revenue(quantity: Column, price: Column, rate: Column, cancelled: Column) -> Column:
    return F.when(cancelled, F.lit(0.0)).otherwise(quantity * price * rate)


def net_of_discount(gross: Column, discount: Column) -> Column:
    return gross * (F.lit(1.0) - discount)
