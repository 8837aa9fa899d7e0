"""Dirty text to numbers and dates. Anything unreadable becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.fixed_values import MONTH_NUMBERS, SERIAL_EPOCH
from ledgerloom.functions.text import let, map_value, strip_space

# The written date shapes exclude each other; year 0 matches none.
_DAY_FIRST = r"^([0-9]{1,2})([/-])([0-9]{1,2})\2((?!0000)[0-9]{4})$"
_YEAR_FIRST = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_MONTH_NAME = r"^[0-9]{1,2}/[a-zA-Z]{3}/[0-9]{2}$"
_SERIAL = r"^[0-9]{4,6}$"


def _plain_number(v: Column) -> Column:
    """True for every plain numeric text; of what a cast reads besides, ``nan``, ``inf``, ``1d`` and ``0x1p3`` are not.

    The first character is a sign, point or digit, the last a point or digit. These are comparisons of bytes, cheaper than
    a pattern; the cast refuses the rest.
    """
    last = F.substring(v, -1, 1)
    return (v >= "+") & (v < ":") & (last >= ".") & (last < ":") & ~v.contains("x") & ~v.contains("X")


#: A step of a reader. It names its argument several times, so the argument is to be bound: by ``in_turn`` inside one
#: expression, or, several times faster, by a projection for each step (``layouts.Layout``), which Spark compiles whole.
Step = Callable[[Column], Column]


def in_turn(c: Column, steps: Sequence[Step]) -> Column:
    return reduce(let, steps, c)


def _written_double(v: Column) -> Column:
    return F.when(_plain_number(v), v.try_cast("double"))


def finite(x: Column) -> Column:
    return F.when(F.abs(x) < float("inf"), x)


#: Any written number that a double can hold; one beyond its range is unreadable, not infinite. The text has no outer space.
_DOUBLE = (_written_double, finite)


def whole_number(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def decimal_comma(c: Column) -> Column:
    """``5,25`` or ``5.25``; a thousands separator makes the value unreadable."""
    return in_turn(F.translate(strip_space(c), ",", "."), _DOUBLE)


def currency_steps(symbol: str = "R$") -> tuple[Step, ...]:
    return (
        lambda c: F.replace(c, F.lit(symbol), F.lit("")),
        strip_space,
        lambda v: F.when(v.contains(","), F.translate(v, ",.", ".")).otherwise(v),
        *_DOUBLE,
    )


def currency_text(c: Column, symbol: str = "R$") -> Column:
    """``R$ 1.234,56``, ``1234,56`` or ``1234.56``: dots are thousands only where a comma is present."""
    return in_turn(c, currency_steps(symbol))


def iso_date(c: Column) -> Column:
    return F.try_to_date(F.trim(c), "yyyy-MM-dd")


def flexible_date(
    c: Column,
    months: Mapping[str, int] = MONTH_NUMBERS,
    century: int = 2000,
    min_serial: int = 0,
) -> Column:
    """Date written as a spreadsheet serial, ``d/m/yyyy``, ``yyyy-m-d``, ``d-m-yyyy`` or ``d/mon/yy``.

    Four to six bare digits are always a serial (so ``2024`` is a day of 1905); raise ``min_serial``
    to refuse low ones. Impossible days, year 0 and unknown shapes give NULL.
    """
    return in_turn(c, date_steps(months, century, min_serial))


def date_steps(months: Mapping[str, int] = MONTH_NUMBERS, century: int = 2000, min_serial: int = 0) -> tuple[Step, ...]:
    def read(v: Column) -> Column:
        serial = v.try_cast("int")
        if min_serial > 0:
            serial = F.when(serial >= min_serial, serial)
        def part(separator: str, n: int) -> Column:
            return F.substring_index(F.substring_index(v, separator, n), separator, -1)

        def day_first(separator: str) -> Column:
            return F.concat_ws("-", part(separator, 3), part(separator, 2), part(separator, 1)).try_cast("date")

        month = map_value(F.lower(part("/", 2)), months)
        named = F.concat(F.lit(f"{century // 100}"), F.right(v, F.lit(2)), F.lit("-"), month.cast("string"), F.lit("-"),
                         part("/", 1))
        # the separator leaves one or two shapes to be matched
        slashed = F.when(v.rlike(_DAY_FIRST), day_first("/")).when(v.rlike(_MONTH_NAME), named.try_cast("date"))
        dashed = F.when(v.rlike(_YEAR_FIRST), v.try_cast("date")).when(v.rlike(_DAY_FIRST), day_first("-"))
        return F.when(v.contains("/"), slashed).when(v.contains("-"), dashed).when(
            v.rlike(_SERIAL), F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial))

    return strip_space, read


def month_start(year: Column, month: Column) -> Column:
    """First day of a month; NULL when the parts are missing or out of range."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lit("01"))
    return F.when(year.isNotNull() & month.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))
