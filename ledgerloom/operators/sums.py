"""Sums of doubles without any rounding but the last: a superaccumulator of one whole-number sum per exponent band.

A finite double is a whole number times a power of two. Values of one band (eight binary exponents) are whole multiples of
the same power below 2 ** 62, cut into three limbs of 21 bits that are summed as longs. Neither the order of rows nor the
partitioning can change these sums. They are put together once: bands are carried upwards into digits of eight bits, and
the leading ones, with a sticky bit for the rest, are rounded to the nearest double.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import let

BAND_BITS, LIMB_BITS = 8, 21
#: A band's unit is 2 ** (BAND_BITS * band - SHIFT), two bits below the lowest that a value of the band can have: a
#: logarithm may take a value at the very edge of a band for one of the next.
SHIFT = 54
#: Digits that are rounded to a double: 73 bits at the least, of which a double has 53.
LEADING = 10
#: A band's sum has fewer than 63 + 2 * LIMB_BITS bits: so many more digits does the last carry take.
CARRY_DIGITS = 14
WIDE = "decimal(38,0)"
_STATE = ("_which", "_band", "_limb0", "_limb1", "_limb2", "_special", "_values")


def _scaled(value: Column, exponent: Column) -> Column:
    """value * 2 ** exponent in two steps, as one factor could be out of a double's range."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def _cell(which: int, value: Column) -> Column:
    """The state of one value; each step is evaluated once a row."""
    mask = (1 << LIMB_BITS) - 1

    def state(x: Column, band: Column, units: Column) -> Column:
        sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
        limbs = [sign * F.shiftright(units, LIMB_BITS * k).bitwiseAND(mask) for k in range(3)]
        fields = (F.lit(which), band.cast("int"), *limbs, F.when(~(F.abs(x) < float("inf")), x), x.isNotNull().cast("long"))
        return F.struct(*[f.alias(name) for f, name in zip(fields, _STATE, strict=True)])

    def in_band(x: Column, band: Column) -> Column:
        scaled = let(F.lit(float(SHIFT)) - BAND_BITS * band, lambda exponent: _scaled(F.abs(x), exponent))
        return let(scaled.cast("long"), lambda units: state(x, band, units))

    def cell(x: Column) -> Column:
        finite = (F.abs(x) < float("inf")) & (F.abs(x) > 0)
        return let(F.when(finite, F.floor(F.log2(F.abs(x)) / BAND_BITS)), lambda band: in_band(x, band))

    return let(value.cast("double"), cell)


def partial_sums(df: DataFrame, by: Sequence[str | Column], sums: Mapping[str, Column], *, rows: str | None = None,
                 least: Mapping[str, Column] | None = None, most: Mapping[str, Column] | None = None) -> DataFrame:
    """The bands of each sum per group; ``merged`` adds them up to coarser groups and ``totals`` ends them.

    ``rows`` names a count of the rows, ``least`` and ``most`` further columns to keep the smallest or largest value of.
    """
    extra = {**{n: c for n, c in (least or {}).items()}, **{n: c for n, c in (most or {}).items()}}
    cells = F.array(*[_cell(k, c) for k, c in enumerate(sums.values())])
    counted = {rows: F.lit(1).cast("long")} if rows else {}
    tall = df.select(*by, *[c.alias(n) for n, c in {**extra, **counted}.items()], F.inline(cells))
    keys = df.select(*by).columns
    return merged(tall, keys, rows=rows, least=list(least or {}), most=list(most or {}))


def merged(parts: DataFrame, by: Sequence[str], *, rows: str | None = None, least: Sequence[str] = (), most: Sequence[str] = ()) -> DataFrame:
    """Bands of coarser groups; the names of ``by`` are columns of ``parts``."""
    return parts.groupBy(*by, "_which", "_band").agg(
        *[F.sum(c).alias(c) for c in (*_STATE[2:], *([rows] if rows else []))],
        *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most])


def _digits(bands: Column, negative: bool) -> Column:
    """Digits of the sum, the lowest first, and whether a borrow is left, which the sum's negation has instead."""
    limb = lambda b, k: b[f"_limb{k}"].cast(WIDE) * F.lit(1 << (LIMB_BITS * k)).cast(WIDE)
    total = lambda b: limb(b, 0) + limb(b, 1) + limb(b, 2)
    by_band = F.map_from_entries(F.transform(bands, lambda b: F.struct(b["_band"], (-total(b) if negative else total(b)).cast(WIDE))))
    low, high = (f(F.transform(bands, lambda b: b["_band"])) for f in (F.array_min, F.array_max))
    # the map is part of the state, as a lambda would make it anew at every step
    start = F.struct(F.lit(0).cast(WIDE).alias("carry"), F.array().cast("array<int>").alias("digits"), by_band.alias("bands"))

    def step(state: Column, band: Column) -> Column:
        now = state["carry"] + F.coalesce(F.try_element_at(state["bands"], band), F.lit(0).cast(WIDE))
        digit = F.pmod(now, F.lit(1 << BAND_BITS).cast(WIDE)).cast("int")
        carry = ((now - digit.cast(WIDE)) / F.lit(1 << BAND_BITS)).cast(WIDE)
        return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits"), state["bands"].alias("bands"))

    return F.aggregate(F.sequence(low, high + CARRY_DIGITS), start, step)


def _rounded(digits: Column, low: Column) -> Column:
    """The double nearest to the sum of digits * 2 ** (BAND_BITS * (low + place) - SHIFT)."""
    top = F.array_max(F.transform(digits, lambda d, k: F.when(d > 0, k)))
    base = F.lit(1 << BAND_BITS).cast(WIDE)
    lead = F.aggregate(
        F.sequence(F.lit(0), F.lit(LEADING - 1)), F.lit(0).cast(WIDE),
        lambda n, k: (n * base + F.coalesce(F.get(digits, top - k), F.lit(0)).cast(WIDE)).cast(WIDE))
    rest = F.exists(F.slice(digits, F.lit(1), F.greatest(top - (LEADING - 1), F.lit(0))), lambda d: d > 0)
    sticky = F.when(rest & (F.pmod(lead, F.lit(2).cast(WIDE)) == 0), F.lit(1)).otherwise(F.lit(0))
    exponent = (low + top - (LEADING - 1)) * BAND_BITS - SHIFT
    return F.coalesce(_scaled((lead + sticky.cast(WIDE)).cast("double"), exponent.cast("double")), F.lit(0.0))


def _own(which: int) -> Column:
    return F.filter("_bands", lambda b: b["_which"] == which)


def totals(parts: DataFrame, by: Sequence[str], outs: Sequence[str], *, rows: str | None = None, least: Sequence[str] = (), most: Sequence[str] = ()) -> DataFrame:
    """One row per group with its sums; ``parts`` are unique by (``by``, sum, band), as the other two functions give them."""
    state = F.struct(*_STATE)
    of_sum = lambda k, c: F.when(F.col("_which") == k, F.col(c))
    grouped = parts.groupBy(*by).agg(
        F.collect_list(F.when(F.col("_band").isNotNull(), state)).alias("_bands"),
        *[F.sum(of_sum(k, c)).alias(f"{c}{k}") for k in range(len(outs)) for c in ("_special", "_values")],
        *([F.coalesce(F.sum(of_sum(0, rows)), F.lit(0)).alias(rows)] if rows else []),
        *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most])
    for k in range(len(outs)):
        grouped = grouped.withColumn(f"_own{k}", _own(k)).withColumn(f"_low{k}", F.array_min(F.transform(f"_own{k}", lambda b: b["_band"])))
        for name, negative in (("_plus", False), ("_minus", True)):
            grouped = grouped.withColumn(f"{name}{k}", F.when(F.size(f"_own{k}") > 0, _digits(F.col(f"_own{k}"), negative)))
    done = []
    for k, out in enumerate(outs):
        plus, minus, low = F.col(f"_plus{k}"), F.col(f"_minus{k}"), F.col(f"_low{k}")
        exact = F.when(plus.isNull(), F.lit(0.0)).when(plus["carry"] < 0, -_rounded(minus["digits"], low)).otherwise(_rounded(plus["digits"], low))
        done.append(F.when(F.col(f"_values{k}") > 0, F.coalesce(F.col(f"_special{k}"), exact)).alias(out))
    return grouped.select(*by, *([rows] if rows else []), *least, *most, *done)


def exact_sums(df: DataFrame, by: Sequence[str | Column], sums: Mapping[str, Column], *, rows: str | None = None,
               least: Mapping[str, Column] | None = None, most: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` grouped by ``by``, with sums of any doubles, each rounded once from its exact value.

    The bits of a sum do not depend on the order of rows, on partitioning or on retries; a plain sum of doubles changes in
    the last digits. NULL counts for nothing and alone gives NULL, infinities and NaN give what they give in a plain sum,
    exact sums beyond a double's range give an infinity. Without ``by`` there is one row, also for no rows. Groups may have
    4 * 10 ** 12 rows. A result below 2 ** -1022 may be rounded twice.
    """
    more = {"rows": rows, "least": least, "most": most}
    parts = partial_sums(df, by, sums, **more)
    return totals(parts, df.select(*by).columns, list(sums), rows=rows, least=list(least or {}), most=list(most or {}))
