"""As-of lookups written as equi joins on a prepared, unique right side.

Neither lookup changes the row count of the fact, sorts the fact inside a window, or joins a fact row to
more than one row of the right side, so a key that holds a large share of all rows is no special case:
Spark broadcasts a right side that it measures as small, and otherwise AQE may split the skewed partitions of
the join, whose exchange stands directly under it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.fixed_values import OPEN_END
from ledgerloom.functions.text import let

#: More pieces of a key's year than these are cut into pieces that do not overlap, 366 at the most.
MOST_PIECES = 64
#: Stands for the year of a row without a day, or with one of a year that was not asked for; it has no pieces of its own.
_NO_YEAR = date(9999, 1, 1)


def _beyond() -> Column:
    """Key of the row that holds for every day after the last boundary."""
    return F.lit(OPEN_END).cast("date")


def _years(months: Iterable[date]) -> set[date]:
    return {month.replace(month=1, day=1) for month in months}


def _dates(days: Iterable[date]) -> Column:
    return F.array(*[F.lit(day) for day in sorted(days)]).cast("array<date>")


def asof_rates(
    fact: DataFrame,
    quotes: DataFrame,
    *,
    day: str,
    currency: str,
    quote_day: str,
    quote_currency: str,
    quote_rate: str,
    out: str,
) -> DataFrame:
    """Latest rate quoted on or before ``day`` for the row's currency; NULL before the first quote.

    The quotes become one row per currency and day up to the last quote, plus one row per currency for all
    later days, so the lookup is an equality. Of two quotes for one day the higher one counts; one dated
    9999-12-31, the key of all later days, is none. They grow with the calendar and the currencies, not with the fact,
    and are broadcast: the fact, most of it in the base currency and so without a key, is not shuffled for them.
    """
    clean = (
        quotes.filter((F.col(quote_day) < _beyond()) & F.col(quote_rate).isNotNull())
        .groupBy(F.col(quote_currency).alias("_cur"), F.col(quote_day).alias("_from"))
        .agg(F.max(quote_rate).alias(out))
    )
    newest = clean.agg(F.max("_from")).first()[0]
    if newest is None:
        return fact.withColumn(out, F.lit(None).cast(quotes.schema[quote_rate].dataType))
    last = F.lit(newest)

    # Rows per currency are bounded by the days of the span because days were made unique above.
    following = F.lead("_from").over(Window.partitionBy("_cur").orderBy("_from"))
    dated = clean.withColumn("_next", following)
    until = F.coalesce(F.date_sub("_next", 1), last)
    one_day = F.expr("interval 1 day")
    days = F.when(F.col("_next").isNull(), F.concat(F.sequence("_from", until, one_day), F.array(_beyond())))
    spine = dated.withColumn("_until", until).select(
        "_cur", F.explode(F.coalesce(days, F.sequence("_from", "_until", one_day))).alias("_day"), out)

    probe = F.when(F.col(day) > last, _beyond()).otherwise(F.col(day))
    wanted = fact.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"  # the session's owner may refuse
    return (
        fact.withColumn("_probe", probe)
        .join(F.broadcast(spine) if wanted else spine, (F.col(currency) == F.col("_cur")) & (F.col("_probe") == F.col("_day")), "left")
        .drop("_probe", "_cur", "_day")
    )


def convert_currency(
    fact: DataFrame,
    quotes: DataFrame,
    *,
    day: str,
    currency: str,
    base: str,
    quote_day: str,
    quote_currency: str,
    quote_rate: str,
    out: str,
) -> DataFrame:
    """Add the rate to ``base``: 1.0 for the base currency itself, else the as-of rate (NULL when none)."""
    folded = fact.withColumn("_currency", F.upper(F.trim(currency)))
    folded_quotes = quotes.withColumn(quote_currency, F.upper(F.trim(quote_currency)))
    foreign = F.when(F.col("_currency") != base, F.col("_currency"))
    rated = asof_rates(
        folded.withColumn("_foreign", foreign), folded_quotes, day=day, currency="_foreign", quote_day=quote_day,
        quote_currency=quote_currency, quote_rate=quote_rate, out=out)
    return rated.withColumn(out, F.when(F.col("_currency") == base, F.lit(1.0)).otherwise(F.col(out))).drop(
        "_currency", "_foreign")


def interval_calendar(
    intervals: DataFrame,
    *,
    key: str,
    start: str,
    stop: str,
    is_open: str,
    values: Sequence[str],
    months: Sequence[date],
    beside: DataFrame | None = None,
) -> DataFrame:
    """One row per key and wanted year with the pieces of the intervals that fall into it.

    A piece is (first day, last day, winner). Of the pieces with the same first and last day only the one of
    the latest start is kept, equal starts being settled by the value columns. Where a year has many pieces they are
    cut at each other's ends, so a row holds 366 at the very most, however many intervals a key has. Only the years
    of ``months`` are laid out, so neither an open interval nor an outlier date makes more rows. All steps are aggregates that
    combine before their shuffle; the key columns are expressions over the last one, so that a join has its own exchange.

    ``beside`` is a ``unique_side`` of one key: its columns stand in each of the key's rows, and its keys have a row for every
    wanted year, with or without pieces, and one for all other years. A key of intervals that it lacks has NULL there.
    """
    winner = F.struct(F.col(start).alias("from"), *[F.col(v) for v in values])
    until = F.when(F.coalesce(F.col(is_open), F.lit(False)), _beyond()).otherwise(F.col(stop))
    ranged = intervals.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).alias("_s"), until.alias("_e"), winner.alias("_w"))
    years = _dates(_years(months))
    touched = F.filter(years, lambda y: (y >= F.trunc("_s", "YEAR")) & (y <= F.col("_e")))
    in_years = ranged.filter(F.col("_e") >= F.col("_s")).withColumn("_year", F.explode(touched))
    pieces = in_years.select(
        "_key", "_year", F.greatest("_s", "_year").alias("_first"),
        F.least(F.col("_e"), F.last_day(F.add_months("_year", 11))).alias("_last"), "_w",
    ).groupBy("_key", "_year", "_first", "_last").agg(F.max("_w").alias("_w"))
    listed, more = pieces.select("_key", "_year", F.struct("_first", "_last", "_w").alias("_piece")), []
    if beside is not None:
        marked, *more = beside.columns
        members = beside.filter(F.col(marked).isNotNull()).select(F.col(marked).alias("_key"), F.explode(_dates({*_years(months), _NO_YEAR})).alias("_year"), *more)
        listed = listed.unionByName(members, allowMissingColumns=True)
    held = listed.groupBy("_key", "_year").agg(F.collect_list("_piece").alias("_pieces"), *[F.max(c).alias(c) for c in more])
    some = F.size("_pieces") >= 0  # a list always; Catalyst does not know
    cut = F.when(F.size("_pieces") > MOST_PIECES, _apart(F.col("_pieces"))).otherwise(F.col("_pieces"))
    return held.select(*[F.when(some, F.col(c)).alias(c) for c in ("_key", "_year")], cut.alias("_pieces"), *more)


def _winner(pieces: Column, day: Column) -> Column:
    """The latest start of the pieces that hold on a day, NULL where none does."""
    return F.array_max(F.transform(F.filter(pieces, lambda p: day.between(p["_first"], p["_last"])), lambda p: p["_w"]))


def _apart(pieces: Column) -> Column:
    """Pieces that do not overlap, with the same winner on every day."""
    ends = F.concat(F.transform(pieces, lambda p: p["_first"]), F.transform(pieces, lambda p: F.date_add(p["_last"], 1)))

    def between(days: Column) -> Column:
        parts = F.transform(days, lambda d, n: F.struct(
            d.alias("_first"), F.date_sub(F.get(days, n + 1), 1).alias("_last"), _winner(pieces, d).alias("_w")))
        return F.filter(parts, lambda p: p["_w"].isNotNull())

    return let(F.array_sort(F.array_distinct(ends)), between)


def asof_interval(
    fact: DataFrame,
    intervals: DataFrame,
    *,
    key: str,
    day: str,
    interval_key: str,
    start: str,
    stop: str,
    is_open: str,
    values: dict[str, str],
    months: Sequence[date] | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """Values of the interval that holds on the row's day; both ends count, the latest start wins.

    ``values`` maps interval columns to the columns added to the fact, NULL where no interval holds. ``months`` are the
    first days of all months that the fact has, as ``staging.staged_with_months`` gathers them while it writes; days of
    other years find no interval. Without it the fact is read once more for them, so pass a written one.

    ``beside`` is a ``unique_side`` of the same key, whose columns (all but the key's) the fact gets by the same join, whatever
    the row's day: a fact that needs both is shuffled by the key once.
    """
    year = F.trunc(day, "YEAR")
    if months is None:
        # at most one row per year of the calendar
        months = [row.y for row in fact.select(year.alias("y")).distinct().dropna().orderBy("y").collect()]
    if not months and beside is None:
        types = {f.name: f.dataType for f in intervals.schema.fields}
        return fact.withColumns({out: F.lit(None).cast(types[v]) for v, out in values.items()})
    right = interval_calendar(
        intervals, key=interval_key, start=start, stop=stop, is_open=is_open, values=list(values), months=months, beside=beside)
    if beside is not None:
        year = F.when(F.array_contains(_dates(_years(months)), year), year).otherwise(F.lit(_NO_YEAR))
    joined = fact.withColumn("_probe", year).join(
        right, (F.col(key) == F.col("_key")) & (F.col("_probe") == F.col("_year")), "left")
    picked = joined.withColumn("_held", _winner(F.col("_pieces"), F.col(day)))
    return picked.withColumns({out: F.col("_held").getField(v) for v, out in values.items()}).drop(
        "_probe", "_key", "_year", "_pieces", "_held")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in ``order``, by an aggregate that combines before the shuffle.

    Remaining ties are settled by the other columns, so the result is the same on every run.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *others)
    top = df.groupBy(*keys).agg(F.max(row).alias("_top"))
    return top.select(*keys, "_top.*").select(*df.columns)
