"""Calendar dimension with fiscal parts, weekend, holiday and working-day flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.text import map_value


def date_spine(bounds: DataFrame, start: str, stop: str, day: str = "data") -> DataFrame:
    """Every day from ``start`` to ``stop``, two date columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(stop), F.expr("interval 1 day"))).alias(day))


def literal_bounds(spark: SparkSession, start: str, stop: str) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(stop).cast("date").alias("stop"))


def holidays_by_day(holidays: DataFrame, day: str, name: str) -> DataFrame:
    """One row per day even when a day is listed twice, so that the calendar cannot gain rows."""
    return holidays.filter(F.col(day).isNotNull()).groupBy(day).agg(F.min(name).alias(name))


def _named(text: Column, names: Mapping[str, str] | None) -> Column:
    return text if names is None else F.coalesce(map_value(text, names), text)


def calendar(
    days: DataFrame,
    holidays: DataFrame,
    first_month: int = 4,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Calendar over ``days(data)`` with ``holidays(data, descricao)`` that count as days off.

    Month and weekday names are English; ``names`` translates them.
    """
    d = F.col("data")
    off = holidays_by_day(holidays, "data", "descricao").withColumnRenamed("descricao", "nome_feriado")
    parts = days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("data_sk"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.quarter(d).alias("trimestre"),
        _named(F.date_format(d, "MMMM"), names).alias("nome_mes"),
        _named(F.date_format(d, "MMM"), names).alias("nome_mes_abrev"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        _named(F.date_format(d, "EEEE"), names).alias("nome_dia_semana"),
        F.dayofweek(d).alias("numero_dia_semana"),
        dates.is_weekend(d).alias("flag_fim_de_semana"),
        dates.fiscal_year(d, first_month).alias("ano_fiscal"),
        dates.fiscal_month(d, first_month).alias("mes_fiscal"),
        dates.fiscal_quarter(d, first_month).alias("trimestre_fiscal"),
        dates.fiscal_label(d, first_month).alias("label_ano_fiscal"),
    )
    flagged = parts.join(off.withColumn("_off", F.lit(True)), "data", "left")
    return flagged.withColumn("flag_feriado_nacional", F.coalesce("_off", F.lit(False))).withColumn(
        "flag_dia_util", ~F.col("flag_fim_de_semana") & ~F.col("flag_feriado_nacional")
    ).drop("_off")


def working_days(cal: DataFrame) -> DataFrame:
    return cal.groupBy("label_ano_fiscal").agg(
        F.count(F.lit(1)).alias("dias_total"),
        F.count_if("flag_dia_util").alias("dias_uteis"),
    )


def between_days(cal: DataFrame, start: str, stop: str, day: str = "data") -> DataFrame:
    return cal.filter(F.col(day).between(F.lit(start).cast("date"), F.lit(stop).cast("date")))
