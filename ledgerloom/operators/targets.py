"""Target grids (one column per month) to rows, annual targets, totals-row and divergence checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import MONTH_NUMBERS, REGION_VARIANTS, SEGMENT_VARIANTS, TOTALS_LABEL
from ledgerloom.functions.parsing import currency_text, month_start
from ledgerloom.functions.text import canonical
from ledgerloom.operators.sums import exact_sums, partial_sums, totals


def typed_grid(
    grid: DataFrame,
    year: int | None = None,
    regions: Mapping[str, str] = REGION_VARIANTS,
    segments: Mapping[str, str] = SEGMENT_VARIANTS,
    region: str = "Regiao",
    segment: str = "Segmento",
) -> DataFrame:
    """Year, canonical region and segment next to the raw labels.

    The raw labels are renamed: a treated column whose name differs only by case would replace them.
    """
    tagged = grid if year is None else grid.withColumn("ano", F.lit(year))
    raw = tagged.withColumnsRenamed({region: "regiao_original", segment: "segmento_original"})
    return raw.withColumns({
        "regiao": canonical(F.col("regiao_original"), regions),
        "segmento": canonical(F.col("segmento_original"), segments),
    })


def detail_rows(typed: DataFrame) -> DataFrame:
    """Rows of a known segment: leaves out totals, blank and note rows."""
    return typed.filter(F.col("segmento").isNotNull())


def totals_rows(typed: DataFrame, label: str = TOTALS_LABEL) -> DataFrame:
    return typed.filter(F.upper(F.trim("regiao_original")) == label)


def annual_targets(detail: DataFrame, column: str = "Meta_Ano") -> DataFrame:
    return detail.select("ano", "regiao", "segmento", currency_text(F.col(column)).alias("meta_ano"))


def months_to_rows(
    df: DataFrame, ids: Sequence[str], value: str, months: Mapping[str, int] = MONTH_NUMBERS
) -> DataFrame:
    """Twelve rows per grid row; an empty cell stays a row whose value is NULL (no target, not zero)."""
    cells = [
        F.struct(F.lit(number).alias("mes"), F.col(name.capitalize()).alias("_cell"))
        for name, number in months.items()
    ]
    return df.select(*ids, F.inline(F.array(*cells))).select(*ids, "mes", currency_text(F.col("_cell")).alias(value))


def monthly_targets(detail: DataFrame) -> DataFrame:
    tall = months_to_rows(detail, ["ano", "regiao", "segmento"], "meta_mensal")
    return tall.withColumn("data_referencia", month_start(F.col("ano"), F.col("mes")))


def compared(left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str, right_value: str) -> DataFrame:
    """Exact sums of two amounts per key and of what the left has over the right, for keys that both sides hold.

    The sides are stacked, the right one with the opposite sign in the difference: one aggregate, and no join.
    """
    side = lambda df, value, sign: df.select(
        *keys, F.lit(sign).alias("_side"), F.col(value).cast("double").alias("_amount"))
    stacked = side(left, left_value, 1).unionByName(side(right, right_value, -1))
    amount, sign = F.col("_amount"), F.col("_side")
    summed = exact_sums(
        stacked, list(keys),
        {left_value: F.when(sign == 1, amount), right_value: F.when(sign == -1, amount), "_over": sign * amount},
        least={"_first": sign}, most={"_last": sign})
    both = F.col(left_value).isNotNull() & F.col(right_value).isNotNull()
    return summed.filter("_first < _last").select(
        *keys, left_value, right_value, F.when(both, F.round("_over", 2)).alias("diferenca"))


def control_totals(monthly: DataFrame, declared_rows: DataFrame) -> DataFrame:
    """Sum of the unpivoted months against the totals row the file itself carries."""
    declared = months_to_rows(declared_rows, ["ano"], "total_arquivo")
    return compared(monthly.withColumnRenamed("meta_mensal", "soma_calculada"), declared, ["ano", "mes"], "soma_calculada", "total_arquivo")


def annual_divergence(monthly: DataFrame, annual: DataFrame) -> DataFrame:
    """Combinations whose annual target is not the sum of their months (the annual one prevails)."""
    months = monthly.withColumnRenamed("meta_mensal", "soma_meses")
    return compared(annual, months, ["ano", "regiao", "segmento"], "meta_ano", "soma_meses").filter("diferenca <> 0")


def undefined_targets(monthly: DataFrame) -> DataFrame:
    return monthly.filter(F.col("meta_mensal").isNull()).groupBy("regiao", "segmento", "mes").agg(
        F.count(F.lit(1)).alias("n_undefined"))


def repeated_annual_measure(targets: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """What a plain sum of a repeated measure gives, next to its true value."""
    return exact_sums(targets, list(keys), {"soma_ingenua": F.col(measure)}, least={"valor_real": F.col(measure)})


def rolled_up(facts: DataFrame, grain: Sequence[str], measure: str, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Totals of a measure that belongs to ``grain`` and is repeated on finer rows, for each level (a subset of the grain).

    Rows are reduced to one per grain key first, also before they are shuffled, so each value counts once; ``soma_ingenua``
    is what the repeated rows add up to. Columns that a level leaves out are NULL, and ``nivel`` names the level's columns.
    A grain key with several values counts with its smallest.
    """
    once = partial_sums(facts, list(grain), {"soma_ingenua": F.col(measure)}, least={"valor": F.col(measure)})
    per_key = totals(once, list(grain), ["soma_ingenua"], least=["valor"])
    kept = [F.struct(*[(F.col(c) if c in level else F.lit(None)).alias(c) for c in grain], F.lit(",".join(level)).alias("nivel")) for level in levels]
    spread = per_key.select("soma_ingenua", "valor", F.explode(F.array(*kept)).alias("at")).select("at.*", "soma_ingenua", "valor")
    return exact_sums(spread, ["nivel", *grain], {"soma_ingenua": F.col("soma_ingenua"), "total": F.col("valor")}, rows="chaves")
