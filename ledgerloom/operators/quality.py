"""Duplicate, reject, orphan and ambiguity operators and the quality reports built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import drop_side, left_join_unique, unique_side


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- duplicates ------------------------------------------------------------------------------------


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of the rows that agree in every column; copies collapse before the shuffle.

    The columns are expressions over the aggregate. Catalyst moves a filter on plain grouping columns below the
    aggregate, where each row would be parsed for the filter and once more for the columns.
    """
    once = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return once.select(*[F.when(F.col("_copies") >= 1, F.col(c)).alias(c) for c in df.columns])


def duplicate_accounting(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows before and after exact-duplicate removal, in one pass over ``df``."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return rows.groupBy(*by).agg(
        F.sum("_copies").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count (the fan-out check of a declared grain)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def flag_duplicates(df: DataFrame, key: str, flag: str) -> DataFrame:
    """True where another row holds the same key; a missing or blank key is never a duplicate.

    Keys are counted by an aggregate and joined back instead of counted in a window, which would bring all
    rows of a frequent key into one task.
    """
    present = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    on = {key: key}
    counted = unique_side(df.filter(present).select(key), [key], [])
    flagged = left_join_unique(df, counted, on).withColumn(flag, F.coalesce(F.col("_rows") > 1, F.lit(False)))
    return drop_side(flagged, on)


def flag_ambiguous(df: DataFrame, code: str, owners: DataFrame, owner_code: str, owner_flag: str, flag: str) -> DataFrame:
    """Carry the duplicate flag of a dimension to every row that uses one of its duplicated codes."""
    on = {code: owner_code}
    shared = unique_side(owners.filter(F.col(owner_flag)).select(owner_code), [owner_code], [])
    return drop_side(left_join_unique(df, shared, on).withColumn(flag, F.col("_rows").isNotNull()), on)


# -- rejects ---------------------------------------------------------------------------------------


def tag_rejects(df: DataFrame, rules: Mapping[str, Column], reason: str = "motivo_rejeicao") -> DataFrame:
    """Join the codes of all broken rules with ``"; "``; the empty text means a valid row."""
    codes = [F.when(F.coalesce(broken, F.lit(False)), F.lit(code)) for code, broken in rules.items()]
    return df.withColumn(reason, F.concat_ws("; ", *codes))


def split_tagged(df: DataFrame, reason: str = "motivo_rejeicao") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); every row is in exactly one of them."""
    return df.filter(F.col(reason) == "").drop(reason), df.filter(F.col(reason) != "")


#: The column that a tagged table is written apart by.
ROUTE = "rota"
ROUTES = _VALID, _REJECTED = "validas", "rejeitadas"


def routed(df: DataFrame, reason: str = "motivo_rejeicao") -> DataFrame:
    """Tagged rows with their route, to be written once, partitioned by ``ROUTE``; ``split_routed`` then reads only one part."""
    return df.withColumn(ROUTE, F.when(F.col(reason) == "", F.lit(_VALID)).otherwise(F.lit(_REJECTED)))


def split_routed(df: DataFrame, reason: str = "motivo_rejeicao") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of a table that is partitioned by ``ROUTE``; the filters prune its files."""
    return df.filter(F.col(ROUTE) == _VALID).drop(reason, ROUTE), df.filter(F.col(ROUTE) == _REJECTED).drop(ROUTE)


def split_rejects(
    df: DataFrame, rules: Mapping[str, Column], reason: str = "motivo_rejeicao"
) -> tuple[DataFrame, DataFrame]:
    return split_tagged(tag_rejects(df, rules, reason), reason)


def reject_counts(rejected: DataFrame, source: str, by: str = "safra", reason: str = "motivo_rejeicao") -> DataFrame:
    return rejected.groupBy(by, reason).agg(F.count(F.lit(1)).alias("quantidade")).select(
        F.lit(source).alias("fonte"), by, F.col(reason).alias("motivo"), "quantidade")


# -- inference and coverage ------------------------------------------------------------------------


def infer_missing(df: DataFrame, column: str, treated: Column, fallback: Column, flag: str) -> DataFrame:
    """``treated``, else ``fallback``; the flag marks the rows whose value came from the fallback."""
    return df.withColumns({
        flag: treated.isNull() & fallback.isNotNull(),
        column: F.coalesce(treated, fallback),
    })


def unmapped(df: DataFrame, treated: str, original: str) -> DataFrame:
    """Source values that no rule recognised, with their row count."""
    return df.filter(F.col(treated).isNull()).groupBy(original).agg(F.count(F.lit(1)).alias("n_rows"))


# -- referential checks ----------------------------------------------------------------------------


@dataclass(frozen=True)
class KeyCheck:
    """One foreign key to test against a dimension."""

    fact_name: str
    fact: DataFrame
    fk: str
    dim_name: str
    dim: DataFrame
    pk: str


def orphan_keys(fact: DataFrame, fk: str, dim: DataFrame, pk: str, ignore_nulls: bool = True) -> DataFrame:
    """Distinct foreign keys without a member. Keys are made distinct before the join, so it sees no skew."""
    members = dim.groupBy(F.col(pk).alias("_member")).agg(F.lit(True).alias("_known"))
    used = fact.groupBy(fk).agg(F.lit(True).alias("_used"))
    kept = used.dropna(subset=[fk]) if ignore_nulls else used
    return kept.join(members, F.col(fk) == F.col("_member"), "left").filter(F.col("_known").isNull()).select(fk)


def orphan_key_report(checks: Sequence[KeyCheck]) -> DataFrame:
    """Number of distinct keys without a member per check. A fact is read once for all of its checks."""
    facts: dict[str, list[tuple[int, KeyCheck]]] = {}
    for number, check in enumerate(checks):
        facts.setdefault(check.fact_name, []).append((number, check))
    used = _union([
        own[0][1].fact.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("n"), F.col(c.fk).cast("string").alias("key")) for n, c in own]))).dropna().distinct()
        for own in facts.values()
    ])
    members = _union([
        c.dim.select(F.lit(n).alias("n"), F.col(c.pk).cast("string").alias("key")) for n, c in enumerate(checks)
    ]).dropna().groupBy("n", "key").agg(F.lit(True).alias("known"))
    missing = used.join(members, ["n", "key"], "left").filter(F.col("known").isNull()).groupBy("n").agg(
        F.count(F.lit(1)).alias("missing"))
    listed = checks[0].fact.sparkSession.createDataFrame(
        [(n, c.fact_name, c.fk, c.dim_name) for n, c in enumerate(checks)],
        "n int, fato string, coluna_fk string, dimensao_referenciada string")
    return listed.join(missing, "n", "left").select(
        "fato", "coluna_fk", "dimensao_referenciada", F.coalesce("missing", F.lit(0)).alias("chaves_distintas_orfas"))


def ambiguous_key_report(entries: Sequence[tuple[str, str, DataFrame, str, str]]) -> DataFrame:
    """Flagged rows per (table, column, frame, flag, description)."""
    return _union([
        df.agg(F.count_if(flag).alias("quantidade")).select(
            F.lit(table).alias("tabela"), F.lit(column).alias("coluna"), "quantidade",
            F.lit(text).alias("descricao"))
        for table, column, df, flag, text in entries
    ])


# -- volumes ---------------------------------------------------------------------------------------


def volume_report(
    source: str, landed: DataFrame, valid: DataFrame, rejected: DataFrame, by: str, layouts: Sequence[str]
) -> DataFrame:
    """Landed, valid, rejected and removed rows for each of ``layouts``, also one that landed no row.

    ``removed`` is what valid and rejected rows leave over.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))

    listed = landed.sparkSession.createDataFrame([(layout,) for layout in layouts], f"`{by}` string")
    return (
        listed.join(counted(landed, "linhas_bronze"), by, "left")
        .join(counted(valid, "linhas_validas"), by, "left")
        .join(counted(rejected, "linhas_rejeitadas_ou_orfas"), by, "left")
        .na.fill(0, ["linhas_bronze", "linhas_validas", "linhas_rejeitadas_ou_orfas"])
        .select(
            F.lit(source).alias("fonte"), F.col(by).alias("safra"), "linhas_bronze", "linhas_validas",
            "linhas_rejeitadas_ou_orfas",
            (F.col("linhas_bronze") - F.col("linhas_validas") - F.col("linhas_rejeitadas_ou_orfas")).alias(
                "duplicatas_removidas"))
    )


def volume_of_split(source: str, layout: str, df: DataFrame, valid: Column, removed: int = 0) -> DataFrame:
    """Volume row of a source that is split by a condition and never drops rows."""
    return df.agg(
        F.count(F.lit(1)).alias("linhas_bronze"),
        F.count_if(valid).alias("linhas_validas"),
        F.count_if(~valid).alias("linhas_rejeitadas_ou_orfas"),
    ).select(
        F.lit(source).alias("fonte"), F.lit(layout).alias("safra"), "linhas_bronze", "linhas_validas",
        "linhas_rejeitadas_ou_orfas", F.lit(removed).cast("long").alias("duplicatas_removidas"))


def per_value(column: str, values: Sequence[str]) -> dict[str, Column]:
    """A condition for each value of a column, to be counted while rows are written."""
    return {value: F.col(column) == value for value in values}


def volume_of_counts(spark: SparkSession, source: str, counted: Mapping[str, tuple[int, int, int]]) -> DataFrame:
    """The volume report of counts that the writes have taken: landed, valid and rejected rows of each layout."""
    rows = [(source, layout, landed, valid, rejected, landed - valid - rejected) for layout, (landed, valid, rejected) in counted.items()]
    return spark.createDataFrame(
        rows, "fonte string, safra string, linhas_bronze long, linhas_validas long, linhas_rejeitadas_ou_orfas long, "
        "duplicatas_removidas long")


def row_counts(named: Mapping[str, DataFrame]) -> DataFrame:
    return _union([
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("check_name"), "n_rows")
        for name, df in named.items()
    ])


def period_covered(df: DataFrame, day: str, source: str) -> DataFrame:
    return df.agg(F.min(day).cast("string").alias("periodo_inicio"), F.max(day).cast("string").alias("periodo_fim")
                  ).select(F.lit(source).alias("fonte"), "periodo_inicio", "periodo_fim")


def refresh_metadata(df: DataFrame, day: str, source: str) -> DataFrame:
    return period_covered(df, day, source).withColumn("atualizado_em", F.current_timestamp())


def count_checks(checked: Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """(check_name, n_rows) for named conditions; each frame is read once for all of its conditions."""
    parts = []
    for df, conditions in checked:
        row = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n_rows")) for n in conditions])
        parts.append(row.select(F.inline(pairs)))
    return _union(parts)
