"""Dimension modelling: surrogate keys, extra members, key resolution, hierarchy, conformed dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.operators.joins import drop_side, left_join_unique, unique_side
from ledgerloom.sources.staging import staged
from ledgerloom.sources.tables import rows_like

_ROW_IN_PARTITION = (1 << 33) - 1


def with_surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    sk: str,
    partitions: int | None = None,
) -> DataFrame:
    """Dense numbers 1..N in the order of ``order_by``, which should end in columns that break ties.

    The rows are range-partitioned and sorted, each takes its position inside its partition, and they are
    written once; the partition sizes (one row per partition) then give the offsets. Numbers are computed from
    the written rows, so a lost executor cannot change a partition boundary half-way, and whoever reads the
    dimension twice does not build it twice.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(
        df.repartitionByRange(n, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION))),
        "surrogate",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(sk, F.col("_offset") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_offset")
        .select(*df.columns, sk)
    )


def with_sentinels(df: DataFrame, sentinels: Sequence[dict]) -> DataFrame:
    """Put extra members in front; a sentinel names only some columns, the others stay NULL."""
    return rows_like(df, sentinels).unionByName(df)


def unique_lookup(dim: DataFrame, code: str, sk: str) -> DataFrame:
    """Surrogate key per code, for the real members whose code belongs to one member only."""
    real = dim.filter((F.col(sk) > 0) & F.col(code).isNotNull()).select(F.col(code).alias("_code"), sk)
    return unique_side(real, ["_code"], [F.max(sk).alias("_sk")], max_rows=1)


def resolve_key(
    fact: DataFrame,
    dim: DataFrame | None,
    *,
    code: str,
    dim_code: str | None = None,
    dim_sk: str | None = None,
    out: str,
    ambiguous: str | None = None,
    missing: int = -1,
    ambiguous_member: int = -2,
    unknown: int = -1,
) -> DataFrame:
    """Surrogate key of ``code`` without ever changing the row count.

    A missing code gives ``missing`` and a flagged one ``ambiguous_member``; neither takes part in the join.
    Any other code that is not a unique member gives ``unknown``. Catalyst broadcasts the lookup while it is
    below the session's broadcast threshold and otherwise joins on the key, where AQE may split a hot one.
    Without ``dim`` the fact has the columns of ``unique_lookup`` already, from a join that brought something else too.
    """
    flagged = F.lit(False) if ambiguous is None else F.coalesce(F.col(ambiguous), F.lit(False))
    found = (
        F.when(F.col(code).isNull(), F.lit(missing))
        .when(flagged, F.lit(ambiguous_member))
        .otherwise(F.coalesce(F.col("_sk"), F.lit(unknown)))
    )
    if dim is None:
        joined = fact
    elif ambiguous is None:  # no second copy of the code goes through the shuffle
        joined = left_join_unique(fact, unique_lookup(dim, dim_code, dim_sk), {code: "_code"})
    else:
        probed = fact.withColumn("_probe", F.when(~flagged, F.col(code)))
        joined = left_join_unique(probed, unique_lookup(dim, dim_code, dim_sk), {"_probe": "_code"})
    return drop_side(joined.withColumn(out, found.cast("long")), {code: "_code"}, "_probe", "_sk")


def flatten_hierarchy(
    df: DataFrame,
    *,
    member: str,
    parent: str,
    name: str,
    group: str,
    group_name: str,
    is_head: str,
    orphan: str,
    orphan_label: str,
) -> DataFrame:
    """One level of head office: group id and name per member. A parent that no row has is flagged and labelled.

    A head office that exists without a name is no orphan; its branches then go under their own name.
    """
    offices = unique_side(df.select(member, name), [member], [F.min(name).alias("_office")])
    on = {group: member}
    placed = left_join_unique(df.withColumn(group, F.coalesce(parent, member)), offices, on)
    branch = F.col(parent).isNotNull()
    unknown = branch & F.col("_rows").isNull()
    named = (
        F.when(unknown, F.format_string(orphan_label.replace("%", "%%") + "%s)", F.col(parent)))
        .otherwise(F.coalesce("_office", name))
    )
    return drop_side(placed.withColumns({is_head: ~branch, orphan: unknown, group_name: named}), on, "_office")


def conformed_dimension(frames: Sequence[DataFrame], columns: Sequence[str], sk: str) -> DataFrame:
    """Distinct members seen in any of the frames, numbered; members with a missing part are left out."""
    members = None
    for frame in frames:
        part = frame.select(*columns).na.drop(how="any").distinct()
        members = part if members is None else members.unionByName(part)
    return with_surrogate_key(members.distinct(), columns, sk)
