"""Catalog tables: namespace, full-overwrite save, scan, inventory, generated rows."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.staging import observed

#: The end of a version's name: milliseconds, then something that no other writer has.
VERSION = re.compile(r"__v\d{14}_[0-9a-f]{8}$")
#: What the names of a version's properties begin with that hold counts taken while it was written.
COUNT = "ledgerloom.count."


def create_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")


def _parts(table: str) -> tuple[str, str]:
    """The namespace, with its dot, and the bare name."""
    head, dot, name = table.rpartition(".")
    return head + dot, name


def versions(spark: SparkSession, table: str) -> list[str]:
    """Names of the table's versions that exist, the oldest first."""
    head, name = _parts(table)
    found = spark.catalog.listTables(head.rstrip(".") or None)
    own = re.compile(re.escape(name.lower()) + VERSION.pattern)
    return sorted(t.name for t in found if not t.isTemporary and own.fullmatch(t.name.lower()))


def current_version(spark: SparkSession, table: str) -> str | None:
    """The version that the table's name stands for."""
    if not spark.catalog.tableExists(table):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'View Text'").first()
    return next((v for v in versions(spark, table) if told and f"`{v.lower()}`" in told.data_type.lower()), None)


def _drop(spark: SparkSession, version: str) -> None:
    """A version and its files, also where they lie in a folder of the caller's."""
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").filter("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    if place:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place.data_type)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_old_versions(spark: SparkSession, table: str, keep: int = 1) -> None:
    """Drops all versions but the current one and the ``keep`` before it; also what unfinished writes have left before it."""
    head, _ = _parts(table)
    now = current_version(spark, table)
    older = [v for v in versions(spark, table) if now and v < now]
    for version in older[: len(older) - keep] if keep else older:
        _drop(spark, head + version)


def drop_table(spark: SparkSession, table: str) -> None:
    """The table and all its versions."""
    head, _ = _parts(table)
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for version in versions(spark, table):
        _drop(spark, head + version)


def save_table(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    path: str | None = None,
    keep: int = 1,
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace ``table``, schema included, in one step, and return a scan of what was written.

    Each write makes a table of its own, ``<table>__v<time>_<id>``, below ``path`` if that is given. When it is complete,
    one catalog command lets the view ``table`` stand for it. A run that dies before that leaves the old rows readable,
    and readers that have begun go on with the version they planned for: the ``keep`` versions before the new one stay.
    Where ``table`` is a plain table, it becomes the first version. Two writers at once both finish; the later view wins.

    Rows, and those that fulfil each condition of ``counts``, are counted while they are written; the version keeps the
    counts as properties, which ``written_counts`` reads.

    Reading back gives later steps file statistics and spares them the upstream plan.
    """
    spark = df.sparkSession
    head, name = _parts(table)
    stamp = f"{time.time_ns() // 1_000_000:014d}_{uuid.uuid4().hex[:8]}"
    version = f"{name}__v{stamp}"
    watched, seen = observed(df, counts or {})
    writer = watched.write.format(fmt).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/v{stamp}")
    writer.saveAsTable(f"{head}{version}")
    found = ", ".join(f"'{COUNT}{_quoted(name)}' = '{n}'" for name, n in seen.get.items())
    spark.sql(f"ALTER TABLE {head}{version} SET TBLPROPERTIES ({found})")
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {table} RENAME TO {head}{name}__v{0:014d}_{0:08d}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {head}`{version}`")
    drop_old_versions(spark, table, keep)
    return spark.table(table)


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def written_counts(spark: SparkSession, table: str, counts: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Rows of the table (``rows``) and of those that fulfil each condition, as counted when its current version was written.

    Where the version has no such counts, or the table no version, one pass over the rows takes them.
    """
    head, _ = _parts(table)
    wanted, version = {"rows", *(counts or {})}, current_version(spark, table)
    listed = spark.sql(f"SHOW TBLPROPERTIES {head}`{version}`").collect() if version else []
    kept = {r.key.removeprefix(COUNT): int(r.value) for r in listed if r.key.startswith(COUNT)}
    if wanted <= set(kept):
        return {name: kept[name] for name in wanted}
    true = [F.count_if(F.coalesce(holds, F.lit(False))).alias(name) for name, holds in (counts or {}).items()]
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows"), *true).first().asDict()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table, row count) row per table, in a single plan."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def inventory(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of a namespace with their row counts, which were taken when they were written."""
    names = sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary and not VERSION.search(t.name))
    counted = [(name, written_counts(spark, f"{namespace}.{name}")["rows"]) for name in names]
    return spark.createDataFrame(counted, "table_name string, n_rows long")


def rows_like(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """Rows with the columns and types of ``df``; columns that a row does not name are NULL."""
    written = [
        F.struct(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]) for row in rows
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*written)))
