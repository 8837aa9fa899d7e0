"""Shared folder for intermediate tables that must survive the loss of an executor."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Seconds of a write that leaves too little behind to be worth a collection; the next long one takes it along.
BRIEF = 5.0


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or where that is unset one in the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staged"


def run_folder(spark: SparkSession) -> str:
    """What this session stages."""
    return f"{shared_folder(spark)}/ledgerloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back: the lineage ends there.

    So do the shuffles of a write that took its time, whose files would else stay on the executors' disks beside those of all
    later steps.
    """
    spark = df.sparkSession
    path, began = fresh_path(spark, label), time.monotonic()
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    if time.monotonic() - began > BRIEF:
        release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that have ended; those of plans that somebody still holds stay.

    Its cleaner does so once the driver's JVM has collected the plan, which a driver with memory to spare puts off for half an
    hour. What the cleaner takes away first holds the rest, so one collection is not enough.
    """
    for _ in range(3):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def discard(written: DataFrame) -> None:
    """Remove a table that ``staged`` has written and that nothing reads any more."""
    spark = written.sparkSession
    top = f"/{run_folder(spark).rsplit('/', 1)[-1]}/"
    for name in {file.split(top, 1)[1].split("/", 1)[0] for file in written.inputFiles() if top in file}:
        _remove(spark, f"{run_folder(spark)}/{name}")


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with a count of its rows (``rows``) and of those that fulfil each condition, to be taken by its next action.

    The counts belong to the stage that writes, whose tasks count once however often they run.
    """
    seen = Observation()
    true = {name: F.count_if(F.coalesce(holds, F.lit(False))) for name, holds in counts.items()}
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[count.alias(name) for name, count in true.items()]), seen


def staged_with_months(df: DataFrame, label: str, day: str) -> tuple[DataFrame, list[date]]:
    """``staged`` and the months (first days, in order) that ``day`` falls into, gathered by the stage that writes.

    There is one entry a month of the calendar, however many rows; null days have none.
    """
    seen = Observation()
    months = F.sort_array(F.collect_set(F.trunc(day, "MM"))).alias("months")
    written = staged(df.observe(seen, months), label)
    return written, list(seen.get["months"])


def staged_counted(
    df: DataFrame, label: str, counts: Mapping[str, Column] | None = None, partition_by: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, int]]:
    """``staged`` and the counts of ``observed``: nothing is read again to count."""
    watched, seen = observed(df, counts or {})
    return staged(watched, label, partition_by), seen.get


def clear(spark: SparkSession) -> None:
    """Remove what this session staged, once nothing reads it any more."""
    _remove(spark, run_folder(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
