"""Tables that a job writes and reads again, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scratch_root(spark: SparkSession) -> str:
    """This session's folder below ``spark.checkpoint.dir``; where that is unset, below the warehouse."""
    top = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{top.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, kept when an executor is lost."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes what this session wrote; results that are still unread need these tables."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def widened(df: DataFrame, **columns: str) -> T.StructType:
    """The schema of ``df`` with further columns of the given types."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T.DataType.fromDDL(t)) for n, t in columns.items())])
