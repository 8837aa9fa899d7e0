"""Tables are replaced in one step; old versions stay readable."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import tables


@pytest.fixture
def space(spark):
    name = f"ns_{uuid.uuid4().hex[:8]}"
    tables.create_namespace(spark, name)
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def failing(spark):
    return spark.range(100, numPartitions=4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))


def test_a_run_that_dies_leaves_the_old_rows(spark, space):
    tables.save_table(spark.range(3), f"{space}.t")
    with pytest.raises(Exception, match="killed"):
        tables.save_table(failing(spark), f"{space}.t")
    assert sorted(r.id for r in spark.table(f"{space}.t").collect()) == [0, 1, 2]
    assert [tuple(r) for r in tables.inventory(spark, space).collect()] == [("t", 3)]
    tables.save_table(spark.range(5), f"{space}.t", keep=0)
    assert spark.table(f"{space}.t").count() == 5 and len(tables.versions(spark, f"{space}.t")) == 1


def test_readers_finish_on_their_version(spark, space, tmp_path):
    table, path = f"{space}.t", str(tmp_path / "t")
    old = tables.save_table(spark.range(3), table, path=path)
    new = tables.save_table(spark.range(4).select(F.col("id").cast("string").alias("name"), F.lit("007").alias("part")), table, partition_by=["part"], path=path)
    assert sorted(r.id for r in old.collect()) == [0, 1, 2]
    assert new.dtypes == spark.table(table).dtypes == [("name", "string"), ("part", "string")]
    assert {r.part for r in new.collect()} == {"007"}
    assert tables.versions(spark, table)[-1] == tables.current_version(spark, table)
    tables.save_table(spark.range(1), table, path=path)
    assert len(tables.versions(spark, table)) == len(os.listdir(path)) == 2
    tables.drop_table(spark, table)
    assert os.listdir(path) == [] and not spark.catalog.tableExists(table) and tables.versions(spark, table) == []


def test_a_table_that_reads_itself(spark, space):
    table = f"{space}.t"
    tables.save_table(spark.range(3), table)
    tables.save_table(spark.table(table).unionByName(spark.range(3, 5)), table)
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(5))


def test_plain_tables_become_versions(spark, space):
    table = f"{space}.T2"
    spark.range(2).write.saveAsTable(table)
    assert tables.current_version(spark, table) is None
    tables.save_table(spark.range(7), table)
    assert spark.table(table).count() == 7 and len(tables.versions(spark, table)) == 2
    assert [tuple(r) for r in tables.inventory(spark, space).collect()] == [("t2", 7)]
    tables.drop_old_versions(spark, table, keep=0)
    assert len(tables.versions(spark, table)) == 1


def test_names_that_begin_alike(spark, space):
    tables.save_table(spark.range(1), f"{space}.t")
    tables.save_table(spark.range(2), f"{space}.t_more")
    tables.save_table(spark.range(3), f"{space}.t", keep=0)
    assert spark.table(f"{space}.t_more").count() == 2 and spark.table(f"{space}.t").count() == 3


def test_counts_are_taken_while_writing(spark, space, monkeypatch):
    table, even = f"{space}.n", {"it's even": F.col("id") % 2 == 0, "a\\b": F.col("id") < F.lit(None)}
    tables.save_table(spark.range(10), table, counts=even)
    monkeypatch.setattr(type(spark), "table", lambda *_: pytest.fail("read to be counted"))
    assert tables.written_counts(spark, table, even) == {"rows": 10, "it's even": 5, "a\\b": 0}
    assert tables.written_counts(spark, table) == {"rows": 10}
    monkeypatch.undo()
    assert tables.written_counts(spark, table, {"low": F.col("id") < 3}) == {"rows": 10, "low": 3}  # not counted then
    tables.save_table(spark.range(0), table, counts=even)
    assert tables.written_counts(spark, table, even) == {"rows": 0, "it's even": 0, "a\\b": 0}


def test_a_plain_table_is_counted_by_reading(spark, space):
    spark.range(4).write.saveAsTable(f"{space}.plain")
    assert tables.written_counts(spark, f"{space}.plain", {"one": F.col("id") == 1}) == {"rows": 4, "one": 1}
