"""Landing of delimited, grid and text files, and table saving."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import landing, tables


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id;nome\n1;São\n2; \"x;y\" \n".encode("latin-1"))
    got = landing.land_delimited(spark, landing.DelimitedSource("a", f"{tmp_path}/a.csv", ";", "ISO-8859-1"))
    assert got.columns == ["id", "nome", "_source_file", "_ingested_at"]
    assert dict(got.dtypes)["id"] == "string"
    assert [(r.id, r.nome, r._source_file) for r in got.collect()][0] == ("1", "São", "a.csv")


def test_byte_order_mark_and_line_breaks(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes('﻿id|texto\n1|"linha 1\nlinha 2"\n2|z\n'.encode())
    got = landing.land_delimited(spark, landing.DelimitedSource("b", f"{tmp_path}/b.csv", "|", multi_line=True))
    assert got.columns[0] == "id"
    assert [r.texto for r in got.orderBy("id").collect()] == ["linha 1\nlinha 2", "z"]


def test_grid(spark, tmp_path):
    lines = ["Metas 2024;;", "", "nota;;", "Regiao;Meta Ano;Jan", "SUL;10;1", ";;", "TOTAL GERAL;10;1", "", '"a;b";;2']
    (tmp_path / "g.csv").write_text("\r\n".join(lines))
    source = landing.GridSource("g", f"{tmp_path}/g.csv", sheet="Metas 2024", source_name="metas.xlsx")
    got = landing.land_grid(spark, source)
    assert got.columns == ["Regiao", "Meta_Ano", "Jan", "_source_file", "_source_sheet", "_ingested_at"]
    assert [tuple(r)[:5] for r in got.collect()] == [
        ("SUL", "10", "1", "metas.xlsx", "Metas 2024"), ("TOTAL GERAL", "10", "1", "metas.xlsx", "Metas 2024"),
        ("a;b", None, "2", "metas.xlsx", "Metas 2024")]


def test_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n20,10\n")
    got = landing.land_delimited(spark, landing.DelimitedSource("t", f"{tmp_path}/*.csv"))
    assert sorted((r.x, r.y, r._source_file) for r in got.collect()) == [("1", "2", "a.csv"), ("10", "20", "b.csv")]
    (tmp_path / "c.csv").write_text("y,z\n20,10\n")
    with pytest.raises(ValueError):
        landing.land_delimited(spark, landing.DelimitedSource("t", f"{tmp_path}/*.csv"))
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    (sheets / "1.csv").write_text("t;;\nRegiao;Jan;Fev\nSUL;1;2\n")
    (sheets / "2.csv").write_text("t;;\nRegiao;Fev;Jan\nSUL;20;10\n")
    grid = landing.land_grid(spark, landing.GridSource("g", str(sheets), header_line=2))
    assert sorted((r.Jan, r.Fev, r._source_file) for r in grid.collect()) == [("1", "2", "1.csv"), ("10", "20", "2.csv")]


def test_odd_headers(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Meta Ano;Meta_Ano;;x\n1;2;3;4\n")
    got = landing.land_grid(spark, landing.GridSource("g", f"{tmp_path}/g.csv", header_line=1))
    assert [tuple(r)[:4] for r in got.collect()] == [("1", "2", "3", "4")]
    assert got.columns[:4] == ["Meta_Ano", "Meta_Ano_2", "_c2", "x"]
    (tmp_path / "d.csv").write_text("a,,a\n1,2,3\n")
    got = landing.land_delimited(spark, landing.DelimitedSource("d", f"{tmp_path}/d.csv"))
    assert got.columns[:3] == ["a", "_c1", "a_2"] and tuple(got.first())[:3] == ("1", "2", "3")


def test_empty_namespace(spark):
    tables.create_namespace(spark, "bare")
    assert tables.inventory(spark, "bare").count() == 0


def test_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("primeira\n\n   \n\t\n\u00a0\nsegunda\n")
    got = landing.land_text(spark, landing.TextSource("t", f"{tmp_path}/t.txt"))
    assert [r.texto_premissa for r in got.orderBy("texto_premissa").collect()] == ["primeira", "segunda"]


def test_save_overwrites_schema_and_inventory(spark):
    tables.create_namespace(spark, "inv")
    tables.save_table(spark.range(3), "inv.t")
    again = tables.save_table(spark.range(5).withColumn("x", F.lit("a")), "inv.t", partition_by=["x"])
    assert again.columns == ["id", "x"]
    assert [tuple(r) for r in tables.inventory(spark, "inv").collect()] == [("t", 5)]


def test_sanitized_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, ` c(d)` int")
    assert landing.sanitize_columns(df).columns == ["a_b", "c_d_"]
