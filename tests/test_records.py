"""Multi-line records by quote parity over splits, against Spark's own reader of whole files; headers and compressed files."""

import gzip
import random

import pytest

from ledgerloom.sources import landing, records


@pytest.fixture
def tiny_splits(spark):
    """Splits of 40 bytes, so that records, quoted fields and quotes themselves are cut anywhere."""
    wanted = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def random_file(rng, rows, end="\n", quote=r"\""):
    def cell():
        text = "".join(rng.choice(["a", "é", " ", "\n", "\n\n", quote, ";", "x" * 30, "\r\n"]) for _ in range(rng.randrange(7)))
        return f'"{text}"' if rng.random() < 0.6 else rng.choice(["", "plain", "7", "ünï"])

    return "id;text;more" + end + "".join(f"{k};{cell()};{cell()}{end}" + (end if rng.random() < 0.1 else "") for k in range(rows))


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "text", "more").collect()), key=str)


@pytest.mark.parametrize(("encoding", "end", "escape"), [("UTF-8", "\n", "\\"), ("ISO-8859-1", "\r\n", "\\"), ("UTF-8", "\n", '"')])
def test_like_whole_files(spark, tmp_path, tiny_splits, encoding, end, escape):
    rng = random.Random(f"{encoding}{end}")
    for k, n in enumerate([60, 1, 0, 25]):
        (tmp_path / f"{k}.csv").write_bytes(random_file(rng, n, end, f'{escape}"').encode(encoding))
    (tmp_path / "long.csv").write_bytes(f'id;text;more{end}1;"{"word\n" * 100}";z{end}2;a;"b'.encode(encoding) + f'"{end}'.encode(encoding))
    want = spark.read.csv(str(tmp_path), schema="id string, text string, more string", header=True, sep=";", encoding=encoding, escape=escape, multiLine=True)
    got = landing.land_delimited(spark, landing.DelimitedSource("t", str(tmp_path), ";", encoding, multi_line=True, escape=escape))
    assert rows_of(got) == rows_of(want) != []


def test_one_file_is_read_by_many_tasks_and_shuffled_once(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text(random_file(random.Random(1), 200))
    found = records.records(spark, [str(tmp_path / "a.csv")])
    assert found.groupBy("block").count().count() > 20
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "ReusedExchange" in plan


def test_compressed_extracts(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('id,text\n1,"x\ny"\n2,z\n')
    for multi_line, want in ((True, {("1", "x\ny"), ("2", "z")}), (False, {("1", "x"), ('y"', None), ("2", "z")})):
        got = landing.land_delimited(spark, landing.DelimitedSource("t", f"{tmp_path}/a.csv.gz", multi_line=multi_line))
        assert got.columns[:2] == ["id", "text"]
        assert {(r.id, r.text) for r in got.collect()} == want


def test_header_that_spans_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"b\nc"\n1,"x\ny"\n')
    got = landing.land_delimited(spark, landing.DelimitedSource("t", f"{tmp_path}/a.csv", multi_line=True))
    assert got.columns[:2] == ["id", "b\nc"]
    assert [tuple(r)[:2] for r in got.collect()] == [("1", "x\ny")]


def test_sheet_rows_that_repeat_title_lines(spark, tmp_path):
    (tmp_path / "1.csv").write_text("S;A;1\nnota;;\nR;T;V\nS;A;2\nnota;;\n")
    (tmp_path / "2.csv").write_text('x;;\ny;;\nR;T;V\nS;A;1\nx;;\nR;T;V\n"two\nlines";B;3\n')
    got = landing.land_grid(spark, landing.GridSource("g", f"{tmp_path}/*.csv", header_line=3))
    assert {(r.R, r["T"], r.V) for r in got.collect()} == {
        ("S", "A", "2"), ("nota", None, None), ("S", "A", "1"), ("x", None, None), ("R", "T", "V"), ("two\nlines", "B", "3")}


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError):
        landing.land_delimited(spark, landing.DelimitedSource("t", f"{tmp_path}/a.csv", multi_line=True))
    (tmp_path / "b.csv").write_text("id,text")
    got = landing.land_delimited(spark, landing.DelimitedSource("t", f"{tmp_path}/*.csv", multi_line=True))
    assert got.columns[:2] == ["id", "text"] and got.count() == 0


def test_files_split_differently_are_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a\n1\n")
    none = records._splits(records._lines(spark, [str(tmp_path / "a.csv")], "UTF-8", "\\")).limit(0)
    monkeypatch.setattr(records, "_splits", lambda lines: none)
    with pytest.raises(Exception, match="split differently"):
        records.records(spark, [str(tmp_path / "a.csv")]).collect()
