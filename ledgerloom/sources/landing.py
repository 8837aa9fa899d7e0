"""Land files as all-text tables with lineage columns; nothing is cleaned here."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.fixed_values import FORBIDDEN_NAME_CHARACTERS
from ledgerloom.functions.text import strip_space
from ledgerloom.sources.records import ESCAPE, QUOTE, fields, records

#: Files whose first lines are read at the same time.
READERS = 32
BOM = "﻿"


@dataclass(frozen=True)
class DelimitedSource:
    """One delimited extract. ``path`` may be a file, a folder or a glob of many files.

    ``multi_line`` lets a quoted field span lines. Files are split either way, but lines are then shuffled once to find
    where records begin: leave the option off when no field holds a line break. ``escape`` stands before a quote inside a
    quoted field; give the quote itself where quotes are doubled.
    """

    table: str
    path: str
    delimiter: str = ","
    encoding: str = "UTF-8"
    multi_line: bool = False
    source_name: str | None = None
    escape: str = ESCAPE


@dataclass(frozen=True)
class GridSource:
    """One sheet exported as delimited text, its real header on line ``header_line`` (1-based)."""

    table: str
    path: str
    header_line: int = 4
    delimiter: str = ";"
    encoding: str = "UTF-8"
    sheet: str | None = None
    source_name: str | None = None
    escape: str = ESCAPE


@dataclass(frozen=True)
class TextSource:
    """Free text, one row per non-blank line."""

    table: str
    path: str
    column: str = "texto_premissa"
    source_name: str | None = None


def sanitize_name(name: str) -> str:
    """Trim, then replace each character that a table format refuses by ``_``."""
    return str(name).strip().translate({ord(ch): "_" for ch in FORBIDDEN_NAME_CHARACTERS})


def unique_names(names: Sequence[str]) -> list[str]:
    """Blank headers by their place (``_c0``, ``_c1``), repeated ones with a number behind."""
    seen: dict[str, int] = {}
    out = []
    for place, name in enumerate(names):
        name = name or f"_c{place}"
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
        out.append(name if seen[name.lower()] == 1 else f"{name}_{seen[name.lower()]}")
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([sanitize_name(name) for name in df.columns]))


def with_lineage(df: DataFrame, source_name: Column, sheet: str | None = None) -> DataFrame:
    tags = {"_source_file": source_name}
    if sheet is not None:
        tags["_source_sheet"] = F.lit(sheet)
    return df.withColumns(tags | {"_ingested_at": F.current_timestamp()})


def _file_name(declared: str | None) -> Column:
    """The declared name, else that of the file that the row came from."""
    return F.col("_metadata.file_name") if declared is None else F.lit(declared)


def _first_lines(spark: SparkSession, path: str, encoding: str, n: int, spanning: bool = False) -> dict[str, list[str]]:
    """The first ``n`` lines of each file, decompressed; only these come to the driver.

    With ``spanning`` the last one goes on as long as a quoted cell is open.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    listed = [row.path for row in spark.read.format("binaryFile").load(path).select("path").orderBy("path").collect()]

    def read(name: str) -> list[str]:
        file = jvm.org.apache.hadoop.fs.Path(name)
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding)
        reader, lines = jvm.java.io.BufferedReader(text), []
        try:
            while len(lines) < n and (line := reader.readLine()) is not None:
                lines.append(line)
            while spanning and lines and lines[-1].count(QUOTE) % 2 and (line := reader.readLine()) is not None:
                lines[-1] += "\n" + line
        finally:
            reader.close()
        return [lines[0].lstrip(BOM), *lines[1:]] if lines else []

    with ThreadPoolExecutor(READERS) as pool:
        return {name: lines for name, lines in zip(listed, pool.map(read, listed)) if lines}


def _by_name(parts: list[DataFrame], path: str) -> DataFrame:
    """Files with one set of columns, whatever their order."""
    for part in parts[1:]:
        if sorted(part.columns) != sorted(parts[0].columns):
            raise ValueError(f"{path}: files differ in columns: {sorted(parts[0].columns)} and {sorted(part.columns)}")
    return reduce(DataFrame.unionByName, parts)


def _cells(line: str, delimiter: str) -> list[str]:
    return next(csv.reader(line.splitlines(keepends=True), delimiter=delimiter), [])


def _land_records(spark: SparkSession, source: DelimitedSource | GridSource, files: list[str], names: list[str], header_line: int) -> DataFrame:
    """The records below the header line as texts, with lineage; lines up to it are skipped by their place in the file."""
    found = records(spark, files, source.encoding, source.escape).filter((F.col("block") > 0) | (F.col("line") > header_line))
    name = F.col("name") if source.source_name is None else F.lit(source.source_name)
    cells = found.select(fields(F.col("record"), names, source.delimiter, source.escape).alias("cells"), name.alias("source"))
    landed = cells.select(*[F.col(f"cells.`{n}`") for n in names], "source")
    return with_lineage(landed, F.col("source"), getattr(source, "sheet", None)).drop("source")


def land_delimited(spark: SparkSession, source: DelimitedSource) -> DataFrame:
    """All columns as text, by name: files whose headers differ in order are read apart, other names are an error.

    ``_source_file`` is the declared name, else the name of each row's file. Files may be compressed.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, lines in _first_lines(spark, source.path, source.encoding, 1, source.multi_line).items():
        groups.setdefault(tuple(_cells(lines[0], source.delimiter)), []).append(file)
    if not groups:
        raise ValueError(f"{source.path} has no line")
    parts = []
    for header, files in groups.items():
        names = unique_names(header)
        if source.multi_line:
            parts.append(_land_records(spark, source, files, names, 1))
            continue
        raw = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(
            files, header=True, sep=source.delimiter, encoding=source.encoding, escape=source.escape)
        parts.append(with_lineage(raw.select("*", "_metadata"), _file_name(source.source_name)).drop("_metadata"))
    return _by_name(parts, source.path)


def land_grid(spark: SparkSession, source: GridSource) -> DataFrame:
    """Rows below the header line, totals row included; rows without any value are dropped.

    A sheet is delimited text, in which a quoted cell may span lines. What stands above the header is skipped by its place
    in the file, whatever it says. Sheets whose headers differ in order are read apart.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, lines in _first_lines(spark, source.path, source.encoding, source.header_line, True).items():
        if len(lines) < source.header_line:
            raise ValueError(f"{file} has no line {source.header_line}")
        groups.setdefault(tuple(_cells(lines[-1], source.delimiter)), []).append(file)
    if not groups:
        raise ValueError(f"{source.path} has no line {source.header_line}")
    parts = []
    for header, files in groups.items():
        names = unique_names([sanitize_name(name) for name in header])
        kept = _land_records(spark, source, files, names, source.header_line)
        blank_as_null = kept.withColumns({n: F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names})
        parts.append(blank_as_null.na.drop(how="all", subset=names))
    return _by_name(parts, source.path)


def land_text(spark: SparkSession, source: TextSource) -> DataFrame:
    lines = spark.read.text(source.path).select(F.col("value").alias(source.column), "_metadata")
    kept = lines.filter(strip_space(F.col(source.column)) != "")
    return with_lineage(kept, _file_name(source.source_name)).drop("_metadata")


def land(spark: SparkSession, sources: Sequence) -> dict[str, DataFrame]:
    """Land every source of a list of specs, by target table."""
    by_kind = {DelimitedSource: land_delimited, GridSource: land_grid, TextSource: land_text}
    return {source.table: by_kind[type(source)](spark, source) for source in sources}
