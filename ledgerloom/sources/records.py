"""Records of delimited files whose quoted fields may span lines, read by as many tasks as a file has splits.

Files are read line by line, so Spark splits them. Whether a line lies inside a quoted field follows from the parity of the
quotes before it: each split counts its lines with an odd number of quotes (one small row per split), a prefix sum over a
file's splits gives the parity at which each split begins, and a running sum within the split does the rest. A record cut by
the end of its split is put together from its pieces, which meet by the split in which the record begins; only records of
more than one line are grouped at all.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE, ESCAPE = '"', "\\"
#: The record that its split leaves open has this number.
OPEN = -1


def _odd_quotes(line: Column, escape: str) -> Column:
    """1 if a field's quotes open or close for good on this line; an escaped quote is none, a doubled one is two."""
    bare = line if escape == QUOTE else F.regexp_replace(line, "(?s)" + re.escape(escape) + ".", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(QUOTE), F.lit("")))) % 2


def _lines(spark: SparkSession, files: Sequence[str], encoding: str, escape: str) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(list(files))
    text = F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(
        text.alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
    ).withColumn("odd", _odd_quotes(F.col("text"), escape))


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: parity at its start and end, and the split in which a record open at its start begins."""
    counted = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    known = counted.withColumn("start", start).withColumn("end", (F.col("start") + F.col("odd")) % 2)
    # a record begins in a split that begins outside a field, or that leaves one and enters another
    begins = F.when((F.col("start") == 0) | (F.col("odd") >= 2), F.col("block"))
    known = known.withColumn("begins", begins).withColumn("opened", F.last("begins", ignorenulls=True).over(before))
    # one array, so that both uses below need the same columns and share one exchange of the lines
    return known.select("file", "block", F.array("start", "end", F.coalesce("opened", F.lit(0))).alias("split"))


def records(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8", escape: str = ESCAPE) -> DataFrame:
    """record, name (of its file), block (start of the split that it begins in) and line (there, from 1; of a record that
    goes on into another split, of its first line).

    Line breaks inside a record are kept as they are, but are line feeds in a record that ends with carriage return and line
    feed; the one at its end is cut, empty records are left out. The encoding must write line feeds and quotes as ASCII does. A compressed file is one split. Quotes inside a quoted field are escaped
    by ``escape``, or doubled where that is the quote itself; a quote that is never closed makes the rest of its file one
    record, and one inside an unquoted field counts like any other.
    """
    lines = _lines(spark, files, encoding, escape)
    splits = _splits(lines).select(F.col("file").alias("of"), F.col("block").alias("from"), "split")
    known = lines.join(splits, (F.col("file") == F.col("of")) & (F.col("block") == F.col("from")), "left")
    # files listed anew may be split anew: then the parities don't fit and the job must not go on
    known = known.withColumn("split", F.coalesce("split", F.raise_error(F.lit("a file was split differently")).cast("array<bigint>")))
    here = Window.partitionBy("file", "block").orderBy("at")
    upto, all_ = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = known.withColumn("after", (F.col("split")[0] + F.sum("odd").over(upto)) % 2).withColumn("line", F.row_number().over(here))
    placed = placed.withColumn("before", (F.col("after") + F.col("odd")) % 2)
    single = (F.col("before") == 0) & (F.col("after") == 0)
    whole = placed.filter(single).select("text", "name", "block", "line")
    numbered = placed.withColumn("number", F.sum(1 - F.col("before")).over(upto)).withColumn("last", F.sum(1 - F.col("before")).over(all_))
    begun = F.when(F.col("number") == 0, F.col("split")[2]).otherwise(F.col("block"))
    left_open = (F.col("number") == 0) | ((F.col("number") == F.col("last")) & (F.col("split")[1] == 1))
    pieces = numbered.filter(~single).groupBy("file", begun.alias("begun"), F.when(left_open, F.lit(OPEN)).otherwise(F.col("number")).alias("record"))
    joined = pieces.agg(F.sort_array(F.collect_list(F.struct("block", "line", "text"))).alias("lines"), F.first("name").alias("name"))
    spanning = joined.select(
        F.concat_ws("\n", F.transform("lines", lambda x: x["text"])).alias("text"), "name", F.col("lines")[0]["block"].alias("block"),
        F.col("lines")[0]["line"].alias("line"))
    both = whole.unionByName(spanning)
    unix = F.regexp_replace(F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    record = F.when(F.endswith("text", F.lit("\r")), unix).otherwise(F.col("text"))
    return both.select(record.alias("record"), "name", "block", "line").filter("record <> ''")


def fields(record: Column, names: Sequence[str], delimiter: str, escape: str = ESCAPE) -> Column:
    """The record's cells as texts in a struct, as Spark's CSV reader reads them."""
    quoted = [name.replace("`", "``") for name in names]
    return F.from_csv(record, ", ".join(f"`{name}` STRING" for name in quoted), {"sep": delimiter, "quote": QUOTE, "escape": escape})
