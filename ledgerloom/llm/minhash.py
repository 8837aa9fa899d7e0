"""Document fingerprints by one-permutation MinHash.

Each shingle of five words is hashed once; the hash's top bits choose one of ``BINS`` bins, which keeps its smallest
value. An empty bin copies a full one, tried in an order that is fixed for that bin and random between bins (optimal
densification). A fingerprint stores the low ``BITS`` bits of each bin's value, hashed once more with the bin's number,
so that copies of one value are independent. Two unequal values agree in these by chance with probability 2 ** -BITS,
and the likeness is corrected for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import mix64, offsets_and_bytes, slices, span_hashes, spaced_words, text_column
from ledgerloom.llm.shared import written

WORDS = 5
BINS = 256
BITS = 4


def _probes() -> np.ndarray:
    """For each bin, all bins in the order in which it looks for a full one."""
    own, other = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(BINS, dtype=np.uint64), indexing="ij")
    return np.argsort(mix64(own * np.uint64(BINS) + other + np.uint64(1)), axis=1, kind="stable")


def signatures(offsets: np.ndarray, data: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(low bits of every bin for every text, which texts have a shingle). Shorter texts are one shingle of all words."""
    n = len(offsets) - 1
    out, starts, ends, first = spaced_words(offsets, data)
    count = np.diff(first)
    hashes = span_hashes(out, starts, ends)
    shingles = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    at = np.concatenate(([0], np.cumsum(shingles)))
    text = np.repeat(np.arange(n), shingles)
    begin = first[:-1][text] + np.arange(at[-1]) - at[:-1][text]
    size = np.minimum(count, words)[text]
    mixed = np.full(int(at[-1]), 0x51, np.uint64)
    for k in range(words):
        inside = size > k
        mixed[inside] = mix64(mixed[inside] * np.uint64(0x9FB21C651E98DF25) + hashes[begin[inside] + k])
    keys = np.sort(text.astype(np.uint64) << np.uint64(40) | mixed >> np.uint64(24))
    cell = (keys >> np.uint64(32)).astype(np.int64)  # text and bin
    least = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    full = np.zeros(n * BINS, bool)
    full[cell[least]] = True
    values = np.zeros(n * BINS, np.uint64)
    values[cell[least]] = keys[least] & np.uint64(0xFFFFFFFF)
    some = count > 0
    open_cells = np.flatnonzero(~full & np.repeat(some, BINS))
    probes, trial = _probes(), 0
    while len(open_cells):
        source = open_cells // BINS * BINS + probes[open_cells % BINS, trial]
        found = full[source]
        values[open_cells[found]] = values[source[found]]
        open_cells, trial = open_cells[~found], trial + 1
    low = mix64(values.reshape(n, BINS) | np.arange(BINS, dtype=np.uint64) << np.uint64(32)) & np.uint64((1 << BITS) - 1)
    return low.astype(np.uint8), some


def packed(low: np.ndarray, some: np.ndarray) -> pa.Array:
    """Fingerprints as bytes, two bins in each; none for a text without words."""
    both = low[:, 0::2] << np.uint8(BITS) | low[:, 1::2]
    return pa.array([row.tobytes() if s else b"" for row, s in zip(both, some, strict=True)], pa.binary())


def _hex(name: str) -> Column:
    return F.lower(F.hex(name)).alias(name)


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the shingle sets; 1 for two texts without words, 0 for one."""
    chance = 2.0**-BITS
    agree = (a == b).mean(axis=1) if len(a) else np.zeros(0)
    estimate = np.clip((agree - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_some & b_some, estimate, (a_some == b_some).astype(float))


def _marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return signatures(*offsets_and_bytes(pa.array(texts, pa.large_string())))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text, null as empty; equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                marks = signatures(*offsets_and_bytes(text_column(batch, "text")))
                yield pa.RecordBatch.from_arrays([batch.column(0), packed(*marks)], names=["id", "fingerprint"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"id {kind}, fingerprint binary").select(F.col("id").alias(id_col), _hex("fingerprint"))


#: Code points of a text that tell rows of one id apart when they are dealt into ranges.
BEGINNING = 64


def _edited(text: str, following: str) -> str:
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def _compared(ids: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """The columns of ``neighbour_report`` for texts and those that follow them."""
    edited = [_edited(a, b) for a, b in zip(texts, following, strict=True)]
    n = len(texts)
    low, some = _marks(texts + edited + following)
    own, changed, after = (slice(k * n, (k + 1) * n) for k in range(3))
    columns = [
        ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).digest() for t in edited], pa.binary()),
        packed(low[own], some[own]), packed(low[changed], some[changed]),
        pa.array(likeness(low[own], some[own], low[changed], some[changed])),
        pa.array(likeness(low[own], some[own], low[after], some[after])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def neighbour_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Rows go by descending id, then by text; the last is followed by the first, a single row by itself. A text's edited
    form ends in the next text's first code points instead of its own last third. Rows are range-partitioned by id and the
    beginning of the text, so that the rows of a repeated or null id are spread too, and a partition's last text meets the next partition's first one by a join of those texts alone. Null texts count as
    empty, null ids come last. Very long texts are hashed whole, a slice of a few megabytes of rows at a time; an empty
    table has no rows; other columns are not read.
    """
    fields = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        names = ["id", *(f.split()[0] for f in fields.split(", ")), "part", "edge", "text"]

        def edge(row: pa.RecordBatch, name: str) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([row.column(0), *empty, pa.array([part], pa.int32()), pa.array([name]), text_column(row, "text").cast(pa.string())], names=names)

        for whole in batches:
            for batch in slices(whole, "text"):
                if last is None:
                    yield edge(batch.slice(0, 1), "first")
                    joined = batch
                else:
                    joined = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
                last = joined.slice(joined.num_rows - 1)
                n = joined.num_rows - 1
                if n:
                    texts = text_column(joined, "text").to_pylist()
                    done = _compared(joined.column(0).slice(0, n), texts[:-1], texts[1:])
                    yield pa.RecordBatch.from_arrays([*done.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names)
        if last is not None:
            yield edge(last, "last")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in slices(batch, "text"):
                yield _compared(row.column(0), text_column(row, "text").to_pylist(), text_column(row, "after").to_pylist())

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    # texts in order have beginnings in order, and the sample of the ranges need not hold whole texts
    ordered = picked.repartitionByRange(order[0], F.substring("text", 1, BEGINNING).asc_nulls_first()).sortWithinPartitions(*order)
    rows = written(ordered.mapInArrow(run, f"id {kind}, {fields}, part int, edge string, text string"), "compared")
    firsts, lasts = (rows.filter(F.col("edge") == e) for e in ("first", "last"))
    parts = sorted(r.part for r in firsts.select("part").collect())  # one number a partition
    following = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, following int")
    ends = (
        lasts.select("id", "text", "part").join(following, "part")
        .join(firsts.select(F.col("part").alias("following"), F.col("text").alias("after")), "following").select("id", "text", "after")
    )
    whole = rows.filter("edge is null").drop("part", "edge", "text").unionByName(ends.mapInArrow(finish, f"id {kind}, {fields}"))
    return whole.select(
        F.col("id").alias(id_col), "n_chars", _hex("edited_sha256"), _hex("fingerprint"), _hex("edited_fingerprint"), "near_edited", "near_next"
    )
