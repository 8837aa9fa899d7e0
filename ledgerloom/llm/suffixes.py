"""Repeated byte strings across documents, from suffixes sorted column by column.

Every window of ``LENGTH`` bytes has an anchor: its k-gram with the smallest hash, the leftmost of equals. Equal windows
have equal anchors at the same place, so they can be found among segments (runs of windows with one anchor) that share an
anchor, and these stand aligned, column under column.

Inside an anchor's collection, construction goes column by column from the right: each round puts the next symbol in front
of every segment's suffix, sorts the suffixes of this column stably by that symbol (the order of the column before, which
is the collection's transform restricted to the column, settles the rest), and updates the common prefixes: neighbours
with one symbol share one more than the least common prefix between their places in the round before. A window is repeated
if its suffix shares ``LENGTH`` symbols with a neighbour. Only one column's order is held; the segments come from the sorted
shuffle files, block after block.

What is counted before any byte moves: an anchor that occurs once has no repeated window; if all segments of an anchor are
equal, all their windows are repeated. Only distinct segments of the other anchors are sent. Segments of a collection of
more than ``COLLECTION`` are not sorted in one task: their windows are grouped by place and hash, wherever they lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import INVERSE, mix64, offsets_and_bytes, powers, prefix_sums, slices, substring_hashes
from ledgerloom.llm.shared import widened, written

LENGTH = 200
ANCHOR = 48
#: Segments of one anchor that one task sorts; the windows of more are grouped by hash.
COLLECTION = 20_000
_BLOCK_ROWS = 20_000
_SLICE = 1 << 20
_PLACE = np.uint64((1 << 26) - 1)
_KEYS = "anchor long, segment long"


def segments(offsets: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, segment hash, start, end, anchor's place in it) of every segment; start and end in ``data``."""
    width = length - ANCHOR + 1
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums, unshift = prefix_sums(data), powers(INVERSE, len(data))
    at = np.arange(len(data) - ANCHOR + 1)
    grams = mix64(substring_hashes(sums, at, at + ANCHOR, unshift))
    least, reach = (grams & ~_PLACE) | at.astype(np.uint64), 1
    while reach * 2 <= width:
        least, reach = np.minimum(least[: len(least) - reach], least[reach:]), reach * 2
    least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    anchor = (least & _PLACE).astype(np.int64)  # of the window at each place
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    place = np.flatnonzero(np.arange(len(anchor)) + length <= offsets[1:][text])
    new = np.ones(len(place), bool)
    new[1:] = (anchor[place[1:]] != anchor[place[:-1]]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    start = place[first]
    end = place[np.append(first[1:], len(place)) - 1] + length if len(first) else start
    own = anchor[start]
    # the segment's hash tells its bytes, its length and where the anchor stands
    whole = mix64(substring_hashes(sums, start, end, unshift) + (own - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + (end - start).astype(np.uint64))
    return text[start], grams[own], whole, start, end, own - start


def _chunks(whole: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Rows of the binary column ``text`` with offsets and bytes; a text over 2 ** 25 bytes in overlapping parts."""
    for batch in slices(whole, "text", _SLICE):
        column = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
        offsets, data = offsets_and_bytes(column)
        if len(data) <= 1 << 25:
            yield batch, offsets, data, 0
        else:
            for low in range(0, len(data), 1 << 25):
                part = data[low : low + (1 << 25) + LENGTH - 1]
                yield batch, np.array([0, len(part)]), part, low


def _cut(length: int, with_place: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, offsets, data, shift in _chunks(whole):
                text, anchor, segment, start, end, _ = segments(offsets, data, length)
                columns = {"anchor": anchor.view(np.int64), "segment": segment.view(np.int64)}
                if with_place:
                    r1, r2 = (batch.column(batch.schema.get_field_index(c)).to_numpy()[text] for c in ("r1", "r2"))
                    columns |= {"r1": r1, "r2": r2, "start": (start - offsets[text] + shift).astype(np.int32), "size": (end - start).astype(np.int32)}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return run


def _fetch(length: int):
    """The bytes of the wanted segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, offsets, data, _ in _chunks(whole):
                text, anchor, segment, start, end, place = segments(offsets, data, length)
                wanted = batch.column(batch.schema.get_field_index("wanted"))
                counts, flat = wanted.value_lengths().to_numpy(), wanted.flatten().to_numpy().view(np.uint64)
                asked = np.repeat(np.arange(len(counts)), counts)
                # both a wanted segment and its text are matched
                hit = np.isin(mix64(segment) ^ text.astype(np.uint64), mix64(flat) ^ asked.astype(np.uint64))
                _, once = np.unique(np.stack([anchor[hit], segment[hit], text[hit].astype(np.uint64)]), axis=1, return_index=True)
                chosen = np.flatnonzero(hit)[np.sort(once)]
                body = data.tobytes()
                bytes_ = [body[a:b] for a, b in zip(start[chosen].tolist(), end[chosen].tolist(), strict=True)]
                for low in range(0, len(chosen), 1 << 14):
                    part = chosen[low : low + (1 << 14)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[part].view(np.int64)), pa.array(segment[part].view(np.int64)), pa.array(place[part].astype(np.int32)), pa.array(bytes_[low : low + (1 << 14)], pa.binary())],
                        names=["anchor", "segment", "place", "text"],
                    )

    return run


def _windows(length: int):
    """(anchor, segment, column, start, window) of every window of fetched segments; its column counts from the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                offsets, data = offsets_and_bytes(batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()))
                sums, unshift = prefix_sums(data), powers(INVERSE, len(data))
                each = np.diff(offsets) - length + 1
                row = np.repeat(np.arange(len(each)), each)
                start = np.arange(len(row)) - (np.cumsum(each) - each)[row]
                low = offsets[:-1][row] + start
                column = start - batch.column(batch.schema.get_field_index("place")).to_numpy()[row]
                keys = [batch.column(batch.schema.get_field_index(c)).to_numpy()[row] for c in ("anchor", "segment")]
                window = substring_hashes(sums, low, low + length, unshift).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, keys), pa.array(column.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(window)],
                    names=["anchor", "segment", "column", "start", "window"],
                )

    return run


def _crowded_spans(fetched: DataFrame, length: int) -> DataFrame:
    """(anchor, segment, low, high) of what windows that another segment holds cover, for collections of any size.

    Equal windows lie at the same place from the anchor. All windows of a segment hold its anchor, so repeated ones
    overlap and cover one range.
    """
    windows = written(fetched.mapInArrow(_windows(length), f"{_KEYS}, column int, start int, window long"), "windows")
    key = ["anchor", "column", "window"]
    shared = windows.groupBy(*key).agg(F.min("segment").alias("a"), F.max("segment").alias("b")).filter("a <> b").select(*key)
    return windows.join(shared, key, "left_semi").groupBy("anchor", "segment").agg(
        F.min("start").alias("low"), (F.max("start") + length).cast("int").alias("high")
    )


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low:high]) for non-empty ranges."""
    if not len(low):
        return np.zeros(0, values.dtype)
    out, size = np.empty(len(low), values.dtype), high - low
    table, reach = values, 1
    while True:
        now = (size >= reach) & (size < 2 * reach)
        out[now] = np.minimum(table[low[now]], table[high[now] - reach])
        if not (size >= 2 * reach).any():
            return out
        table, reach = np.minimum(table[: len(table) - reach], table[reach:]), 2 * reach


def repeated_windows(collection: np.ndarray, rows: list[bytes], place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window start in it) of windows that another row of the same collection holds; rows are distinct.

    ``collection`` numbers each row's collection, ``place`` is where the shared anchor stands in the row.
    """
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    right = sizes - place  # columns from the anchor to the row's end
    begin = np.cumsum(sizes) - sizes
    body = np.frombuffer(b"".join(rows), np.uint8)
    by_end = np.argsort(-right, kind="stable")
    ends = -right[by_end]
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int32)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for column in range(int(right.max(initial=0)) - 1, -int(place.max(initial=0)) - 1, -1):
        fresh = by_end[np.searchsorted(ends, -column - 1, "left") : np.searchsorted(ends, -column - 1, "right")]
        before = np.concatenate((fresh, order))
        shared = np.concatenate((np.zeros(len(fresh), np.int32), common))
        live = np.flatnonzero(column >= -place[before])
        row = before[live]
        key = collection[row] << 8 | body[begin[row] + place[row] + column]
        at = np.argsort(key, kind="stable")
        order, key, was = row[at], key[at], live[at]
        common = np.zeros(len(order), np.int32)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        common[same] = 1 + _least_between(shared, was[same - 1] + 1, was[same] + 1)
        near = common.copy()
        near[:-1] = np.maximum(near[:-1], common[1:])
        hit = order[near >= length]
        found.append((hit, place[hit] + column))
    row, start = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    return row, start


def _merged(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the ranges [low, high) of each owner; ranges that touch are one."""
    order = np.lexsort((low, owner))
    owner, low, high = owner[order], low[order], high[order]
    if not len(owner):
        return owner, low, high
    span = int(high.max()) + 2
    reach = np.maximum.accumulate(high + owner * span)
    new = np.concatenate(([True], low[1:] + owner[1:] * span > reach[:-1]))
    new[1:] |= owner[1:] != owner[:-1]
    first = np.flatnonzero(new)
    return owner[first], low[first], reach[np.append(first[1:], len(owner)) - 1] - owner[first] * span


def _construct(length: int):
    def work(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        anchor, segment = table.column("anchor").to_numpy(), table.column("segment").to_numpy()
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])))
        table, anchor, segment = table.filter(pa.array(new)), anchor[new], segment[new]
        collection = np.cumsum(np.concatenate(([0], anchor[1:] != anchor[:-1]))).astype(np.int64)
        row, start = repeated_windows(collection, table.column("text").to_pylist(), table.column("place").to_numpy().astype(np.int64), length)
        row, low, high = _merged(row, start, start + length)
        return pa.RecordBatch.from_arrays([pa.array(anchor[row]), pa.array(segment[row]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["anchor", "segment", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows >= _BLOCK_ROWS:
                anchors = held.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))
                if cut:
                    yield work(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield work(held)

    return run


def _spans(texts: DataFrame, length: int) -> DataFrame:
    """(r1, r2, low, high): byte ranges of repeated windows of ``texts(r1, r2, text)``, not merged over segments."""
    counted = texts.mapInArrow(_cut(length, False), _KEYS).groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("segment").alias("a"), F.max("segment").alias("b")
    )
    repeated = written(counted.filter("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("mixed")), "anchors")
    placed = texts.mapInArrow(_cut(length, True), f"{_KEYS}, r1 long, r2 long, start int, size int")
    held = written(placed.join(repeated, "anchor"), "segments")
    same = held.filter("not mixed").select("r1", "r2", F.col("start").alias("low"), F.expr("start + size").alias("high"))

    mixed = held.filter("mixed")
    distinct = written(mixed.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.min(F.struct("r1", "r2")).alias("row"), F.max("size").alias("size")), "distinct")
    # each segment comes from one row only, so a row's list holds no more than its own segments
    wanted = distinct.groupBy("row.r1", "row.r2").agg(F.collect_list("segment").alias("wanted"))
    fetched = texts.join(wanted, ["r1", "r2"]).select("text", "wanted").mapInArrow(_fetch(length), f"{_KEYS}, place int, text binary")
    ranges = f"{_KEYS}, low int, high int"
    crowded = written(distinct.groupBy("anchor").count().filter(F.col("count") > COLLECTION).select("anchor"), "crowded")
    split = not crowded.isEmpty()
    if split:
        fetched = written(fetched, "fetched")
        windowed = _crowded_spans(fetched.join(crowded, "anchor", "left_semi"), length)
        fetched = fetched.join(crowded, "anchor", "left_anti")
    found = fetched.repartition("anchor").sortWithinPartitions("anchor", "segment").mapInArrow(_construct(length), ranges)
    if split:
        found = found.unionByName(windowed)
    once = distinct.filter("n = 1").select("anchor", "segment").join(found, ["anchor", "segment"])
    several = distinct.filter("n > 1").select("anchor", "segment", F.lit(0).alias("low"), F.col("size").alias("high"))
    judged = once.unionByName(several)
    partly = mixed.join(judged, ["anchor", "segment"]).select("r1", "r2", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    return same.unionByName(partly)


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with _bytes (the text as UTF-8, null as empty) and _spans: ranges that repeated strings of ``length``
    bytes cover, unsorted and overlapping; null where there is none.

    Rows are told apart by hashes of id and text. Rows that agree in both are two documents and repeat each other.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    keyed = docs.withColumn("_bytes", body).withColumns({"_r1": F.xxhash64(F.col(id_col).cast("string"), "_bytes"), "_r2": F.xxhash64("_bytes", F.lit(7), F.col(id_col).cast("string"))})
    texts = keyed.filter(F.length("_bytes") >= length).select(F.col("_r1").alias("r1"), F.col("_r2").alias("r2"), F.col("_bytes").alias("text"))
    spans = _spans(texts, length).groupBy(F.col("r1").alias("_r1"), F.col("r2").alias("_r2")).agg(F.collect_set(F.struct("low", "high")).alias("_spans"))
    return keyed.join(spans, ["_r1", "_r2"], "left").drop("_r1", "_r2")


def _kept(whole: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, int, int]]]]:
    """Slices with, for each row, the bytes that stay, how many went and in how many runs."""
    for batch in slices(whole, "_bytes"):
        out = []
        spans = batch.column(batch.schema.get_field_index("_spans"))
        for body, ranges in zip(batch.column(batch.schema.get_field_index("_bytes")), spans, strict=True):
            body = body.as_py()
            if not ranges.is_valid:
                out.append((body, 0, 0))
                continue
            low, high = (ranges.values.field(k).to_numpy().astype(np.int64) for k in range(2))
            _, low, high = _merged(np.zeros(len(low), np.int64), low, high)
            rest = [body[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(body)], strict=True)]
            out.append((b"".join(rest), int((high - low).sum()), len(low)))
        yield batch, out


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row: what goes if repeated bytes are removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, kept in _kept(whole):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(k) + n for k, n, _ in kept], pa.int64()), pa.array([n for _, n, _ in kept], pa.int64()),
                     pa.array([s for _, _, s in kept], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in kept], pa.string())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    marked = with_repeats(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", length)
    got = marked.select("id", "_bytes", "_spans").mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return got.withColumnRenamed("id", id_col)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated bytes cut from the text; a character that a cut runs through goes whole. Null becomes empty.

    A column _removed counts the bytes that went, in place of an own one. All other columns pass, whatever their names;
    texts of any length are cut whole, an empty table stays empty, and a repeated row is another document.
    """
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    columns = docs.drop("_removed").columns
    others = F.struct(*[F.col(quoted(c)) for c in columns if c != text_col])
    rows = docs.select(others.alias("row"), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    marked = with_repeats(rows, "id", "text", length).select("row", "_bytes", "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, kept in _kept(whole):
                texts = pa.array([k.decode(errors="ignore") if n else k.decode() for k, n, _ in kept], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), texts, pa.array([n for _, n, _ in kept], pa.int64())], names=["row", "text", "_removed"])

    cut = marked.mapInArrow(run, widened(marked.select("row"), text="string", _removed="long"))
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in columns], "_removed")
