"""SimHash near-duplicate groups by pigeonring filtering.

A 64-bit fingerprint is a ring of 16 segments of 4 bits. If two fingerprints differ in at most 3 bits, then some start
on the ring exists from which every chain of l segments differs in at most l * 3 / 16 bits: the first 5 segments not at
all, 10 in at most one bit, 15 in at most two. So the first 20 bits from each of 16 starts are equality keys, and pairs
that share a key pass the longer chains before the whole Hamming distance is taken.

Distinct fingerprints are the nodes, so copies cost nothing beyond their own fingerprint. A key with more than
``BUCKET`` fingerprints is refined by exact further bits (the next 20 bits hold at most one difference, hence one of
their halves none; then one of four parts of the bits that are left), down to 15 open bits, which at most 32,768
distinct fingerprints can share. Links are reduced to a forest inside each batch, so no group is emitted as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import offsets_and_bytes, slices, spaced_words, text_column
from ledgerloom.llm.components import components
from ledgerloom.llm.shared import written

WORDS = 3
SEED = 42
SEGMENTS = 16
SEGMENT_BITS = 4
DISTANCE = 3
#: Fingerprints of one key that are compared directly; more are refined by further key bits, not cut.
BUCKET = 512
#: Open bits at which refining ends.
OPEN_BITS = 15

_BLOCK = 1 << 15


def _hashes(offsets: np.ndarray, data: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and each text's first shingle (with the total at the end)."""
    out, starts, ends, first = spaced_words(offsets, data)
    count = np.diff(first)
    shingles = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    at = np.concatenate(([0], np.cumsum(shingles)))
    text = np.repeat(np.arange(len(count)), shingles)
    begin = first[:-1][text] + np.arange(at[-1]) - at[:-1][text]
    stop = begin + np.minimum(count, words)[text] - 1
    digest, body = xxhash.xxh64_intdigest, out.tobytes()
    spans = zip(starts[begin].tolist(), ends[stop].tolist(), strict=True)
    return np.fromiter((digest(body[s:e], SEED) for s, e in spans), np.uint64, int(at[-1])), at


def simhashes(offsets: np.ndarray, data: np.ndarray, words: int = WORDS) -> np.ndarray:
    """A fingerprint bit is 1 if it is set in over half of the text's shingle hashes."""
    hashes, at = _hashes(offsets, data, words)
    n = len(at) - 1
    ones = np.zeros((n, 64), np.int64)
    for low in range(0, len(hashes), _BLOCK):
        part = hashes[low : low + _BLOCK].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = np.searchsorted(at, [low, low + len(part) - 1], "right") - 1
        own = np.arange(first, last + 1)
        own = own[at[own + 1] > at[own]]
        ones[own] += np.add.reduceat(bits, np.maximum(at[own] - low, 0), axis=0, dtype=np.int32)
    over = 2 * ones > np.diff(at)[:, None]
    return np.packbits(over, axis=1, bitorder="little").reshape(-1).view("<u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, k, h, fingerprint as a signed long) of every whole text; a null, empty or blank text has fingerprint 0.

    k and h are hashes of id and text that tell rows apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                marks = simhashes(*offsets_and_bytes(text_column(batch, "text")), words)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(marks.view(np.int64))], names=["id", "k", "h", "fingerprint"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), *_row_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"id {kind}, k long, h long, fingerprint long")


def _row_keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    ident, text = F.col(id_col).cast("string"), F.col(text_col).cast("string")
    return F.xxhash64(ident, text).alias("k"), F.xxhash64(text, F.lit(1), ident).alias("h")


def _ring(start: int, bits: int) -> int:
    """A mask of ``bits`` bits from segment ``start`` on, around the ring."""
    return sum(1 << ((start * SEGMENT_BITS + k) % 64) for k in range(bits))


def _budget(chain: int) -> int:
    return chain * DISTANCE // SEGMENTS


_KEY_BITS = SEGMENT_BITS * max(n for n in range(1, SEGMENTS + 1) if _budget(n) == 0)
#: (bits from the start, most differences) at the longest chain of each budget; the rest follows from these.
_CHAINS = [
    (SEGMENT_BITS * max(n for n in range(1, SEGMENTS + 1) if _budget(n) == k), k) for k in range(1, DISTANCE + 1)
]


def _parts(bits: list[int], n: int) -> list[int]:
    return [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), n)]


def _levels() -> list[dict[int, tuple[int, int]]]:
    """For each level, path -> (start, mask of the bits that its key holds). A path is its parent's times 4, and more."""
    now = {s: (s, _ring(s, _KEY_BITS)) for s in range(SEGMENTS)}
    out = [now]
    while 64 - min(m.bit_count() for _, m in now.values()) > OPEN_BITS:
        after = {}
        for path, (start, mask) in now.items():
            first = len(out) == 1
            chain = [(start * SEGMENT_BITS + k) % 64 for k in range(_CHAINS[0][0] if first else 64)]
            free = [b for b in chain if not mask >> b & 1]
            for k, part in enumerate(_parts(free, _CHAINS[0][1] + 1 if first else DISTANCE + 1)):
                after[path * 4 + k] = (start, mask | part)
        out.append(now := after)
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches over the links a - b."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _links(level: int):
    """Links inside the keys of sorted (path, key, fingerprint) rows, as a forest for each batch."""

    def linked(path: np.ndarray, key: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = path // 4**level
        chains = [(np.array([_ring(s, bits) for s in range(SEGMENTS)], np.uint64), most) for bits, most in _CHAINS]
        new = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
        sizes = np.diff(np.concatenate(([0], new, [len(path)])))
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(path)) - 1
        rows, d, found = np.flatnonzero(left >= 1), 1, []
        while len(rows):
            differ, at = marks[rows] ^ marks[rows + d], rows
            for masks, most in chains:
                stay = np.bitwise_count(differ & masks[starts[at]]) <= most
                differ, at = differ[stay], at[stay]
            found.append((at, at + d))
            d += 1
            rows = rows[left[rows] >= d]
        if not found:
            return marks[:0], marks[:0]
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        root = _forest(len(path), a, b)
        moved = np.flatnonzero(root != np.arange(len(path)))
        return marks[moved], marks[root[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in (*batches, None):
            if batch is not None:
                now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
                held = [np.concatenate((h, x.view(h.dtype))) for h, x in zip(held, now, strict=True)]
                if not len(held[0]):
                    continue
                last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
                cut = int(last[-1]) + 1 if len(last) else 0
            else:
                cut = len(held[0])
            if cut:
                a, b = linked(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def links(marks: DataFrame) -> DataFrame:
    """(a, b) of distinct ``fingerprint`` values that connect exactly what links of at most 3 differing bits connect."""
    levels, found = _levels(), []
    f = F.col("fingerprint")
    keyed = marks.select(
        F.explode(F.array(*(F.struct(F.lit(p).cast("long").alias("path"), f.bitwiseAND(F.lit(_signed(m))).alias("key")) for p, (_, m) in levels[0].items()))).alias("k"), f
    ).select("k.path", "k.key", "fingerprint")
    for level, masks in enumerate(levels):
        if level:
            keyed = written(keyed.mapInArrow(_refined(masks), "path long, key long, fingerprint long"), "keyed")
        last = level == len(levels) - 1
        large = None if last else written(keyed.groupBy("path", "key").count().filter(F.col("count") > BUCKET).select("path", "key"), "large")
        small = keyed if last else keyed.join(large, ["path", "key"], "left_anti")
        found.append(
            small.repartition("path", "key").sortWithinPartitions("path", "key", "fingerprint")
            .mapInArrow(_links(level), "a long, b long")
        )
        if last or large.isEmpty():
            break
        keyed = keyed.join(large, ["path", "key"], "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _refined(masks: dict[int, tuple[int, int]]):
    """Rows of a large key under the longer keys of the next level."""
    children: dict[int, list[tuple[int, int]]] = {}
    for path, (_, mask) in masks.items():
        children.setdefault(path // 4, []).append((path, mask))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for path in np.unique(paths):
                own = marks[paths == path]
                for child, mask in children[int(path)]:
                    keys = own & np.int64(_signed(mask))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), child)), pa.array(keys), pa.array(own)], names=["path", "key", "fingerprint"])

    return run


def _classes(marks: DataFrame) -> DataFrame:
    """(fingerprint, root): which distinct fingerprints links connect."""
    nodes = written(marks.select("fingerprint").distinct(), "nodes")
    roots = components(links(nodes))
    return nodes.join(roots, nodes.fingerprint == roots.node, "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for every row; only the id and text columns are read.

    fingerprint is 16 hex digits; component_id is the smallest id that links of at most 3 differing bits reach, the own
    included (null ids are passed over, and null is the result where a group has no other). Null, empty and blank texts
    share fingerprint 0 and so one component, with texts whose fingerprint is near 0. Repeated rows give repeated rows.
    An empty table gives an empty result.
    """
    marks = written(fingerprints(docs, id_col, text_col), "fingerprints")
    least = marks.groupBy("fingerprint").agg(F.min("id").alias("least"))
    rooted = written(_classes(marks).join(least, "fingerprint"), "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fingerprint", "root").join(groups, "root").select("fingerprint", "component_id")
    return marks.select("id", "fingerprint").join(classes, "fingerprint").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id's (null last), once if rows repeat."""
    marks = written(fingerprints(docs, id_col, text_col), "fingerprints")
    one = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "k", "h")).alias("row")
    first = marks.groupBy("fingerprint").agg(one)
    chosen = _classes(marks).join(first, "fingerprint").groupBy("root").agg(F.min("row").alias("row")).select(
        F.col("row.k").alias("_k"), F.col("row.h").alias("_h")
    )
    k, h = _row_keys(id_col, text_col)
    kept = docs.withColumns({"_k": k, "_h": h}).join(chosen, ["_k", "_h"], "left_semi")
    return kept.dropDuplicates(["_k", "_h"]).select(*docs.columns)
