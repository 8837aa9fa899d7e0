"""Hard negatives by a secondary-sort shuffle.

Anchors meet all rows in blocks. Pair scores are packed into keys of (anchor, descending score, id), dealt by anchor and
sorted within partitions; one pass over an anchor's keys opens a window at each positive and emits the next negatives, so
it holds the open windows only. A block sends what can be in a result and nothing else: of an anchor's label its first few
rows, then, when the positives are known, the first few other rows below each of them. Both are exact, not caps: the first
few rows of all are among the first few of their blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import written

#: Bytes of a block's vectors, and of the scores that a task works on at a time.
BLOCK_BYTES = 32 << 20
#: Rows that are worth a block of their own where the cluster has tasks to spare.
LEAST_ROWS = 1024
#: Scores are held within these bounds, so that a packed score has room for one more bit.
MOST = 1 << 61
_SIGN = np.uint64(1 << 63)
KEY_BYTES = 24


def pack(anchor: np.ndarray, score: np.ndarray, ident: np.ndarray, positive: np.ndarray | bool) -> pa.Array:
    """Keys whose byte order is (anchor, descending score, positives first, id)."""
    out = np.empty((len(anchor), 3), ">u8")
    out[:, 0] = anchor.astype(np.int64).view(np.uint64) ^ _SIGN
    out[:, 1] = ~((2 * score.astype(np.int64) + np.asarray(positive, np.int64)).view(np.uint64) ^ _SIGN)
    out[:, 2] = ident.astype(np.int64).view(np.uint64) ^ _SIGN
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY_BYTES), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def unpack(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, score, id, positive) of packed keys."""
    raw = np.frombuffer(b"".join(keys.to_pylist()), ">u8").reshape(-1, 3).astype(np.uint64)
    both = ((~raw[:, 1]) ^ _SIGN).view(np.int64)
    return (raw[:, 0] ^ _SIGN).view(np.int64), both >> 1, (raw[:, 2] ^ _SIGN).view(np.int64), (both & 1).astype(bool)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, the shorter ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, held within +-MOST."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    fa, fb = a.astype(float), b.astype(float)
    if np.abs(fa).max() * np.abs(fb).max() * a.shape[1] < 2.0**53:  # every partial sum is exact
        return (fa @ fb.T).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    wide = b.astype(object)
    for k, row in enumerate(a.astype(object)):
        out[k] = [max(-MOST, min(MOST, int(x))) for x in wide @ row]
    return out


class Block:
    """A block's rows in order of id."""

    def __init__(self, parts: list[pa.RecordBatch], width: int) -> None:
        get = lambda name: [p.column(p.schema.get_field_index(name)) for p in parts]
        self.ids = np.concatenate([c.to_numpy() for c in get("id")])
        self.rows = np.concatenate([c.to_numpy() for c in get("row")])
        self.vectors = np.concatenate([_matrix(c, width) for c in get("vector")])
        labels = [x for c in get("label") for x in c.to_pylist()]
        self.code = {label: k for k, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.code[x] for x in labels], np.int64)
        order = np.argsort(self.labels, kind="stable")
        ends = np.searchsorted(self.labels[order], np.arange(len(self.code) + 1))
        self.of_label = {label: order[ends[k] : ends[k + 1]] for label, k in self.code.items()}

    def positives(self, row: int, label: str, scores: np.ndarray, most: int) -> np.ndarray:
        """Places of the first rows of the label, the anchor's own row left out."""
        among = self.of_label.get(label, np.zeros(0, np.int64))
        among = among[self.rows[among] != row]
        own = scores[among]
        if len(among) > most:
            near = own >= np.partition(own, len(own) - most)[len(own) - most]
            among, own = among[near], own[near]
        return among[np.argsort(-own, kind="stable")[:most]]

    def negatives(self, label: str, scores: np.ndarray, windows: list[tuple[int, int]], most: int) -> np.ndarray:
        """Places of the first rows of other labels in each window (least and largest score)."""
        inside = (scores >= min(low for low, _ in windows)) & (scores <= max(high for _, high in windows))
        among = np.flatnonzero(inside & (self.labels != self.code.get(label, -1)))
        among = among[np.argsort(-scores[among], kind="stable")]
        falling = -scores[among]
        taken = [np.arange(at := np.searchsorted(falling, -high, "left"), min(at + most, np.searchsorted(falling, -low, "right"))) for low, high in windows]
        return among[np.unique(np.concatenate(taken)).astype(np.int64)]


def _meetings(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[Block, pa.RecordBatch, np.ndarray]]:
    """(block, anchors, their scores with the block's rows) from rows sorted by (block, anchor or not)."""
    number, parts, block = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, kinds = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("block", "kind"))
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            part = batch.slice(low, high - low)
            if blocks[low] != number:
                number, parts, block = blocks[low], [], None
            if kinds[low] == 0:
                parts.append(part)
            elif parts or block:
                if block is None:
                    block, parts = Block(parts, width), []
                step = max(1, BLOCK_BYTES // (8 * len(block.ids)))
                for at in range(0, part.num_rows, step):
                    anchors = part.slice(at, step)
                    vectors = _matrix(anchors.column(anchors.schema.get_field_index("vector")), width)
                    yield block, anchors, products(vectors, block.vectors)


def _in_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, extra: list[str]) -> DataFrame:
    """Every row once, in its block, then every anchor in every block: a stated query set against all rows."""
    own = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "row", "label", "vector", *[F.lit(None).cast(rows.sparkSession.createDataFrame([], anchors.schema).schema[c].dataType).alias(c) for c in extra])
    asking = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "row", "label", "vector", *extra)
    both = own.unionByName(asking)
    return both.repartitionById(blocks, "block").sortWithinPartitions("block", "kind", "id", "row")


def _sorted_keys(keys: DataFrame) -> DataFrame:
    """The secondary sort: dealt by the anchor in the key, sorted by the whole key."""
    return keys.repartition(F.expr("substring(key, 1, 8)")).sortWithinPartitions("key")


def _by_anchor(step: Callable[[int, Iterator[tuple[int, int, bool]]], Iterator[tuple]], schema: pa.Schema):
    """A function for mapInArrow: ``step`` gets each anchor with the stream of its (score, id, positive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, take = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            for anchor, score, ident, positive in zip(*(x.tolist() for x in unpack(batch.column(0)))):
                if anchor != now:
                    now, take = anchor, step(anchor)
                out.extend(take(score, ident, positive))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)
            out = []

    return run


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 5, least_percent: int = 80) -> DataFrame:
    """Hard negatives of every row for which ``is_anchor`` (over the columns of ``rows``) holds.

    A score is the inner product of components floor(scale * x). An anchor's positives are its first other rows of the same
    label by (descending score, id); a positive's negatives are the first rows of other labels whose score is between
    ``least_percent`` of the positive's and the positive's. Returns anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score.

    Rows with a null id, label, vector or component, or a component that is not finite take no part; an empty vector is all
    zeros, as are the missing components of a short one. Repeated ids are rows of their own, also as anchors and as each
    other's positives. Ties go to the smaller id. Components beyond a long are held at its bounds, scores at +-2**61. A
    positive below zero has no window. An empty table, or one without anchors, gives no rows. Other columns of ``rows``,
    whatever their names, are not read.
    """
    spark = rows.sparkSession
    x = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & F.coalesce(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    prepared = written(rows.filter(usable).select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(label_col).cast("string").alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")), "vectors")
    count, width = prepared.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 0, 1)
    spare = min(-(-count // LEAST_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = max(1, -(-count * width * 8 // BLOCK_BYTES), spare)
    plain, anchors = prepared.drop("is_anchor"), prepared.filter("is_anchor").drop("is_anchor")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, asking, scores in _meetings(batches, width):
            own, label = (asking.column(asking.schema.get_field_index(n)).to_pylist() for n in ("row", "label"))
            found = [block.positives(r, l, s, positives) for r, l, s in zip(own, label, scores)]
            who = np.repeat(np.arange(len(own)), [len(f) for f in found])
            at = np.concatenate(found).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pack(np.array(own, np.int64)[who], scores[who, at], block.ids[at], True)], names=["key"])

    def first(anchor: int):
        left = positives

        def take(score: int, ident: int, positive: bool) -> Iterator[tuple]:
            nonlocal left
            if left:
                left -= 1
                yield anchor, score, ident

        return take

    candidates = _in_blocks(plain, anchors, blocks, []).mapInArrow(near, "key binary")
    schema = pa.schema([("row", pa.int64()), ("score", pa.int64()), ("positive", pa.int64())])
    chosen = written(_sorted_keys(candidates).mapInArrow(_by_anchor(first, schema), "row long, score long, positive long"), "positives")
    asked = anchors.join(chosen.groupBy("row").agg(F.collect_set("score").alias("scores")), "row")  # at most `positives` of each

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, asking, scores in _meetings(batches, width):
            own, label, tops = (asking.column(asking.schema.get_field_index(n)).to_pylist() for n in ("row", "label", "scores"))
            found = [block.negatives(l, s, [(-(-least_percent * t // 100), t) for t in top], negatives) for l, s, top in zip(label, scores, tops)]
            who = np.repeat(np.arange(len(own)), [len(f) for f in found])
            at = np.concatenate(found).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pack(np.array(own, np.int64)[who], scores[who, at], block.ids[at], False)], names=["key"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, score, ident = (b.column(k).to_numpy() for k in range(3))
            yield pa.RecordBatch.from_arrays([pack(row, score, ident, True)], names=["key"])

    def windows(anchor: int):
        open_: list[list[int]] = []  # [positive's score, its id, negatives so far]

        def take(score: int, ident: int, positive: bool) -> Iterator[tuple]:
            if positive:
                open_.append([score, ident, 0])
                return
            open_[:] = [w for w in open_ if w[2] < negatives and least_percent * w[0] <= 100 * score]
            for w in open_:
                w[2] += 1
                yield anchor, w[1], w[2], ident, w[0], score

        return take

    others = _in_blocks(plain, asked, blocks, ["scores"]).mapInArrow(below, "key binary")
    keys = chosen.mapInArrow(mark, "key binary").unionByName(others)
    names = ["row", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    schema = pa.schema([(n, pa.int32() if n == "rank" else pa.int64()) for n in names])
    ddl = ", ".join(f"{n} {'int' if n == 'rank' else 'long'}" for n in names)
    mined = _sorted_keys(keys).mapInArrow(_by_anchor(windows, schema), ddl)
    named = anchors.select("row", F.col("id").alias("anchor_id"))
    return mined.join(named, "row").select("anchor_id", *names[1:])
