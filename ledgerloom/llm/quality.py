"""Quality classifier: a generalised additive model with pairwise interactions, scored from lookup tables.

Every text becomes a row of bounded statistics, every statistic a bin. Cyclic boosting visits one feature after the
other with a small step: a tree of at most four leaves over that feature's bins is fitted to the loss's gradient and
added to the feature's table. Then the pairs that explain most of what is left get a table each, boosted in the same
way. A score is the logistic of an intercept plus one table entry a feature and a pair.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of their id; only their
statistics come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import mix64, offsets_and_bytes, slices, span_hashes, spaced_words, text_column
from ledgerloom.llm.shared import widened

#: Most labelled rows that a model is fitted on.
TRAIN_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 12
ROUNDS = 60
STEP = 0.15
#: Scores from this on are accepted.
ACCEPT = 0.3

_KINDS = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "high": range(0x80, 0x100),
    "line": [0x0A], "stop": b".", "comma": b",", "bang": b"!?", "bar": b"|", "mark": b"*#$%&@^~=_+<>\\/", "bracket": b"()[]{}",
    "quote": b"\"'`", "other": b"-:;", "control": [*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F],
}
FEATURES = [
    "log_bytes", "log_words", "word_length", *_KINDS, "bytes_a_line", "distinct_words", "commonest_word", "same_next",
    "distinct_threes", "distinct_lines", "commonest_line", "marked_words", "capital_words", "longest_word",
]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each owner: distinct hashes, and how often the commonest comes."""
    keys = np.sort(owner.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    runs, own = np.diff(np.append(first, len(keys))), (keys[first] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, own, runs)
    return np.bincount(own, minlength=n), most


def statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` a text; all are finite, also for an empty text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    share = np.maximum(size, 1)
    kind = np.zeros(256, np.uint8)
    for k, members in enumerate(_KINDS.values(), 1):
        kind[list(members)] = k
    text = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(text * (len(_KINDS) + 1) + kind[data], minlength=n * (len(_KINDS) + 1)).reshape(n, -1)[:, 1:]
    letters = counts[:, 0] + counts[:, 1] + counts[:, 3]
    out, starts, ends, first = spaced_words(offsets, data)
    words = np.diff(first)
    many = np.maximum(words, 1)
    owner = np.repeat(np.arange(n), words)
    hashes = span_hashes(out, starts, ends)
    distinct, commonest = _distinct(owner, hashes, n)
    same = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    three = mix64(hashes[:-2] + np.uint64(3) * hashes[1:-1] + np.uint64(7) * hashes[2:])
    whole = owner[2:] == owner[:-2]
    threes, _ = _distinct(owner[2:][whole], three[whole], n)
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    breaks[1:] |= data == 0x0A
    at = np.flatnonzero(breaks)
    line_from, line_to = at[:-1], at[1:]
    raw = span_hashes(data, line_from, line_to)
    line_owner = np.searchsorted(offsets, line_from, "right") - 1
    lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
    distinct_lines, common_line = _distinct(line_owner, raw, n)
    last = out[np.maximum(ends - 1, 0)] if len(out) else out
    marked = np.bincount(owner[kind[last] >= 8], minlength=n) if len(last) else np.zeros(n)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, ends - starts)
    after_space = np.zeros(len(data), bool)
    after_space[1:] = (data[:-1] == 0x20) | (data[:-1] == 0x0A)
    after_space[offsets[:-1][size > 0]] = True
    capitals = np.bincount(text[after_space & (kind[data] == 1)], minlength=n)
    columns = [
        np.log1p(size), np.log1p(words), np.bincount(owner, ends - starts, n) / many,
        counts[:, 0] / np.maximum(letters, 1), *(counts[:, 1:] / share[:, None]).T, size / lines,
        distinct / many, commonest / many, same / many, threes / np.maximum(words - 2, 1), distinct_lines / lines,
        common_line / lines, marked / many, capitals / many, longest,
    ]
    return np.stack(columns, axis=1).astype(np.float32) if n else np.zeros((0, len(FEATURES)), np.float32)


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if len(values) else np.zeros(0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values of the best tree over ordered bins with gradient and curvature sums g and h."""
    value = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth and len(g) > 1:
        left, weight = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = left**2 / (weight + 1.0) + (g.sum() - left) ** 2 / (h.sum() - weight + 1.0) - g.sum() ** 2 / (h.sum() + 1.0)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > 1e-9:
            value = np.concatenate((_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)))
    return value


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The better of: cut the rows and each half's columns, or the other way round."""

    def cut_rows(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        best, table = -1.0, np.zeros_like(g)
        for cut in range(1, len(g)):
            halves = [_tree(g[p].sum(0), h[p].sum(0), 1) for p in (slice(None, cut), slice(cut, None))]
            now = np.concatenate((np.tile(halves[0], (cut, 1)), np.tile(halves[1], (len(g) - cut, 1))))
            gain = float((g * now - 0.5 * (h + 1.0 / g.size) * now**2).sum())
            if gain > best:
                best, table = gain, now
        return best, table

    a, b = cut_rows(g, h), cut_rows(g.T, h.T)
    return a[1] if a[0] >= b[0] else b[1].T


def fit(rows: np.ndarray, labels: np.ndarray) -> dict:
    """Cuts and tables from statistics and 0/1 labels. Without rows every score is 0.5; with one class, near its share."""
    n = len(labels)
    share = (labels.sum() + 1.0) / (n + 2.0)
    model = {"intercept": float(np.log(share / (1 - share))), "cuts": [_cuts(c, BINS) for c in rows.T], "pairs": []}
    bins = [np.searchsorted(c, x, "left") for c, x in zip(model["cuts"], rows.T, strict=True)]
    model["tables"] = [np.zeros(len(c) + 1) for c in model["cuts"]]
    if not n:
        return model
    score = np.full(n, model["intercept"])

    def sums(cell: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return np.bincount(cell, labels - p, size), np.bincount(cell, p * (1 - p), size)

    for _ in range(ROUNDS):
        for table, cell in zip(model["tables"], bins, strict=True):
            step = STEP * np.clip(_tree(*sums(cell, len(table))), -3, 3)
            table += step
            score += step[cell]
    coarse_cuts = [_cuts(x, PAIR_BINS) for x in rows.T]
    coarse = [np.searchsorted(c, x, "left") for c, x in zip(coarse_cuts, rows.T, strict=True)]
    found = []
    for a in range(len(bins)):
        for b in range(a + 1, len(bins)):
            na, nb = len(coarse_cuts[a]) + 1, len(coarse_cuts[b]) + 1
            g, h = sums(coarse[a] * nb + coarse[b], na * nb)
            found.append((float((g**2 / (h + 1.0)).sum()), a, b))
    for _, a, b in sorted(found, reverse=True)[:PAIRS]:
        model["pairs"].append((a, b, coarse_cuts[a], coarse_cuts[b], np.zeros((len(coarse_cuts[a]) + 1, len(coarse_cuts[b]) + 1))))
    for _ in range(ROUNDS // 3):
        for a, b, _, _, table in model["pairs"]:
            cell = coarse[a] * table.shape[1] + coarse[b]
            step = STEP * np.clip(_grid_tree(*(x.reshape(table.shape) for x in sums(cell, table.size))), -3, 3)
            table += step
            score += step.ravel()[cell]
    return model


def score_rows(model: dict, rows: np.ndarray) -> np.ndarray:
    total = np.full(len(rows), model["intercept"])
    for cuts, table, column in zip(model["cuts"], model["tables"], rows.T, strict=True):
        total += table[np.searchsorted(cuts, column, "left")]
    for a, b, cuts_a, cuts_b, table in model["pairs"]:
        total += table[np.searchsorted(cuts_a, rows[:, a], "left"), np.searchsorted(cuts_b, rows[:, b], "left")]
    return 1 / (1 + np.exp(-total))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = TRAIN_ROWS) -> dict:
    """A model from at most ``most`` distinct (id, label) pairs of ``labels`` whose label is 0 or 1, with their texts by id.

    Null ids and other labels are left out. Of documents that share an id one is learned from, that of the least features,
    so no more than ``most`` rows reach the driver. Null and empty texts have features like others, long ones are read
    whole. Without a labelled document the model gives every text the same score.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label in (0, 1)").distinct()
    sample = marked.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "label").limit(most)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = statistics(*offsets_and_bytes(text_column(batch, "text")))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32()), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), listed], names=["id", "label", "row"])

    # the sample has a set number of rows
    joined = texts.join(F.broadcast(sample), "id").select("id", "label", "text")
    featured = joined.mapInArrow(run, "id string, label int, row array<float>")
    got = featured.groupBy("id", "label").agg(F.min("row").alias("row")).toArrow()
    rows = np.array(got.column("row").to_pylist(), np.float32).reshape(-1, len(FEATURES))
    label = got.column("label").to_numpy().astype(float)
    order = np.lexsort((*rows.T, label, np.array(got.column("id").to_pylist(), dtype=str)))  # as rows arrive in any order
    return fit(rows[order], label[order])


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, higher: label 1 likelier) and predicted (1 from ``ACCEPT`` on); the text alone
    decides, and columns of these two names are replaced.

    A null text counts as empty, and an empty text has a score like any other. Equal texts get equal scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                got = score_rows(model, statistics(*offsets_and_bytes(text_column(batch, text_col))))
                rest = [(n, batch.column(k)) for k, n in enumerate(batch.schema.names) if n not in ("score", "predicted")]
                yield pa.RecordBatch.from_arrays([x for _, x in rest] + [pa.array(got), pa.array((got >= ACCEPT).astype(np.int32))], names=[n for n, _ in rest] + ["score", "predicted"])

    kept = docs.drop("score", "predicted")
    return kept.mapInArrow(run, widened(kept, score="double", predicted="int"))
