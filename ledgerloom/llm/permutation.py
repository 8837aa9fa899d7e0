"""Nearest neighbours by a permutation index.

Every vector is represented by its ``POSTED`` nearest pivots in order. Distinct vectors are dealt into blocks by hash, and
each block holds one inverted file per pivot: the places that this pivot has in the block's vectors. A query reads the
files of its own ``PROBED`` nearest pivots, adds up the footrule distance |place - place| over them (a vector that does
not post a pivot has place ``POSTED`` there). The block's ``RERANK`` nearest share by that distance, and every other vector
nearer than ``CLOSE`` of the block's median distance (a crowd that is too alike to tell apart), is ranked by the inner
product. Queries are cut into blocks as well, and each meets every block of vectors, so no task holds more than one
block of either. Copies of a vector are one entry, which keeps the ids of its k + 1 first rows: no result needs more.

Vectors of one length are compared with each other; one length's blocks, pivots and files are its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import written

#: Pivots, chosen among the ``PIVOT_SAMPLE`` distinct vectors with the smallest hash: those in turn that are not nearer
#: than cosine ``PIVOT_APART`` to one chosen before, so that a crowd of like vectors gives one pivot.
PIVOTS = 256
PIVOT_SAMPLE = 2048
PIVOT_APART = 0.8
POSTED = 128
PROBED = 64
#: Part of a block that is ranked by the measure itself, and least number.
RERANK = 0.06
RERANK_LEAST = 200
CLOSE = 0.5
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 2048


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): every row with an id and a vector that is not null, not empty, not zero and all finite.

    Repeated rows and rows that share an id stay rows of their own. Rows without id take no part.
    """
    vec = F.col(vec_col).cast("array<double>")
    picked = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).dropna()
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return picked.filter(F.coalesce(whole, F.lit(False)))


def _matrix(column: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)[order]


def _near(qs: np.ndarray, vs: np.ndarray, pivots: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each query the numbers of the vectors that its footrule distances leave to be ranked."""
    posted, probed = min(POSTED, len(pivots)), min(PROBED, len(pivots))
    nearest = np.argsort(-(vs @ pivots.T), axis=1, kind="stable")[:, :posted]
    places = np.full((len(vs), len(pivots)), posted, np.int16)
    np.put_along_axis(places, nearest, np.arange(posted, dtype=np.int16)[None], 1)
    files = np.ascontiguousarray(places.T)
    wanted = np.argsort(-(qs @ pivots.T), axis=1, kind="stable")[:, :probed]
    take = min(len(vs), max(RERANK_LEAST, k, int(np.ceil(RERANK * len(vs)))))
    for own in wanted:
        footrule = np.zeros(len(vs), np.int32)
        for place, pivot in enumerate(own.tolist()):
            footrule += np.abs(files[pivot] - np.int16(place))
        bound = np.partition(footrule, [take - 1, len(vs) // 2])
        yield np.flatnonzero(footrule <= max(bound[take - 1], CLOSE * bound[len(vs) // 2]))


def _searched(pivots: dict[int, np.ndarray], k: int):
    """A block's k best entries of each query; a length without pivots of its own is ranked whole."""

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and vectors.num_rows:
            asking, (entries, first) = queries.column("query").to_numpy(), (vectors.column(c).to_numpy() for c in ("entry", "first"))
            q_order, v_order = np.argsort(asking), np.lexsort((entries, first))
            asking, entries, first = asking[q_order], entries[v_order], first[v_order]
            qs, vs = _matrix(queries.column("vec"), q_order), _matrix(vectors.column("vec"), v_order)
            own = pivots.get(qs.shape[1])
            chosen = (np.arange(len(vs)) for _ in qs) if own is None else _near(qs, vs, own, k)
            for query, number, near in zip(qs, asking, chosen, strict=True):
                score = (vs[near] * query).sum(axis=1)
                best = near[order := np.lexsort((near, -score))[:k]]
                found.append((np.full(len(best), number), entries[best], first[best], score[order]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table(dict(zip(("query", "entry", "first", "score"), columns, strict=True)))

    return run


def choose_pivots(sample: Sequence[Sequence[float]]) -> dict[int, np.ndarray]:
    """Per length the vectors of ``sample`` in turn that are not too near to one chosen before, scaled to length 1."""
    chosen: dict[int, list[np.ndarray]] = {}
    for vector in sample:
        unit = np.array(vector) / np.abs(vector).max()  # by the largest component first: no square overflows or vanishes
        unit /= np.linalg.norm(unit)
        held = chosen.setdefault(len(unit), [])
        if len(held) < PIVOTS and (not held or (np.array(held) @ unit).max() < PIVOT_APART):
            held.append(unit)
    return {length: np.array(held) for length, held in chosen.items()}


def _best(found: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(query, best): the first k rows of each query's entries, an array of (loss, id, whether the query's own entry).

    A query's entries are cut to k before their ids are looked up, so it never holds more than k x k ids.
    """
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "first", "entry")
    nearest = found.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k)
    listed = nearest.join(entries.select("entry", "ids"), "entry")
    rows = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("loss"), i.alias("id"), (F.col("entry") == F.col("query")).alias("own")))
    gathered = listed.groupBy("query").agg(F.flatten(F.collect_list(rows)).alias("rows"))
    return gathered.select("query", F.slice(F.array_sort("rows"), 1, k).alias("best"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of each row whose id ``queries`` has, but the row itself,
    by the largest inner product.

    Ties go to the smaller id; a query has fewer rows if there are fewer candidates; without a usable vector the result
    is empty. Of rows that share an id each is a candidate, and each asks for itself if that id is asked for; a repeated
    row is the other's candidate. Only vectors of the query's own length are candidates. Only the id and vector columns
    are read.
    """
    rows = written(usable(vectors, id_col, vec_col), "vectors")
    asked = rows.join(queries.select(F.col(id_col).cast("long").alias("id")), "id", "left_semi")
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= k + 1)
    distinct = numbered.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = written(distinct.select(F.monotonically_increasing_id().alias("entry"), F.col("ids")[0].alias("first"), "ids", "vec"), "entries")
    wanted = written(entries.join(asked.select("vec").distinct(), "vec", "left_semi").select(F.col("entry").alias("query"), "vec"), "wanted")
    pivots = choose_pivots([r.vec for r in entries.orderBy(F.xxhash64("vec"), "vec").limit(PIVOT_SAMPLE).collect()])
    blocks, parts = -(-entries.count() // BLOCK_VECTORS), -(-wanted.count() // BLOCK_QUERIES)
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1))).alias(name)
    some = lambda n, name: F.pmod(F.xxhash64("vec", F.lit(1)), F.lit(max(n, 1))).cast("int").alias(name)
    task, length = ["length", "part", "block"], F.size("vec").alias("length")
    left = wanted.select("query", "vec", length, some(parts, "part"), every(blocks, "block")).groupBy(*task)
    right = entries.select("entry", "first", "vec", length, some(blocks, "block"), every(parts, "part")).groupBy(*task)
    found = left.cogroup(right).applyInArrow(_searched(pivots, k + 1), "query long, entry long, first long, score double")
    answers = _best(found, entries, k + 1).join(wanted, "query").select("vec", "best")
    own = F.array_position(F.transform("best", lambda r: r["own"] & (r["id"] == F.col("query_id"))), True)
    asking = asked.select(F.col("id").alias("query_id"), "vec").join(answers, "vec").withColumn("at", own)
    others = F.slice(F.filter("best", lambda r, n: n + 1 != F.col("at")), 1, k)
    ranked = asking.select("query_id", F.posexplode(others).alias("n", "found"))
    return ranked.select("query_id", (F.col("n") + 1).alias("rank"), F.col("found.id").alias("vec_id"), (-F.col("found.loss")).alias("score"))
