"""Connected components of a graph whose edges are rows: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.hash("a", "b").cast("long"))).first()
    return tuple(row)


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with the least neighbour of their node.

    The join key is an expression over the aggregate: on the grouping column itself the join would reuse the aggregate's
    exchange, and AQE splits a hub's edges only where the exchange stands directly under the join.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n"))
    return edges.join(least.select(F.when(F.col("n") > 0, F.col("a")).alias("_node"), "least"), F.col("a") == F.col("_node")).drop("_node")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: root is the smallest node that it reaches.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest; a round is two equality
    joins against one row per node, and its edges are written before the next. Nothing is collected but a checksum.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _with_least(both).filter("b > a")
            .select(F.col("b").alias("a"), F.least("least", "a").alias("b")).distinct()
        )
        large = written(large, "large")
        small = (
            _with_least(large)
            .select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a <> b").distinct()
        )
        now = written(small, "small")
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
