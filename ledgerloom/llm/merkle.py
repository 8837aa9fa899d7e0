"""Merkle manifest of a dataset by butterfly exchange.

Leaves are ordered within their group (a language, say) and dealt into aligned blocks of ``FANOUT ** BLOCK_LEVELS``
consecutive leaves; each block hashes its own subtree. Then aligned groups of ``FANOUT`` subtrees meet round by round: in a
round, block i of each subtree meets block i of its sister subtrees, all learn each other's roots, and each hashes their
common parent. A block so gathers the upper half of its proofs on the way up: no pass leads down again. The last subtree
of a group may have fewer blocks than its sisters; its blocks then meet several of theirs. The same rounds over the groups'
roots give the root of all. Only one row per block takes part in the rounds, never a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import written

#: Children of a node, and the levels of a block's own subtree (512 leaves). A node's children are hashed as hex text.
FANOUT_BITS, BLOCK_LEVELS = 3, 3
FANOUT = 1 << FANOUT_BITS
PROOF = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to by the siblings of ``proof``."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right, as one text."""
    return F.concat_ws("", F.transform(proof, lambda step: F.concat(step["left"], step["right"])))


def _before(df: DataFrame, value: str, out: str) -> DataFrame:
    """The sum of ``value`` over the rows before each one by (part, g): sums within parts, then over one row per part."""
    own = Window.partitionBy("part").orderBy(F.asc_nulls_first("g")).rowsBetween(Window.unboundedPreceding, -1)
    whole = df.groupBy("part").agg(F.sum(value).alias("whole"))
    ahead = whole.select("part", F.coalesce(
        F.sum("whole").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    within = df.withColumn(out, F.coalesce(F.sum(value).over(own), F.lit(0)))
    return within.join(ahead, "part").withColumn(out, F.col(out) + F.col("ahead")).drop("ahead")


def _ordered(leaves: DataFrame, group: str, order: str, leaf: str) -> tuple[DataFrame, DataFrame]:
    """Leaves with their group's number and their place in it, and one row per group: g, number, leaves, blocks, blocks before."""
    keys = [F.asc_nulls_first("g"), F.asc_nulls_first("o"), F.asc_nulls_first("leaf"), F.asc("tie")]
    rows = leaves.select(
        F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("row"), F.col(group).cast("string").alias("g"),
        F.col(order).alias("o"), F.col(leaf).alias("leaf"), F.monotonically_increasing_id().alias("tie"))
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    table = written(spread.select(
        "row", "leaf", "g", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")), "leaves")
    runs = table.groupBy("g", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    ahead = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "runs")
    size = 1 << (FANOUT_BITS * BLOCK_LEVELS)
    groups = runs.groupBy("g").agg(F.sum("n").alias("n"), F.min("part").alias("part")).select(
        "g", "part", "n", F.lit(1).alias("one"), F.ceil(F.col("n") / size).alias("blocks"))
    groups = written(_before(_before(groups, "one", "number"), "blocks", "start").drop("part", "one"), "groups")
    known = runs.alias("r").join(groups.alias("k"), F.expr("r.g <=> k.g")).select(
        F.col("r.g").alias("kg"), F.col("r.part").alias("kpart"), "first", "ahead", "number", "blocks")
    placed = table.join(known, F.expr("g <=> kg AND part = kpart")).select(
        "row", "leaf", "number", "blocks", (F.col("place") - F.col("first") + F.col("ahead")).alias("position"))
    return placed, groups


def _blocks(placed: DataFrame) -> DataFrame:
    """One row per block: its rows in order, the levels of its subtree that are hashed, and its digest."""
    bits, size = FANOUT_BITS, 1 << (FANOUT_BITS * BLOCK_LEVELS)
    out = placed.groupBy("number", "blocks", F.expr(f"position div {size}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("position", "leaf", "row"))).alias("items"))
    out = out.withColumn("level0", F.transform("items", lambda x: x["leaf"]))
    for k in range(BLOCK_LEVELS):  # a group of one block ends where one node is left
        above = f"transform(sequence(0, shiftright(size(level{k}) - 1, {bits})), r -> sha2(concat_ws('', slice(level{k}, r * {FANOUT} + 1, {FANOUT})), 256))"
        out = out.withColumn(f"level{k + 1}", F.expr(f"CASE WHEN level{k} IS NOT NULL AND (blocks > 1 OR size(level{k}) > 1) THEN {above} END"))
    hashed = [F.expr(f"CASE WHEN level{k + 1} IS NOT NULL THEN level{k} END") for k in range(BLOCK_LEVELS)]
    last = F.coalesce(*[F.col(f"level{k}") for k in range(BLOCK_LEVELS, -1, -1)])
    return out.select(
        "number", "block", "blocks", "items", F.filter(F.array(*hashed), lambda x: x.isNotNull()).alias("levels"), last[0].alias("digest"))


def _meet(state: DataFrame, group: list[Column], digit: Column, index: Column, width: Column, widest: Column, active: Column) -> DataFrame:
    """One round: the blocks of equal index of up to FANOUT sister subtrees swap digests and hash their parent.

    A subtree of ``width`` blocks in a group whose widest has more sends each digest to every ``width``-th index.
    """
    slots = F.when(active, F.sequence(index, widest - 1, width)).otherwise(F.array(index))
    sent = state.select("*", digit.alias("digit"), index.alias("own"), active.alias("active"), *[c.alias(f"_{k}") for k, c in enumerate(group)], F.explode(slots).alias("slot"))
    own = F.struct(*[F.col(c) for c in state.columns])
    members = F.sort_array(F.collect_list(F.struct("digit", "own", "digest", own.alias("state"))))
    met = sent.groupBy(*[f"_{k}" for k in range(len(group))], "slot", "active").agg(members.alias("members"))
    met = met.withColumn("digests", F.transform("members", lambda m: m["digest"]))
    met = met.withColumn("parent", F.when(F.col("active"), F.sha2(F.concat_ws("", "digests"), 256)))
    one = met.select("slot", "active", "digests", "parent", F.posexplode("members").alias("at", "m")).filter("m.own = slot")
    step = F.expr(f"named_struct('left', concat_ws('', slice(digests, 1, at)), 'right', concat_ws('', slice(digests, at + 2, {FANOUT})))")
    grown = F.when(F.col("active"), F.concat("m.state.proof", F.array(step))).otherwise(F.col("m.state.proof"))
    rest = [F.col(f"m.state.{c}").alias(c) for c in state.columns if c not in ("digest", "proof")]
    return one.select(*rest, F.coalesce("parent", "m.digest").alias("digest"), grown.alias("proof"))


def _exchanged(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """number, block, subroot, root and the upper proof of every block."""
    most, count = groups.agg(F.max("blocks"), F.count("*")).first()
    state = blocks.select("number", "block", "blocks", "digest", F.array().cast(PROOF).alias("proof"))
    unit = 1
    while unit < (most or 0):
        subtree, wide = F.expr(f"block div {unit}"), F.lit(unit).cast("long")
        run = F.expr(f"block div {unit * FANOUT}")
        width = F.least(wide, F.col("blocks") - subtree * unit)
        widest = F.least(wide, F.col("blocks") - run * (unit * FANOUT))
        state = _meet(state, [F.col("number"), run], subtree % FANOUT, F.col("block") % unit, width, widest, F.col("blocks") > unit)
        unit *= FANOUT
    state = state.withColumn("subroot", F.col("digest"))
    unit = 1
    while unit < count:
        sizes = groups.groupBy(F.expr(f"number div {unit}").alias("tree")).agg(F.min("start").alias("low"), F.sum("blocks").alias("width"))
        sizes = sizes.withColumn("widest", F.max("width").over(Window.partitionBy(F.expr(f"tree div {FANOUT}"))))
        starts = groups.select(F.col("number").alias("of"), "start")
        here = state.join(starts, F.col("number") == F.col("of")).drop("of")
        here = here.withColumn("mine", F.expr(f"number div {unit}")).join(sizes, F.col("mine") == F.col("tree")).drop("mine")
        met = _meet(here, [F.expr(f"tree div {FANOUT}")], F.col("tree") % FANOUT, F.col("start") + F.col("block") - F.col("low"), F.col("width"), F.col("widest"), F.lit(True))
        state = met.select(*state.columns)
        unit *= FANOUT
    return state.select("number", "block", "subroot", F.col("digest").alias("root"), F.col("proof").alias("upper"))


def manifest(leaves: DataFrame, group: str, order: str, leaf: str = "leaf") -> DataFrame:
    """``leaves`` with position, subroot, root and proof (the left and right siblings of each level, as hex texts).

    Leaves ascend by ``order`` (null first), then by digest, within their ``group`` (null is a group, the first one); equal
    leaves take places in any order. Every row has a result: repeated ids are leaves of their own; a group of one leaf has
    it as its subroot, one group's subroot is the root, and their proofs have no step. An empty table gives no rows. Columns
    that bear a result's name are replaced, all others pass. ``leaf`` must be hex digests without null (``leaf_digest``
    gives one for any nulls, empty and long texts). No task holds more than one block's leaves in memory.
    """
    kept = leaves.drop(*[c for c in ("position", "subroot", "root", "proof") if c not in (group, order, leaf)])
    placed, groups = _ordered(kept, group, order, leaf)
    blocks = written(_blocks(placed), "blocks")
    upper = _exchanged(blocks, groups)
    known = blocks.join(upper, ["number", "block"])
    bits, size = FANOUT_BITS, 1 << (FANOUT_BITS * BLOCK_LEVELS)
    lower = f"""transform(levels, (level, l) -> named_struct(
        'left', concat_ws('', slice(level, shiftleft(shiftright(i, {bits} * l + {bits}), {bits}) + 1, shiftright(i, {bits} * l) & {FANOUT - 1})),
        'right', concat_ws('', slice(level, shiftright(i, {bits} * l) + 2, {FANOUT - 1} - (shiftright(i, {bits} * l) & {FANOUT - 1})))))"""
    proofs = F.expr(f"transform(items, (x, i) -> struct(x.row AS row, x.position AS position, concat({lower}, upper) AS proof))")
    each = known.select("subroot", "root", F.explode(proofs).alias("x"))
    return each.select(*[F.col(f"x.row.`{c}`").alias(c) for c in kept.columns], "x.position", "subroot", "root", "x.proof")
