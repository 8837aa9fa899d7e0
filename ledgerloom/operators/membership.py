"""Sets of keys as bits: a Bloom filter that thins rows before a shuffle, and exact distinct counts that roll up.

Bits are kept in 64-bit words, so that ``bit_or`` is an ordinary hash aggregate with partial sums on the map side: a set
never moves more rows than the distinct keys it stands for, and up to 64 times fewer where keys are dense numbers.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys of a Bloom filter for each of its words, when it may be as large as it wants: 16 bits a key.
KEYS_PER_WORD = 4
#: Words in one row of the filter (4 KB).
BLOCK_WORDS = 512
#: Rows of the largest filter: 64 MB, which every task may hold. More keys make it denser, so that it keeps more rows.
MOST_BLOCKS = 16_384
#: Bits that a key sets, all in one word.
BITS_PER_KEY = 4


def _or_of_bits(positions: Sequence[Column]) -> Column:
    one = F.lit(1).cast("long")
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p.cast("int")) for p in positions])


def _place(keys: Sequence[Column], blocks: int) -> tuple[Column, Column, Column]:
    """Block, word and bits of a key; the block is null where a part of the key is."""
    whole = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    word = F.pmod(F.xxhash64(*keys), F.lit(blocks * BLOCK_WORDS))
    second = F.xxhash64(*keys, F.lit(1))
    bits = _or_of_bits([F.shiftright(second, 6 * n).bitwiseAND(63) for n in range(BITS_PER_KEY)])
    block = F.when(whole, F.floor(word / BLOCK_WORDS).cast("int"))
    return block, F.pmod(word, F.lit(BLOCK_WORDS)).cast("int"), bits


def key_filter(keys: DataFrame, columns: Sequence[str], rows: int) -> tuple[DataFrame, int]:
    """A Bloom filter of the keys in ``columns`` and its number of blocks.

    ``rows`` is the number of keys, copies may count; it sizes the filter and nothing else. Keys with a null part are not
    in it, an empty table gives a filter without rows. Columns are whole numbers, texts, dates or the like; of floating
    keys 0.0 and -0.0 would differ.
    """
    blocks = min(max(1, -(-rows // (KEYS_PER_WORD * BLOCK_WORDS))), MOST_BLOCKS)
    block, word, bits = _place([F.col(c) for c in columns], blocks)
    words = keys.select(block.alias("_block"), word.alias("_word"), bits.alias("_bits")).dropna().groupBy("_block", "_word").agg(
        F.bit_or("_bits").alias("_bits"))
    # each held block once more with all its words empty, so that sorting alone puts every word in its place
    empty = words.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).select(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1))).alias("_word"), F.lit(0).cast("long").alias("_bits"))
    return _in_order(words.unionByName(empty), "_block", "_word").select("_block", F.col("_held").alias("_words")), blocks


def _in_order(words: DataFrame, block: str, word: str) -> DataFrame:
    """(block, _held): the bits of each block's words, combined by ``bit_or``, as a list in the order of the words."""
    whole = words.groupBy(block, word).agg(F.bit_or("_bits").alias("_bits"))
    listed = F.sort_array(F.collect_list(F.struct(word, "_bits")))  # one block: BLOCK_WORDS entries at the most
    return whole.groupBy(block).agg(listed.getField("_bits").alias("_held"))


def _patterns() -> Column:
    """1,024 patterns of ``BITS_PER_KEY`` bits in a word; the sign bit is left out."""
    draw = random.Random(0)
    drawn = [sum(1 << bit for bit in draw.sample(range(63), BITS_PER_KEY)) for _ in range(1024)]
    return F.expr(f"array({', '.join(f'{p}L' for p in drawn)})")


def possibly_among(columns: Mapping[str, str], keys: DataFrame, rows: int) -> Column:
    """A condition that holds for the rows whose key ``keys`` has, and for few others (about one in a hundred).

    It says the same as ``possibly_in``, but as a filter, not as a join. Catalyst moves a filter below projections, unions,
    aggregates by the key and other joins, so rows without a key are left out at the scan before any field of theirs is read.
    The words are the one value of a subquery: 64 MB at the most, whatever the number of keys. Rows with a null in the key may
    pass; an exact join is to follow. ``columns`` maps columns of the filtered table to those of ``keys``, of the same types.
    """
    words = min(max(1, -(-rows // KEYS_PER_WORD)), MOST_BLOCKS * BLOCK_WORDS)

    def place(names: Sequence[str]) -> tuple[Column, Column]:
        # the hash stands here twice, as it does in the filter: code that names a key's expression often grows large
        key = F.xxhash64(*[F.col(c) for c in names])
        return F.pmod(key, F.lit(words)).cast("int"), F.get(_patterns(), F.shiftrightunsigned(key, 54).cast("int"))

    word, bits = place(list(columns.values()))
    held = keys.dropna(subset=list(columns.values())).select(word.alias("_word"), bits.alias("_bits"))
    empty = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    placed = held.unionByName(empty).withColumn("_block", F.floor(F.col("_word") / BLOCK_WORDS).cast("int"))
    blocks = F.sort_array(F.collect_list(F.struct("_block", "_held")))  # MOST_BLOCKS entries at the most
    table = _in_order(placed, "_block", "_word").agg(F.flatten(blocks.getField("_held")).alias("_words"))
    word, bits = place(list(columns))
    return F.bitwise_not(F.get(table.scalar(), word)).bitwiseAND(bits) == 0


def possibly_in(df: DataFrame, columns: Mapping[str, str], keys: DataFrame, rows: int) -> DataFrame:
    """The rows of ``df`` whose key may be among those of ``keys``: all that are, and about one in a hundred others.

    ``columns`` maps columns of ``df`` to those of ``keys``; the two must have the same type, as equal keys must have equal
    hashes. Rows with a null in the key are left out, as an equality join does. The filter is broadcast: at most
    ``MOST_BLOCKS`` rows of 4 KB, whatever the number of keys. An exact join is to follow.
    """
    unlike = [(a, b) for a, b in columns.items() if df.schema[a].dataType != keys.schema[b].dataType]
    if unlike:
        raise ValueError(f"key columns of different types: {unlike}")
    side, blocks = key_filter(keys, list(columns.values()), rows)
    block, word, bits = _place([F.col(c) for c in columns], blocks)
    held = F.get(F.col("_words"), word).bitwiseAND(bits) == bits
    return df.join(F.broadcast(side), (block == F.col("_block")) & held).drop("_block", "_words")


def member_words(fact: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(by, column, word, bits): the sets of the whole-number ``keys`` in each group, in one pass over ``fact``.

    Null keys are in no set. The table is small, and any coarser grouping follows from it without the fact.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).cast("long").alias("number")) for k in keys])
    tall = fact.select(*by, F.inline(pairs)).filter(F.col("number").isNotNull())
    return tall.groupBy(*by, "column", F.shiftright("number", 6).alias("word")).agg(
        F.bit_or(_or_of_bits([F.col("number").bitwiseAND(63)])).alias("bits"))


def distinct_members(words: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, column, members): exact distinct counts of a grouping by columns of ``words``."""
    sets = words.groupBy(*by, "column", "word").agg(F.bit_or("bits").alias("bits"))
    return sets.groupBy(*by, "column").agg(F.sum(F.bit_count("bits")).cast("long").alias("members"))


def member_balance(used: DataFrame, known: DataFrame) -> DataFrame:
    """(column, matched, orphans, idle): distinct members in both sets, only in ``used`` and only in ``known``, by column.

    Both are ``member_words`` without groups; words meet once, so no key is shuffled by itself and none can be hot.
    """
    empty = F.lit(0).cast("long")
    left = used.select("column", "word", F.col("bits").alias("u"))
    right = known.select("column", "word", F.col("bits").alias("k"))
    both = left.join(right, ["column", "word"], "full").withColumns({c: F.coalesce(c, empty) for c in ("u", "k")})

    def held(bits: Column) -> Column:
        return F.sum(F.bit_count(bits)).cast("long")

    return both.groupBy("column").agg(
        held(F.col("u").bitwiseAND(F.col("k"))).alias("matched"),
        held(F.col("u").bitwiseAND(F.bitwise_not("k"))).alias("orphans"),
        held(F.col("k").bitwiseAND(F.bitwise_not("u"))).alias("idle"))
