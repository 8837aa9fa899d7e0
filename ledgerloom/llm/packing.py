"""Best-fit packing by hierarchical residual rounds.

Documents become token pieces of at most ``ROOM`` tokens, which are dealt out evenly, so that long and short ones mix
however the documents came. Each partition packs its own pieces best-fit, the longest first: a piece goes where least room
would be left. Bins with at most ``SLACK`` free tokens are done. All others are items of the next round, dealt anew to a
sixteenth of the partitions, or to as many as ``ITEMS`` bins a task need. Rounds end when one partition has packed all that
is left, or when neither the tree gets narrower nor the bins fewer: what is left then are bins that don't fit together.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import offsets_and_bytes, slices, text_column
from ledgerloom.llm.shared import widened, written

ROOM = 4096
END_ID = 1
SLACK = 8
FAN_IN = 16
#: Pieces, or open bins, that are packed together.
ITEMS = 250_000
#: A round that leaves more than this share of its bins has not made them fewer.
FALLS = 0.99
#: Text bytes that are encoded at a time.
SLICE_BYTES = 4 << 20
#: Parts of words whose ids a task keeps.
KNOWN = 300_000
#: Letter parts that are encoded as one text.
JOINED = 256
_SPACE, _ODD, _LETTER, _DIGIT, _TAIL = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*b".,!?*%&$#|;:-()\"/"]] = _TAIL
#: What follows 0xC3: À to ÿ but not the signs × and ÷.
_AFTER_C3 = np.full(256, _ODD, np.uint8)
_AFTER_C3[[k for k in range(0x80, 0xC0) if k not in (0x97, 0xB7)]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def best_fit(lengths: np.ndarray, room: int = ROOM) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and place of each item, longest first (ties by position), and the free room of each bin."""
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(room + 1)]
    open_rooms = 0  # bit r is set while a bin with r free tokens exists
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fits = open_rooms >> size
        if fits:
            left = (fits & -fits).bit_length() - 1
            chosen = with_room[left + size].pop()
            if not with_room[left + size]:
                open_rooms ^= 1 << (left + size)
            places[k] = room - left - size
        else:
            chosen, left = len(free), room - size
            free.append(room)
        free[chosen] = left
        bins[k] = chosen
        if left:
            with_room[left].append(chosen)
            open_rooms |= 1 << left
    return bins, places, free


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[begin:begin + size] of each, one after the other."""
    source = np.repeat(begin - (np.cumsum(size) - size), size)
    source += np.arange(len(source))
    return flat[source]


class Vocabulary:
    """A tokenizer and the parts of words that it has encoded so far.

    With more than ``KNOWN`` parts, those that the slice at hand does not use are forgotten.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # for Latin letters and spaces, which need no other splitting
        self.letters = Tokenizer(self.whole.model)
        self.letters.normalizer = normalizers.Lowercase()
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, ids = getattr(self.whole.model, "end_of_word_suffix", None), self.whole.get_vocab()
        self.ends_word = np.zeros(max(ids.values()) + 1, bool)
        self.ends_word[[k for token, k in ids.items() if suffix and token.endswith(suffix)]] = True
        self.known = pa.array([], pa.large_string())
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _singly(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for r in rows for i in r], np.uint32), np.array([len(r) for r in rows], np.int64)

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids and their number for each text of letters: a text ends where an id does that stands at a word's end only."""
        (e,) = self.letters.encode_batch_fast([" ".join(texts)], add_special_tokens=False)
        ids = np.array(e.ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(texts) else self._singly(texts)

    def _learn(self, parts: pa.Array, letters: int) -> None:
        """Encodes new parts, of which the first ``letters`` are of Latin letters only."""
        texts = parts.to_pylist()
        coded = [self._joined(texts[k : min(k + JOINED, letters)]) for k in range(0, letters, JOINED)]
        coded += [self._singly(texts[k : k + JOINED]) for k in range(letters, len(texts), JOINED)]
        size = np.concatenate([n for _, n in coded])
        self.begin = np.append(self.begin, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.concatenate([self.flat, *(ids for ids, _ in coded)])
        self.known = pa.concat_arrays([self.known, parts])

    def _forget(self, parts: pa.Array) -> None:
        used = pc.index_in(parts, value_set=self.known).drop_null()
        at = used.to_numpy()
        self.known, self.flat, self.size = self.known.take(used), _gather(self.flat, self.begin[at], self.size[at]), self.size[at]
        self.begin = np.cumsum(self.size) - self.size

    def encode_parts(self, parts: pa.Array, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin in ``flat`` and number of the ids of each of the distinct ``parts``."""
        if len(self.known) > KNOWN:
            self._forget(parts)
        places = pc.index_in(parts, value_set=self.known)
        at = places.fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            plain = kinds[new] == _LETTER
            new = np.concatenate((new[plain], new[~plain]))
            at[new] = len(self.known) + np.arange(len(new))
            self._learn(parts.take(pa.array(new)), int(plain.sum()))
        return self.begin[at], self.size[at]


def word_parts(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case, in parts: runs of Latin letters, single digits, runs of signs.

    The vocabulary's splitter cuts there too. A word that holds anything else, such as an apostrophe, a combining mark or
    another script's letter, is one part. Returns the bytes without white space, each part's start in them and kind, and
    each text's first part (with the total at the end).
    """
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    kind[lead] = _AFTER_C3[data[lead]]
    kept = np.flatnonzero(kind != _SPACE)
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    opens[1:-1] |= kind[:-1] == _SPACE
    kind, opens = kind[kept], opens[kept]
    words = np.flatnonzero(opens)
    if len(words):
        odd = np.minimum.reduceat(kind, words) == _ODD
        kind[np.repeat(odd, np.diff(words, append=len(kept)))] = _ODD
    opens[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    starts = np.flatnonzero(opens)
    return _LOWER[data[kept]], starts, kind[starts], np.searchsorted(starts, np.searchsorted(kept, offsets))


def encode(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a large_string array, as the tokenizer gives them for each whole text.

    The vocabulary's splitter never joins across white space or across the parts of ``word_parts``, so a text's ids are
    those of its parts in order, and each distinct part is encoded once. A text that holds a special token's letters is
    encoded as it is.
    """
    out, starts, kinds, first = word_parts(*offsets_and_bytes(texts))
    body = out.tobytes()
    parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(out))), pa.py_buffer(body))
    coded = parts.dictionary_encode()
    used = coded.indices.to_numpy()
    kind = np.zeros(len(coded.dictionary), np.uint8)
    kind[used] = kinds
    begin, size = vocabulary.encode_parts(coded.dictionary, kind)
    each = size[used]
    tokens = _gather(vocabulary.flat, begin[used], each)
    bounds = np.append(0, np.cumsum(each))[first]
    if any(t in body for t in (b"<|startoftext|>", b"<|endoftext|>")):
        rows = [tokens[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for k, text in enumerate(texts.to_pylist()):
            if "<|" in text:
                rows[k] = np.array(vocabulary.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        tokens, bounds = np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    return tokens, bounds


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, and ids if wanted): every whole text's ids and ``END_ID``, cut every ``room``.

    A null text counts as empty and is one piece of one token. ``tokenizer`` is a vocabulary file's path on executors.
    """
    cut = _pieces(docs, tokenizer, id_col, text_col, room, with_ids)
    return _with_lists(cut) if with_ids else cut


def _with_lists(pieces_: DataFrame) -> DataFrame:
    """ids as a list of numbers instead of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            offsets, data = offsets_and_bytes(batch.column(at).cast(pa.large_binary()))
            numbers = pa.array(np.frombuffer(data.tobytes(), "<u4").view(np.int32))
            yield batch.set_column(at, "ids", pa.ListArray.from_arrays(pa.array((offsets // 4).astype(np.int32)), numbers))

    last = pieces_.select(*pieces_.drop("ids").columns, "ids")
    return last.mapInArrow(run, widened(last.drop("ids"), ids="array<int>")).select(*pieces_.columns)


def _pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, room: int, with_ids: bool) -> DataFrame:
    """``pieces`` with ids as bytes, four for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(tokenizer)
        for large in batches:
            for batch in slices(large, "text", SLICE_BYTES):
                tokens, bounds = encode(text_column(batch, "text"), vocabulary)
                tokens = np.insert(tokens.astype("<u4"), bounds[1:], END_ID)
                bounds = bounds + np.arange(len(bounds))
                count = -(-np.diff(bounds) // room)
                owner = np.repeat(np.arange(len(count)), count)
                number = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
                low = bounds[:-1][owner] + number * room
                high = np.minimum(low + room, bounds[1:][owner])
                view = memoryview(tokens).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                columns = [
                    batch.column(0).take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(number * room),
                    pa.array(high - low), pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    ends = np.append(4 * low, 4 * bounds[-1])
                    columns.append(pa.Array.from_buffers(pa.large_binary(), len(low), [None, pa.py_buffer(ends), pa.py_buffer(tokens)]).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ", ids binary" if with_ids else ""
    return picked.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long{more}").withColumnRenamed("id", id_col)


def _pack_rows(room: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, rows = TaskContext.get().partitionId() << 36, [], 0
        used = 0

        def pack() -> pa.RecordBatch:
            nonlocal used
            batch = pa.Table.from_batches(held).combine_chunks()
            bins, places, free = best_fit(batch.column("size").to_numpy(), room)
            filled = room - np.array(free, np.int64)
            out = batch.append_column("bin", pa.array(base + used + bins)).append_column("place", pa.array(places)).append_column("filled", pa.array(filled[bins]))
            used += len(free)
            return out.to_batches(max_chunksize=1 << 16)

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ITEMS:
                yield from pack()
                held, rows = [], 0
        if rows:
            yield from pack()

    return run


def _merge_bins(room: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        order = np.argsort(table.column("bin").to_numpy())
        names, sizes = (table.column(c).to_numpy()[order] for c in ("bin", "filled"))
        bins, places, free = best_fit(sizes, room)
        filled = room - np.array(free, np.int64)
        parent = -1 - ((TaskContext.get().partitionId() << 36) + (level << 30) + np.arange(len(free)))
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(parent[bins]), pa.array(places), pa.array(filled[bins])], names=["bin", "parent", "place", "filled"])

    return run


def pack(items: DataFrame, room: int = ROOM) -> DataFrame:
    """``items`` with sequence_id and offset: sequences of at most ``room`` tokens, without gaps from 0.

    A ``length`` that is null, below 1 or above ``room`` is an error. Columns of the two names are replaced, others pass,
    whatever their names. Equal lengths go by their order in the partition. An empty table gives an empty result.
    """
    kept = items.drop("sequence_id", "offset")
    size = F.col("length").cast("long")
    size = F.when(size.between(1, room), size).otherwise(F.raise_error(F.lit("a length must be from 1 to the room")).cast("long"))
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), size.alias("size"))
    first = rows.withColumns({c: F.lit(0).cast("long") for c in ("bin", "place", "filled")}).schema
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = written(rows.repartition(parts).mapInArrow(_pack_rows(room), first), "packed")
    open_ = F.col("filled") < room - SLACK
    left = written(packed.filter(open_).groupBy("bin").agg(F.max("filled").alias("filled")), "open")
    assigned, level, count, before = None, 0, left.count(), None
    while count:
        narrower = max(1, -(-parts // FAN_IN), -(-count // ITEMS))
        if before is not None and narrower >= parts and count > FALLS * before:
            break
        parts, level, before = narrower, level + 1, count
        merged = written(left.repartition(parts, F.xxhash64("bin", F.lit(level))).mapInArrow(_merge_bins(room, level), "bin long, parent long, place long, filled long"), "merged")
        step = merged.select(F.col("bin").alias("from"), "parent", F.col("place").alias("shift"))
        if assigned is None:
            assigned = step.select(F.col("from").alias("bin"), F.col("parent").alias("root"), "shift")
        else:
            now = assigned.join(step.withColumnRenamed("shift", "more").withColumnRenamed("parent", "up"), F.col("root") == F.col("from"), "left")
            assigned = now.select("bin", F.coalesce("up", "root").alias("root"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        if parts == 1:
            break
        left = merged.filter(open_).groupBy(F.col("parent").alias("bin")).agg(F.max("filled").alias("filled"))
        count = left.count()
    if assigned is None:
        assigned = packed.select("bin", F.col("bin").alias("root"), F.lit(0).cast("long").alias("shift")).limit(0)
    placed = packed.join(assigned, "bin", "left")
    return placed.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept.columns], F.coalesce("root", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and place; repeated rows are packed as often as they come.

    A null or empty text is one piece of one token, a text longer than the room several pieces, an empty table no row. Ids are written once and joined to the assignment at the end, so that only numbers and lengths are packed.
    """
    if not with_ids:
        return pack(pieces(docs, tokenizer, id_col, text_col, room), room)
    return _with_lists(_sequences(docs, tokenizer, id_col, text_col, room))


def _sequences(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, room: int) -> DataFrame:
    cut = _pieces(docs, tokenizer, id_col, text_col, room, True)
    held = written(cut.withColumn("_number", F.monotonically_increasing_id()), "pieces")
    assigned = pack(held.select("_number", "length"), room).drop("length")
    return held.join(assigned, "_number").drop("_number")


def packing_report(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM) -> DataFrame:
    """``pack_documents`` with the CRC of the ids that come out of it, little-endian, in place of the ids; edge cases as there."""
    return with_crc_of_ids(_sequences(docs, tokenizer, id_col, text_col, room))


def with_crc_of_ids(packed: DataFrame) -> DataFrame:
    """``packed`` with ids_crc32 taken from the bytes in the column ids, which is dropped."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
