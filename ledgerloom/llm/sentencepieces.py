"""SentencePiece encoding by streaming Viterbi, and decoding.

The best segmentation maximises the sum of piece scores. Scores are kept for a window as long as the longest piece; ids are
committed as soon as all surviving backpointer paths go through one boundary. Until then a character costs one byte, the
length of the last piece of the best path to it. A space that follows another character is such a boundary always, as no
piece of the vocabulary crosses it (which is checked): the words between are segmented by themselves, the distinct ones of a
slice side by side in numpy, longer ones and whole texts one after another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import offsets_and_bytes, slices, text_column
from ledgerloom.llm.shared import widened

SPACE = "▁"
#: A character that no piece holds scores so much less than the worst piece.
UNKNOWN = 10.0
#: Words that a task remembers, and the longest one that is segmented beside others.
KNOWN = 400_000
KNOWN_LENGTH = 64
#: Words that are segmented side by side.
LANES = 1 << 15
#: Rows that are decoded at a time.
DECODED_ROWS = 256
REPLACEMENT = "\ufffd"
LOW = float("-inf")


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. for lengths[0] places, then the same of the next."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Pieces:
    """A vocabulary: pieces and scores, also as a trie in arrays. It is made on the driver and sent to the tasks."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [i for i in range(len(self.names)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.scores = {self.names[i]: (i, model.get_score(i)) for i in plain}
        # None for the start of a piece that is none itself
        self.table = dict.fromkeys(name[:k] for name in self.scores for k in range(1, len(name))) | self.scores
        self.longest = max(map(len, self.scores))
        self.unknown = min(s for _, s in self.scores.values()) - UNKNOWN
        self.bytes = {int(n[1:-1], 16): i for i, n in enumerate(self.names) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.whole_words = not any(SPACE in name.lstrip(SPACE) for name in self.scores)
        self._trie()
        text = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if model.is_control(i) else REPLACEMENT.encode() for i in range(len(self.names))]
        for name, (i, _) in self.scores.items():
            text[i] = name.replace(SPACE, " ").encode()
        text.append(REPLACEMENT.encode())  # of ids that there are none of
        self.text_starts = np.cumsum([0, *map(len, text)]).astype(np.int64)
        self.text_bytes = np.frombuffer(b"".join(text), np.uint8)

    def _trie(self) -> None:
        """Node 0 is the root, the others are the keys of ``table``; an edge's key is its node and its character's number."""
        node = {"": 0} | {prefix: k for k, prefix in enumerate(self.table, 1)}
        letters = sorted({prefix[-1] for prefix in self.table})
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        number = {c: k for k, c in enumerate(letters)}
        edges = np.array([node[p[:-1]] * len(letters) + number[p[-1]] for p in self.table], np.int64)
        order = np.argsort(edges)
        self.edges, self.child = edges[order], (order + 1).astype(np.int32)
        self.node_id = np.array([-1, *(-1 if e is None else e[0] for e in self.table.values())], np.int32)
        self.node_score = np.array([LOW, *(LOW if e is None else e[1] for e in self.table.values())])

    def _character(self, char: str) -> list[int]:
        return [self.bytes.get(b, 0) for b in char.encode()]

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation, character by character; of equal ones the longer last piece wins."""
        out: list[int] = []
        longest, end = self.longest, len(text)
        room = longest + 1
        scores = [LOW] * room  # of position p at p % room
        scores[0] = 0.0
        sizes = bytearray(longest) if longest < 256 else [0] * longest  # last pieces of the paths to base + 1, base + 2, ..
        base, reach, patience = 0, 0, 4 * longest

        def commit(upto: int) -> None:
            nonlocal base, sizes
            found, at = [], upto
            while at > base:
                size = sizes[at - base - 1]
                entry = self.scores.get(text[at - size : at])
                found.append([entry[0]] if entry else self._character(text[at - 1]))
                at -= size
            for ids in reversed(found):
                out.extend(ids)
            sizes = sizes[upto - base :]
            base = upto

        find = self.table.get
        for i in range(end):
            scores[(i + longest) % room] = LOW
            sizes.append(0)
            here, single = scores[i % room], False
            for stop in range(i + 1, min(i + longest, end) + 1):
                entry = find(text[i:stop], 0)
                if entry is None:
                    continue
                if entry == 0:
                    break
                single |= stop == i + 1
                if here + entry[1] > scores[stop % room]:
                    scores[stop % room] = here + entry[1]
                    sizes[stop - base - 1] = stop - i
                    reach = max(reach, stop)
            if not single and here + self.unknown > scores[(i + 1) % room]:
                scores[(i + 1) % room] = here + self.unknown
                sizes[i - base] = 1
                reach = max(reach, i + 1)
            if reach == i + 1:  # one position is left
                commit(reach)
                patience = 4 * longest
            elif i + 1 - base > patience:
                alive = {p for p in range(i + 1, reach + 1) if scores[p % room] > LOW}
                while len(alive) > 1 and (last := max(alive)) > base:
                    alive.remove(last)
                    alive.add(last - sizes[last - base - 1])
                if (boundary := max(alive)) > base:
                    commit(boundary)
                    patience = 4 * longest
                else:  # look again when there is twice as much, so that all looking costs a constant a character
                    patience = 2 * (i + 1 - base)
        commit(end)
        return out

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of at most KNOWN_LENGTH characters side by side: ids and each word's first."""
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-lengths, kind="stable")
        parts, counts = [], np.zeros(len(words), np.int64)
        for low in range(0, len(words), LANES):
            chosen = order[low : low + LANES]
            ids, first = self._side_by_side([words[k] for k in chosen], lengths[chosen])
            counts[chosen] = np.diff(first)
            parts.append(ids)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(counts, out=starts[1:])
        if not parts:
            return np.zeros(0, np.int32), starts
        of_order = np.cumsum(np.concatenate(([0], counts[order])))[:-1]
        back = np.empty(len(words), np.int64)
        back[order] = of_order
        return np.concatenate(parts)[_ragged(back, counts)], starts

    def _side_by_side(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``words`` in falling order of length, so that those longer than i are the first ``more[i]``."""
        lanes, width = len(words), int(lengths[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letter = np.full((width, lanes), -1, np.int64)
        lane, column = np.repeat(np.arange(lanes), lengths), _ragged(np.zeros(lanes, np.int64), lengths)
        letter[column, lane] = np.where(self.letters[place] == codes, place, -1)
        more = np.searchsorted(-lengths, -np.arange(width + 1), "left")
        room = self.longest + 1
        scores = np.full((room, lanes), LOW)
        scores[0] = 0.0
        sizes, piece = np.zeros((width + 1, lanes), np.uint8), np.full((width + 1, lanes), -1, np.int32)
        for i in range(width):
            scores[(i + self.longest) % room] = LOW
            here, now = scores[i % room], np.arange(more[i])
            node, single = np.zeros(len(now), np.int64), np.zeros(more[i], bool)
            for size in range(1, min(self.longest, width - i) + 1):
                long = np.searchsorted(now, more[i + size - 1])
                now, node = now[:long], node[:long]
                step = letter[i + size - 1][now]
                key = np.where(step < 0, -1, node * len(self.letters) + step)
                at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                found = self.edges[at] == key
                now, node = now[found], self.child[at[found]].astype(np.int64)
                if not len(now):
                    break
                ids = self.node_id[node]
                whole = ids >= 0
                at_end, ids, value = now[whole], ids[whole], here[now[whole]] + self.node_score[node[whole]]
                if size == 1:
                    single[at_end] = True
                row = scores[(i + size) % room]
                better = value > row[at_end]
                at_end = at_end[better]
                row[at_end], sizes[i + size, at_end], piece[i + size, at_end] = value[better], size, ids[better]
            alone = np.flatnonzero(~single)
            row = scores[(i + 1) % room]
            alone = alone[here[alone] + self.unknown > row[alone]]
            row[alone], sizes[i + 1, alone], piece[i + 1, alone] = here[alone] + self.unknown, 1, -1
        lane, at, taken = np.arange(lanes), lengths.copy(), []
        while len(lane):
            taken.append((lane, at, piece[at, lane]))
            at = at - sizes[at, lane]
            lane, at = lane[at > 0], at[at > 0]
        lane, at, ids = (np.concatenate(x) for x in zip(*taken))
        order = np.lexsort((at, lane))
        lane, at, ids = lane[order], at[order], ids[order]
        if (ids < 0).any():
            lost = np.flatnonzero(ids < 0)
            spelt = [self._character(words[lane[k]][at[k] - 1]) for k in lost]
            counts = np.ones(len(ids), np.int64)
            counts[lost] = [len(x) for x in spelt]
            lane, ids, first = np.repeat(lane, counts), np.repeat(ids, counts), np.cumsum(counts) - counts
            ids[_ragged(first[lost], counts[lost])] = [x for y in spelt for x in y]
        return ids.astype(np.int32), np.searchsorted(lane, np.arange(lanes + 1))

    def encode(self, text: str) -> list[int]:
        return Encoder(self).encode(pa.array([text], pa.large_string()))[0].tolist()

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of rows of ids; ``first`` holds each row's first id, and the end."""
        ids = np.where((ids >= 0) & (ids < len(self.names)), ids, len(self.names))
        lengths = np.diff(self.text_starts)[ids]
        data = self.text_bytes[_ragged(self.text_starts[ids], lengths)].tobytes()
        ends = np.concatenate(([0], np.cumsum(lengths)))[first]
        return [data[a:b].decode(errors="replace").removeprefix(" ") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


class Encoder:
    """Encodes slices of texts, remembering at most about KNOWN words."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and each text's first; a word is a run of marks and what follows up to the next one."""
        nothing, mark = (pa.scalar(x, pa.large_string()) for x in ("", SPACE))
        marked = pc.replace_substring(pc.binary_join_element_wise(nothing, texts, mark), " ", SPACE)
        marked = pc.if_else(pc.equal(texts, nothing), nothing, marked)
        offsets, data = offsets_and_bytes(marked)
        if not len(data):
            return pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
        at = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)
        begins = np.zeros(len(data) + 1, bool)
        if self.pieces.whole_words:
            runs = at[np.concatenate(([True], np.diff(at) != 3))] if len(at) else at
            begins[runs] = True
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        bounds = np.append(starts, len(data)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
        return words, np.searchsorted(starts, offsets)

    def _learn(self, words: list[str]) -> None:
        """Adds words that are not known."""
        short = [w for w in words if len(w) <= KNOWN_LENGTH]
        long = [w for w in words if len(w) > KNOWN_LENGTH]
        ids, starts = self.pieces.segment(short)
        more = [np.array(self.pieces.viterbi(w), np.int32) for w in long]
        new = np.concatenate((starts, starts[-1] + np.cumsum([len(m) for m in more], dtype=np.int64)))
        for k, word in enumerate([*short, *long], len(self.starts) - 1):
            self.known[word] = k
        self.starts = np.concatenate((self.starts, self.starts[-1] + new[1:]))
        self.ids = np.concatenate((self.ids, ids, *more))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a large_string array without nulls."""
        words, first = self._words(texts)
        if len(self.known) > KNOWN:
            self._forget()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if missing := [w for w in distinct if w not in self.known]:
            self._learn(missing)
        entry = np.array([self.known[w] for w in distinct], np.int64)[coded.indices.to_numpy()]
        lengths = np.diff(self.starts)[entry]
        flat = self.ids[_ragged(self.starts[entry], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[first]
        for word in [w for w in missing if len(w) > KNOWN_LENGTH]:
            del self.known[word]  # its ids stay until all are forgotten
        if len(self.ids) > 8 * KNOWN:
            self._forget()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def encode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ids (array<int>) and ids_crc32 (of little-endian unsigned 32-bit ids) of each whole
    text. A null or empty text has no ids. Columns of these two names are replaced, others pass; repeated rows stay and
    equal texts get equal ids. Work and memory grow with the length of a text, also where it repeats one character."""
    pieces = Pieces(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for whole in batches:
            for batch in slices(whole, text_col):
                found = encoder.encode(text_column(batch, text_col))
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate(found).astype(np.int32)
                crc = pa.array([zlib.crc32(a.astype("<u4").tobytes()) for a in found], pa.int64())
                keep = [(n, batch.column(k)) for k, n in enumerate(batch.schema.names) if n != text_col]
                yield pa.RecordBatch.from_arrays([c for _, c in keep] + [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), crc], names=[n for n, _ in keep] + ["ids", "ids_crc32"])

    kept = docs.drop("ids", "ids_crc32")
    return kept.mapInArrow(run, widened(kept.drop(text_col), ids="array<int>", ids_crc32="long"))


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the ids' text in a column decoded, which replaces one of that name; other columns pass.

    Null ids give an empty text, as do control pieces. Ids that are no piece (negative, too large, null, the unknown piece)
    and bytes that are no UTF-8 become the replacement character.
    """
    pieces = Pieces(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, DECODED_ROWS):
                batch = whole.slice(low, DECODED_ROWS)
                rows = batch.column(batch.schema.get_field_index(ids_col))
                lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
                flat = pc.fill_null(rows.flatten().cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
                texts = pieces.decode(flat, np.concatenate(([0], np.cumsum(lengths))).astype(np.int64))
                yield batch.append_column("decoded", pa.array(texts, pa.string()))

    kept = encoded.drop("decoded")
    return kept.mapInArrow(run, widened(kept, decoded="string"))
