import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.queries import TOKENIZER


def check_places(rows, room=packing.ROOM):
    """Without gaps from 0, no sequence over the room; the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= room
    return len(by)


def test_odd_rows(odd, none):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = packing.pack_documents(odd, TOKENIZER, with_ids=True).collect()
    want = []
    for r in odd.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        want += [(str(r.doc_id), k // 4096, k, len(p := ids[k : k + 4096]), zlib.crc32(p.tobytes()), p.tolist()) for k in range(0, len(ids), 4096)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got) == sorted(want)
    assert check_places(got) == -(-sum(w[3] for w in want) // 4096)
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_sequences_hold_their_tokens(spark, odd):
    """The pipeline's last stage and the query give the tokens themselves, and a digest of those that come out."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    sequences = corpus_pipeline.pack_sequences(spark, odd, "").collect()
    assert check_places(sequences) >= 1 and all(len(r.ids) == r.length for r in sequences)
    whole = {}
    for r in sorted(sequences, key=lambda r: r.start):
        whole.setdefault(str(r.doc_id), []).extend(r.ids)
    for r in odd.filter("doc_id <> 9 or doc_id is null").collect():
        assert whole[str(r.doc_id)] == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID]
    digests = sorted((str(r.doc_id), r.piece, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in sequences)
    assert sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in packing.packing_report(odd, TOKENIZER).collect()) == digests
    other = spark.createDataFrame([(1, 0, bytearray(b"\x07\x00\x00\x00"))], "doc_id long, ids_crc32 long, ids binary")
    assert packing.with_crc_of_ids(other).first().ids_crc32 == zlib.crc32(b"\x07\x00\x00\x00")


@pytest.mark.parametrize("text", ["It's DON'T we'LL", "İstanbul ΑΣ σας ﬁ K ª º µ", "a\u0301 A\u030a e\u0301\u0301 .\u0338", "x1y2 ...!!! (a)b-c", "\x1c\x85\xa0\u3000 é,É;ß", "<|startoftext|> <|ENDOFTEXT|>", "𝕏 \u200b z"])
def test_same_ids(spark, text):
    want = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    got = packing.pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), TOKENIZER, with_ids=True).first()
    assert got.ids == [*want, packing.END_ID]


def test_rounds_fill_up(spark):
    """Partitions of long pieces only and of short ones only meet in the later rounds."""
    rng = np.random.default_rng(5)
    long, short = rng.integers(2100, 3000, 900), rng.integers(5, 1900, 900)
    frames = [spark.createDataFrame([(int(x),) for x in part], "length long") for part in np.array_split(np.concatenate((long, short)), 20)]
    items = frames[0]
    for f in frames[1:]:
        items = items.unionByName(f)
    got = packing.pack(items).collect()
    assert len(got) == 1800
    assert check_places(got) <= 1.03 * max(900, (long.sum() + short.sum()) / 4096)


def test_words_of_equal_polynomial_hash(spark):
    """Thue-Morse words and their complements agree in every polynomial hash modulo a power of two."""
    tokenizer, word = Tokenizer.from_file(TOKENIZER), "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word[:n] for n in (1024, 2048)] + [word[:n].translate(str.maketrans("ab", "ba")) for n in (1024, 2048)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    for r in packing.pieces(frame, TOKENIZER, with_ids=True).collect():
        assert r.ids == [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, packing.END_ID]


def test_bins_that_do_not_fit_together_end_the_rounds(spark, monkeypatch):
    """Large pieces leave one open bin each; tasks take a bounded number, and small pieces still find their places."""
    monkeypatch.setattr(packing, "ITEMS", 500)
    rng = np.random.default_rng(6)
    sizes = np.concatenate((rng.integers(2100, 4080, 4000), rng.integers(10, 1500, 1500)))
    got = packing.pack(spark.createDataFrame([(int(x),) for x in sizes], "length long").coalesce(3)).collect()
    assert len(got) == len(sizes)
    assert check_places(got) <= 1.01 * max(4000, sizes.sum() / 4096)


def test_columns_of_any_name_pass(spark):
    names = ["bin", "place", "filled", "row", "size", "root", "shift", "parent", "sequence_id"]
    frame = spark.createDataFrame([(5, *[f"{n}{k}" for n in names]) for k in range(3)], "length int, " + ", ".join(f"{n} string" for n in names))
    got = packing.pack(frame)
    assert got.columns == ["length", *names[:-1], "sequence_id", "offset"]
    assert sorted((r.bin, r["size"], r.parent) for r in got.collect()) == [(f"bin{k}", f"size{k}", f"parent{k}") for k in range(3)]
    assert packing.pack(frame.limit(0)).count() == 0
    for bad in ("0", "4097", "null"):
        with pytest.raises(Exception, match="a length must be"):
            packing.pack(spark.sql(f"select cast({bad} as int) as length")).count()


def test_distinct_words_are_encoded_together():
    """The tokenizer is called for many new words at once, whatever signs and digits stand beside them."""
    rng = np.random.default_rng(7)
    words = sorted({"".join(rng.choice(list("abcdefgéß"), 9)) for _ in range(4000)})
    text = " ".join(form.format(w) for w, form in zip(words, ["{}", "({}", "{},", "a|{}", "{}7", "-{}.x"] * len(words)))
    vocabulary, given = packing.Vocabulary(TOKENIZER), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **more):
            given.extend(texts)
            return self.inner.encode_batch_fast(texts, **more)

    for name, value in list(vars(vocabulary).items()):
        if isinstance(value, Tokenizer):
            setattr(vocabulary, name, Counted(value))
    tokens, bounds = packing.encode(pa.array([text], pa.large_string()), vocabulary)
    assert tokens.tolist() == Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    assert bounds.tolist() == [0, len(tokens)]
    assert 0 < len(given) < len(words) / 50


def test_ids_of_any_mixture(monkeypatch):
    """Letters, signs, digits, apostrophes, marks and other scripts side by side, while parts are forgotten and learned again."""
    monkeypatch.setattr(packing, "KNOWN", 40)
    rng, tokenizer, vocabulary = np.random.default_rng(8), Tokenizer.from_file(TOKENIZER), packing.Vocabulary(TOKENIZER)
    pool = [*"aabbzAZéÉßÞÿ×÷0129 \t\n.,!?*%&$#|;:-()\"/'@=+<>^~_", "'s", "'LL", "\u0301", "\u0338", "\xa0", "\x1c", "µ", "Ā", "ж", "東", "ﬁ", "😀", "the ", "It's ", "<|endoftext|>"]
    weights = np.ones(len(pool))
    weights[-1] = 0.02
    for size in (0, 1, 3, 12, 60):
        texts = ["".join(rng.choice(pool, size, p=weights / weights.sum())) for _ in range(250)]
        tokens, bounds = packing.encode(pa.array(texts, pa.large_string()), vocabulary)
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            assert tokens[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert len(packing.encode(pa.array([], pa.large_string()), vocabulary)[1]) == 1
