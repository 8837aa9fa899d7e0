import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from ledgerloom.llm import sentencepieces
from ledgerloom.llm.queries import PIECES, op7_sentencepieces


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces(PIECES)


@pytest.fixture(scope="module")
def unigram():
    """The library's own search for the best sum of scores, over the same pieces."""
    model = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def plain(pieces, text):
    """Sum of scores of the best segmentation, with the whole text in memory."""
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        best[i + 1] = max(best[i + 1], best[i] + pieces.unknown) if text[i] not in pieces.scores else best[i + 1]
        for size in range(1, min(pieces.longest, len(text) - i) + 1):
            entry = pieces.scores.get(text[i : i + size])
            if entry:
                best[i + size] = max(best[i + size], best[i] + entry[1])
    return best[-1]


def test_best_sum(pieces):
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("abcderst  ▁.,1é東\u0001") for _ in range(rng.randint(1, 300)))
        marked = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)
        ids = pieces.encode(text)
        got, k = 0.0, 0
        while k < len(ids):
            if ids[k] in pieces.byte_of:
                first = pieces.byte_of[ids[k]]
                k += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                got += pieces.unknown
            else:
                got += pieces.scores[pieces.names[ids[k]]][1]
                k += 1
        assert got == plain(pieces, marked)
        assert list(pieces.encode(text)) == pieces.viterbi(marked)


def test_same_as_library(pieces, unigram):
    for text in ["Hello world", "  two  spaces ", "naïve café", "The quick brown fox.\nJumps"]:
        assert list(pieces.encode(text)) == unigram.encode(text)


def test_odd_rows(spark, odd, none):
    encoded = sentencepieces.encode(odd, PIECES)
    assert encoded.columns == [c for c in odd.columns if c != "text"] + ["ids", "ids_crc32"]
    want = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert sorted((str(r.doc_id), r.decoded) for r in sentencepieces.decode(encoded, PIECES).collect()) == want
    assert sentencepieces.decode(sentencepieces.encode(none, PIECES), PIECES).count() == 0


def test_repeated_characters_take_time_in_proportion(pieces):
    """A line of one character is one word: no list that is gone through at every character."""
    for char in "a-é東 \u0001":
        seconds = []
        for n in (20_000, 80_000):
            started = time.process_time()
            ids = pieces.encode(char * n)
            seconds.append(time.process_time() - started)
            (back,) = pieces.decode(np.array(ids), np.array([0, len(ids)]))
            assert back == char * n
        assert seconds[1] < 12 * max(seconds[0], 0.05)


def test_words_side_by_side_are_like_alone(pieces):
    rng = random.Random(9)
    words = ["".join(rng.choice("▁abcdeé東\U0001f600\u0001the-") for _ in range(rng.randint(1, sentencepieces.KNOWN_LENGTH))) for _ in range(3000)]
    ids, first = pieces.segment(words)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [pieces.viterbi(w) for w in words]
    assert [len(x) for x in pieces.segment([])] == [0, 1]


def test_forgetting_words(pieces, monkeypatch):
    monkeypatch.setattr(sentencepieces, "KNOWN", 3)
    encoder = sentencepieces.Encoder(pieces)
    texts = ["one two three four five", "six " + "x" * 70, "", " ", "one six"] * 3
    for text in texts:
        (got,) = encoder.encode(pa.array([text], pa.large_string()))
        assert got.tolist() == (pieces.viterbi(sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)) if text else [])


def test_ids_that_are_no_pieces(spark):
    ids = [None, [], [None], [-1], [40_000, 2**31 - 1], [0], [1, 2]]
    frame = spark.createDataFrame([(k, x, "old") for k, x in enumerate(ids)], "k int, ids array<int>, decoded string")
    got = [r.decoded for r in sentencepieces.decode(frame, PIECES).orderBy("k").collect()]
    assert got == ["", "", "�", "�", "��", "�", ""]


def test_query_is_like_a_plain_search(spark, pieces):
    """The whole query on sf0.001 against the search with the whole text in memory, by sum of scores, and round trips."""
    rows = {r.doc_id: r for r in op7_sentencepieces(spark, "/root/testdata/sf0.001").collect()}
    for doc in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = pieces.encode(doc.text or "")
        assert rows[doc.doc_id].n_ids == len(ids) and rows[doc.doc_id].round_trip
        assert rows[doc.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        marked = sentencepieces.SPACE + (doc.text or "").replace(" ", sentencepieces.SPACE)
        if len(marked) < 3000 and not set(ids) & set(pieces.byte_of):
            assert sum(pieces.scores[pieces.names[i]][1] for i in ids) == (plain(pieces, marked) if doc.text else 0)
