import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import suffixes


def plain(texts, length=200):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("collection", [20_000, 2])
def test_against_every_window(spark, monkeypatch, collection):
    monkeypatch.setattr(suffixes, "COLLECTION", collection)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60), prose(90), "ab" * 150, "licence line " * 20]
    texts = [None, "", "short", "z" * 199, "z" * 200, "y" * 201, "y" * 450]
    for _ in range(40):
        parts = [prose(rng.randint(0, 60)) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            low = rng.randint(0, 60)
            parts.insert(rng.randint(0, len(parts)), s[low : len(s) - rng.randint(0, 40)])
        texts.append(" ".join(parts))
    texts += [texts[10], texts[11], texts[11] + "!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in suffixes.report(docs).collect()}
    assert got == dict(enumerate(plain(texts)))


def hot_passage(spark, n=60, size=185):
    """Documents with one passage of under 200 bytes between words of their own; two pairs share more than that."""
    rng = random.Random(11)
    own = lambda k: "".join(rng.choice("abcdefghij ") for _ in range(k))
    passage = own(size)
    texts = [own(300) + passage + own(300) for _ in range(n)]
    texts += [own(250) + texts[0][250:520] + own(200), own(260) + texts[1][290:700]]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), texts


def test_a_row_is_asked_for_its_own_segments_only(spark, monkeypatch):
    """With a crowded anchor, no row carries the segments of the others."""
    monkeypatch.setattr(suffixes, "COLLECTION", 10)
    fetch = suffixes._fetch

    def watched(*args):
        run, cut = fetch(*args), suffixes.segments

        def checked(batches):
            def each():
                for batch in batches:
                    at = {n: batch.column(batch.schema.get_field_index(n)) for n in ("text", "wanted")}
                    for text, wanted in zip(at["text"].to_pylist(), at["wanted"].to_pylist(), strict=True):
                        assert len(wanted) <= len(text) - 199
                        own = cut(np.array([0, len(text)]), np.frombuffer(text, np.uint8), *args)[2].view(np.int64)
                        assert set(wanted) <= set(own.tolist())
                    yield batch

            return run(each())

        return checked

    monkeypatch.setattr(suffixes, "_fetch", watched)
    docs, texts = hot_passage(spark)
    assert {r[0]: tuple(r)[1:] for r in suffixes.report(docs).collect()} == dict(enumerate(plain(texts)))


def test_no_task_sorts_a_crowded_collection(spark, monkeypatch):
    """However long the shared passage is, segments of one anchor beyond ``COLLECTION`` don't meet in a task."""
    most = 10
    monkeypatch.setattr(suffixes, "COLLECTION", most)
    construct = suffixes._construct

    def watched(length):
        run = construct(length)

        def checked(batches):
            def each():
                seen = Counter()
                for batch in batches:
                    seen.update(batch.column(batch.schema.get_field_index("anchor")).to_pylist())
                    assert max(seen.values(), default=0) <= most
                    yield batch

            return run(each())

        return checked

    monkeypatch.setattr(suffixes, "_construct", watched)
    for size in (100, 185, 199):
        docs, texts = hot_passage(spark, size=size)
        assert {r[0]: tuple(r)[1:] for r in suffixes.report(docs).collect()} == dict(enumerate(plain(texts)))


def test_odd_rows(odd, none):
    rows = odd.select("doc_id", "text").collect()
    want = plain([r.text if r.doc_id != 8 else "" for r in rows])
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in suffixes.report(odd).collect() if r[0] != 8)
    assert got == sorted((str(r.doc_id), *w) for r, w in zip(rows, want, strict=True) if r.doc_id != 8)
    assert suffixes.report(none).count() == 0
    cut = suffixes.remove(odd)
    assert cut.columns == [*odd.columns, "_removed"] and cut.count() == odd.count()
    by_id = {r.doc_id: r for r in cut.collect()}
    assert by_id[2].text == "" and by_id[9].text == "" and by_id[10].text == ""
    assert suffixes.remove(none).count() == 0


def test_columns_of_any_name_pass(spark):
    names = ["doc_id", "_bytes", "text", "_spans", "_r1", "row", "id", "a.b"]
    passage = "one passage that two documents share, " * 8
    rows = [(k, b"x", t, k, k + 1, "r", None, 2.5) for k, t in enumerate([passage + "first", "second" + passage, "alone", None])]
    docs = spark.createDataFrame(rows, "doc_id long, _bytes binary, text string, _spans long, _r1 long, row string, id string, `a.b` double")
    cut = suffixes.remove(docs)
    assert cut.columns == [*names, "_removed"]
    got = sorted(map(tuple, cut.collect()))
    assert [r[:2] + r[3:8] for r in got] == [r[:2] + r[3:] for r in rows]
    assert [r[2] for r in got][2:] == ["alone", ""] and all(len(r[2]) < 200 and r[8] > 200 for r in got[:2])
