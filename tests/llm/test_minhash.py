import hashlib
import re

import numpy as np

from ledgerloom.llm import minhash


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_neighbours(odd, none):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {}
    for r in minhash.neighbour_report(odd).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for k, (ident, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        digests = [r.edited_sha256 for r in got[ident]]
        assert hashlib.sha256(edited.encode()).hexdigest() in digests
        for r in got[ident]:
            assert r.n_chars == len(text)
            if len(got[ident]) == 1:
                a, b = shingles(text), shingles(edited)
                assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.2
    assert got[0][0].fingerprint == got[1][0].fingerprint != got[12][0].fingerprint
    assert got[2][0].fingerprint == got[3][0].fingerprint == got[4][0].fingerprint == ""
    assert minhash.neighbour_report(none).count() == 0
    assert minhash.fingerprints(odd).count() == len(rows)


def test_likeness_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(150):
        n, shared = int(rng.integers(3, 400)), float(rng.random())
        common = rng.integers(0, 1 << 40, int(n * shared))
        texts = [" ".join(f"w{x}" for x in np.concatenate((common, rng.integers(0, 1 << 40, n - len(common))))) for _ in range(2)]
        sets = [shingles(t) for t in texts]
        (low, some) = minhash._marks(texts)
        estimate = minhash.likeness(low[:1], some[:1], low[1:], some[1:])[0]
        errors.append(estimate - len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_single_row(spark):
    (r,) = minhash.neighbour_report(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1.0


def test_rows_of_one_id_are_spread_and_keep_their_order(spark, monkeypatch):
    rows = [(None if k % 3 else k, f"{k % 1500:05d} some words of row {k}") for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen, plain_written = [], minhash.written
    monkeypatch.setattr(minhash, "written", lambda df, name: seen.append(plain_written(df, name)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        got = sorted(r.edited_sha256 for r in minhash.neighbour_report(frame).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ordered = [t for _, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))]
    want = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(ordered, ordered[1:] + ordered[:1], strict=True)]
    assert got == sorted(hashlib.sha256(t.encode()).hexdigest() for t in want)
    unnamed = seen[0].filter("edge = 'first' and id is null").count()
    assert unnamed >= 3  # several tasks begin inside the rows without an id
