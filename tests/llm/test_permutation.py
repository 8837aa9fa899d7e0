import numpy as np
import pytest

from ledgerloom.llm import permutation

SF = "/root/testdata/sf0.01"


def plain(rows, k=20):
    """{query id: [(id, score)]} by the inner product with all."""
    ids = np.array(sorted(rows))
    matrix = np.array([rows[i] for i in ids], float)
    out = {}
    for i in ids[ids % 20 == 0]:
        score = (matrix * np.array(rows[i], float)).sum(axis=1)
        order = [o for o in np.lexsort((ids, -score)) if ids[o] != i][:k]
        out[int(i)] = [(int(ids[o]), float(score[o])) for o in order]
    return out


def found(frame, k=20):
    out = {}
    for r in permutation.search(frame, frame.filter("vec_id % 20 = 0"), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in w}) / max(len(w), 1) for q, w in want.items()])


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK_VECTORS", 200)
    monkeypatch.setattr(permutation, "RERANK_LEAST", 30)
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = plain({r.vec_id: r.embedding for r in frame.collect()})
    got = found(frame)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("copies", [1, 60])
def test_copies_and_unusable_vectors(spark, copies):
    rng = np.random.default_rng(2)
    rows = {k: rng.normal(size=8).astype(np.float32).tolist() for k in range(100)}
    rows |= {1000 + k: rows[0] for k in range(copies)}
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] + [1.0] * 7), (2080, [float("inf")] * 8), (2101, [1.0] * 3), (None, [1.0] * 8), (2120, [])]
    frame = spark.createDataFrame([*rows.items(), *bad], "vec_id long, embedding array<float>")
    got = found(frame)
    want = plain(rows)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def whole(rows, k):
    """Sorted [(query id, rank, id, score)] over a list of rows, each of which asks for itself."""
    out = []
    for n, (i, v) in enumerate(rows):
        if i is not None and i % 20 == 0:
            others = [(-float(np.dot(v, w)), j) for m, (j, w) in enumerate(rows) if m != n and len(w) == len(v)]
            out += [(i, r, j, -loss) for r, (loss, j) in enumerate(sorted(others)[:k], 1)]
    return sorted(out)


def test_rows_that_share_an_id_and_lengths(spark, monkeypatch):
    rng = np.random.default_rng(4)
    some = [(int(n), rng.integers(-4, 5, size=int(d)).tolist() or [1]) for n, d in zip(rng.integers(0, 45, 160), rng.choice([3, 3, 3, 5], 160), strict=True)]
    rows = [(i, [float(x) for x in v]) for i, v in some if any(v)]
    rows += rows[:9] + [(20, rows[0][1]), (0, rows[0][1])] + [(40, [1.0, 2.0, 3.0])] * 30 + [(1, [0.9, 0.1]), (1, [0.0, 1.0]), (60, [1.0, 0.0])]
    monkeypatch.setattr(permutation, "BLOCK_VECTORS", 40)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation.search(frame.repartition(5), frame.filter("vec_id % 20 = 0"), 6)
    assert sorted(map(tuple, got.collect())) == whole(rows, 6)
    monkeypatch.setattr(permutation, "PIVOT_SAMPLE", 1)
    assert sorted(map(tuple, permutation.search(frame, frame.filter("vec_id % 20 = 0"), 6).collect())) == whole(rows, 6)


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert {q: [v for v, _ in x] for q, x in found(frame).items()} == {0: [3, 20], 20: [3, 0]}
    assert found(frame.limit(0)) == {}
