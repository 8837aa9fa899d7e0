import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(marks):
    """The smallest mark that each one reaches."""
    marks = sorted(set(marks))
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for i, a in enumerate(marks):
        for b in marks[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {m: find(m) for m in marks}


def test_odd_rows(odd, none):
    rows = odd.select("doc_id", "text").collect()
    marks = {(r.doc_id, r.text): plain_fingerprint(r.text) for r in rows}
    root = plain_classes(marks.values())
    least = {}
    for (ident, _), m in marks.items():
        if ident is not None:
            least[root[m]] = min(ident, least.get(root[m], ident))
    got = simhash.near_duplicates(odd).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == sorted(
        (str(r.doc_id), f"{marks[r.doc_id, r.text]:016x}", str(least.get(root[marks[r.doc_id, r.text]]))) for r in rows
    )
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(root.values()))
    assert simhash.keep_one(none).count() == 0


def test_links_are_complete(spark, monkeypatch):
    """Crowds around few centres, so that keys are refined to the last level."""
    monkeypatch.setattr(simhash, "BUCKET", 4)
    rng = random.Random(7)
    marks = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            marks.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    for _ in range(200):
        marks.add(rng.getrandbits(64))
    signed = np.array(sorted(marks), np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(m,) for m in signed], "fingerprint long"))
    joined = {r.node: r.root for r in components(edges).collect()}
    want = plain_classes(marks)
    groups = {}
    for m in signed:
        groups.setdefault(joined.get(m, m), set()).add(m & (1 << 64) - 1)
    plain = {}
    for m, root in want.items():
        plain.setdefault(root, set()).add(m)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1000)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {k: 0 for k in range(301)}


def test_a_hub_is_split(spark):
    """Edges of one node are dealt to several tasks in the joins of a round."""
    from ledgerloom.llm import components

    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        star = spark.range(1, 30_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
        joined = components._with_least(star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        assert joined.filter("least = 0").count() == 30_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert components.components(star).filter("root = 0").count() == 30_001
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
