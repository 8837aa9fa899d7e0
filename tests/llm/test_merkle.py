import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle
from ledgerloom.llm.queries import op13_merkle

SCHEMA = "doc_id long, lang string, leaf string, row string, number long, block int, g string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root, and each node's siblings as (left, right) per level, climbing the whole list in memory."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run, j = nodes[i // 8 * 8 : i // 8 * 8 + 8], i % 8
            proofs[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [i // 8 for i in at]
    return nodes[0], proofs


def plain(rows):
    """Sorted (doc_id, lang, leaf, position, subroot, root, proof)."""
    groups = {}
    for doc, lang, leaf in rows:
        groups.setdefault(lang, []).append((doc is not None, doc or 0, leaf, doc))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = [(sorted(groups[g]), *tree([leaf for _, _, leaf, _ in sorted(groups[g])])) for g in langs]
    root, above = tree([sub for _, sub, _ in trees])
    return sorted(
        (str(doc), str(g), leaf, k, sub, root, tuple(proof + top))
        for g, (items, sub, proofs), top in zip(langs, trees, above) for k, ((_, _, leaf, doc), proof) in enumerate(zip(items, proofs)))


def found(frame):
    return sorted(
        (str(r.doc_id), str(r.lang), r.leaf, r.position, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof))
        for r in merkle.manifest(frame, "lang", "doc_id").collect())


def rows_of(sizes):
    return [(k, lang, h(f"{lang}{k}")) for lang, n in sizes.items() for k in range(n)]


MIXED = {"a": 513, "b": 64, "é": 65, None: 70, "": 1}


@pytest.mark.parametrize(("levels", "sizes"), [
    (1, {"a": 1}), (3, {"a": 9, None: 1}), (1, MIXED), (2, MIXED), (3, MIXED), (1, {f"g{k}": 1 + 9 * (k % 3) for k in range(70)}),
])
def test_like_one_tree_in_memory(spark, monkeypatch, levels, sizes):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rows = rows_of(sizes)
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA).repartition(5)
    assert found(frame) == plain(rows)


def test_a_hot_group_of_many_levels(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    rows = rows_of({"hot": 5000, "x": 3})
    assert found(spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)) == plain(rows)


def test_repeated_and_null_ids(spark):
    rows = [(None, "a", h("n")), (None, "a", h("m")), (5, "a", h("5")), (5, "a", h("5")), (5, "a", h("other")), (1, None, h("1"))]
    assert found(spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)) == plain(rows)


def test_clashing_columns_pass_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a", h("1"), "mine", 7, 8, "own")], SCHEMA).withColumn("position", F.lit("old"))
    out = merkle.manifest(frame, "lang", "doc_id")
    assert out.columns == ["doc_id", "lang", "leaf", "row", "number", "block", "g", "position", "subroot", "root", "proof"]
    (row,) = out.collect()
    assert (row.row, row.number, row.block, row.g, row.position) == ("mine", 7, 8, "own", 0)
    assert merkle.manifest(frame.limit(0), "lang", "doc_id").count() == 0


def test_leaf_of_odd_values(spark, odd):
    got = {(r.doc_id, r.text, r.leaf) for r in odd.select("doc_id", "text", merkle.leaf_digest(F.col("doc_id"), F.col("text")).alias("leaf")).collect()}
    told = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    assert all(leaf == h(told(doc), told(text)) for doc, text, leaf in got)


def test_tampered_texts_do_not_verify(spark):
    rows = op13_merkle(spark, "/root/testdata/sf0.001").collect()
    assert len({r.root for r in rows}) == 1 and all(r.verified == (r.folded_root == r.root) for r in rows)
    assert 0 < sum(not r.verified for r in rows) < len(rows) / 2
