"""Each stage against a plain version of itself, on what the stage before kept."""

import hashlib

import corpus_pipeline
from ledgerloom.llm import language, quality
from ledgerloom.llm.queries import held_out

from test_packing import check_places
from test_simhash import plain_classes, plain_fingerprint
from test_suffixes import plain

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_set(df):
    return {tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, names = {"documents": docs}, ["documents"]
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stage(spark, kept[names[-1]], SF).cache()
        names.append(name)
    assert names[1:] == ["quality", "language", "near_duplicates", "repeated_passages", "packing"]
    assert all(kept[n].columns == docs.columns for n in names[1:-1])

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(docs, labels.filter(~held_out()))
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted == 1}
    assert as_set(kept["quality"]) == {r for r in as_set(docs) if r[0] in good}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    wrong = sum((d in good) != (q == 1) for d, q in marks.items())
    assert wrong <= 0.05 * len(marks)

    profiles = language.learn(kept["quality"].filter(~held_out()))
    known = {r.doc_id for r in language.identify(kept["quality"], profiles).collect() if r.lang_pred != "und" and r.score >= 0.2}
    assert as_set(kept["language"]) == {r for r in as_set(kept["quality"]) if r[0] in known}

    rows = as_set(kept["language"])
    fingerprint = {r[0]: plain_fingerprint(r[1]) for r in rows}
    root = plain_classes(fingerprint.values())
    least = {}
    for ident, f in fingerprint.items():
        least[root[f]] = min(ident, least.get(root[f], ident))
    assert as_set(kept["near_duplicates"]) == {r for r in rows if r[0] in least.values()}

    rows = sorted(as_set(kept["near_duplicates"]))
    cut = {r.doc_id: r for r in kept["repeated_passages"].collect()}
    assert set(cut) == {r[0] for r in rows}
    for row, (size, gone, _, digest) in zip(rows, plain([r[1] for r in rows]), strict=True):
        text = cut[row[0]].text
        assert cut[row[0]].n_chars == len(text)
        if hashlib.sha256(text.encode()).hexdigest() != digest:  # a cut ran through a character
            assert gone and size - gone - 3 * gone < len(text.encode()) < size - gone

    packed = kept["packing"].collect()
    assert {r.doc_id for r in packed} == set(cut)
    assert check_places(packed) <= 1.05 * sum(r.length for r in packed) / 4096 + 1
    ran = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in ran) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_odd_rows_pass_every_stage(spark, odd, none):
    for docs in (odd.select(*COLUMNS), none.select(*COLUMNS)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= max(docs.count(), 200)
    assert corpus_pipeline.STAGES[2][1](spark, odd, SF).columns == odd.columns
