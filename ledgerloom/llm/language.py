"""Language identification by rank-order profiles.

Letters are lower-cased, everything else is a blank, and every word is padded with one blank on each side. A profile is
the ``TOP`` most frequent n-grams of 1 to 3 characters, the commonest first. A document's own profile is compared with
each language's by the out-of-place distance: the sum over the document's n-grams of the difference between both ranks,
or ``TOP`` where the language's profile lacks the n-gram. The nearest language wins.

Profiles are counted over all learning rows: counts are summed inside tasks before their shuffle, and only
``TOP`` rows a language come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import mix64, slices, text_column
from ledgerloom.llm.shared import widened

#: N-grams in a profile, and the distance of one that is missing.
TOP = 300
UNKNOWN = "und"
#: An n-gram is known by so many bits of its hash.
_BITS = 40
_COMPACT = 1 << 21


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every n-gram of every text; blanks alone are none."""
    lowered = [t.lower() for t in texts]
    data = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered)))
    owner = np.repeat(np.arange(len(lowered), dtype=np.uint32), np.diff(ends, prepend=0))
    owner = np.concatenate((owner[:1], owner))
    letter = letters[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    code, owner, letter = np.where(letter, data, np.uint32(32))[keep].astype(np.uint64), owner[keep], letter[keep]
    pair = code[:-1] | code[1:] << np.uint64(21)
    triple = pair[:-1] | code[2:] << np.uint64(42)
    inside = letter[1:-1]  # a triple with a blank in the middle spans two words
    hashes = [mix64(code[letter]), mix64(pair[letter[:-1] | letter[1:]] ^ np.uint64(1 << 62)), mix64(triple[inside] ^ np.uint64(1 << 63))]
    # a pair or triple that starts at the blank before a word belongs to that word's text, which its second place tells
    return np.concatenate((owner[letter], owner[1:][letter[:-1] | letter[1:]], owner[1:-1][inside])), np.concatenate(hashes)


def _counted(group: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, n-gram) and their counts, by group."""
    keys = np.sort(group.astype(np.uint64) << np.uint64(_BITS) | hashes >> np.uint64(64 - _BITS))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> np.uint64(_BITS)).astype(np.int64), (keys & np.uint64((1 << _BITS) - 1)).astype(np.int64), counts


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, names, held = _letters(), {}, []

    def compact() -> list[np.ndarray]:
        group, gram, count = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((gram, group))
        group, gram, count = group[order], gram[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (gram[1:] != gram[:-1]))))
        return [group[first], gram[first], np.add.reduceat(count, first)]

    for whole in batches:
        for batch in slices(whole, "text"):
            langs = batch.column(1).to_pylist()
            owner, hashes = _grams(text_column(batch, "text").to_pylist(), letters)
            ids = np.array([names.setdefault(x, len(names)) for x in langs])
            held.append(_counted(ids[owner], hashes))
            if sum(len(x[0]) for x in held) > _COMPACT:
                held = [compact()]
    if held:
        group, gram, count = compact()
        known = pa.array(list(names))
        yield pa.RecordBatch.from_arrays([known.take(pa.array(group)), pa.array(gram), pa.array(count)], names=["lang", "gram", "n"])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> dict[str, list[int]]:
    """The profile of every non-null ``lang_col`` value: its ``top`` n-grams, the commonest first.

    Ties go to the smaller hash. Rows with a null text or language teach nothing, repeated rows count as often as they
    occur, a language without a letter has no profile, and an empty table teaches none. Long texts are counted whole.
    The profiles come to the driver: ``top`` numbers a language.
    """
    picked = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = picked.dropna().mapInArrow(_count_grams, "lang string, gram long, n long")
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(by_count))
    profiles: dict[str, list[int]] = {}
    for row in ranked.filter(F.col("place") <= top).orderBy("lang", "place").toLocalIterator():
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


def _judge(profiles: dict[str, list[int]], top: int):
    """Judges a slice of texts language by language: what it holds grows with the profiles and the slice, not with both."""
    names = sorted(profiles)
    grams = np.unique(np.concatenate([np.array(profiles[x], np.int64) for x in names] or [np.zeros(0, np.int64)]))
    columns = [np.searchsorted(grams, profiles[x]).astype(np.int32) for x in names]

    def judged(texts: list[str], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        owner, gram, count = _counted(*_grams(texts, letters))
        order = np.lexsort((gram, -count, owner))
        owner, gram = owner[order], gram[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(texts)))[owner]
        owner, gram, place = (x[place < top] for x in (owner, gram, place))
        n = np.bincount(owner, minlength=len(texts))
        at = np.minimum(np.searchsorted(grams, gram), max(len(grams) - 1, 0))
        at = np.where(grams[at] == gram, at, len(grams)) if len(grams) else at
        places = np.full(len(grams) + 1, -1, np.int64)  # of one language at a time
        least, best = np.full(len(texts), np.inf), np.zeros(len(texts), np.int64)
        for k, column in enumerate(columns):
            places[column] = np.arange(len(column))
            own = places[at]
            total = np.bincount(owner, np.where(own >= 0, np.abs(own - place), top), len(texts))
            best[total < least] = k
            least = np.minimum(least, total)
            places[column] = -1
        if not names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        score = 1 - least / np.maximum(n * top, 1)
        return [names[k] if m else UNKNOWN for k, m in zip(best, n, strict=True)], np.where(n > 0, np.clip(score, 0, 1), 0.0)

    return judged


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", top: int = TOP) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1: 1 less the distance as a share of its most); the text's column alone
    decides. Columns of these two names are replaced.

    A null, empty or letterless text is ``und`` with score 0, and so is every text if there are no profiles. Ties go to
    the language that sorts first; equal texts get equal results; an empty table gives an empty result. Texts of any
    length are judged whole, a very long one by itself.
    """
    judged = _judge(profiles, top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for whole in batches:
            for batch in slices(whole, text_col):
                names, score = judged(text_column(batch, text_col).to_pylist(), letters)
                rest = [(n, batch.column(k)) for k, n in enumerate(batch.schema.names) if n not in ("lang_pred", "score")]
                yield pa.RecordBatch.from_arrays([x for _, x in rest] + [pa.array(names), pa.array(score)], names=[n for n, _ in rest] + ["lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    return kept.mapInArrow(run, widened(kept, lang_pred="string", score="double"))
