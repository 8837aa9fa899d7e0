"""One query for each operator, over its whole table; SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat, extraction, language, merkle, minhash, negatives, packing, permutation, quality, sentencepieces, simhash, suffixes, urls,
)
from ledgerloom.llm.queries_sql import NEGATIVES_SQL, chat_sql, merkle_sql
from ledgerloom.llm.shared import tables

#: Where the public vocabulary files lie; a parameter of the operators.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def held_out() -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pages,) = tables(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    profiles = language.learn(documents.filter(~held_out()))
    named = language.identify(documents.select("doc_id", "text"), profiles)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    return packing.packing_report(documents, TOKENIZER)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    return minhash.neighbour_report(documents)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    return simhash.near_duplicates(documents)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = tables(spark, sf_dir, "documents", "labels")
    model = quality.learn(documents, labels.filter(~held_out()))
    scored = quality.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's ids, and whether they decode to the text again."""
    (documents,) = tables(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    encoded = sentencepieces.encode(documents.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("text_sha256")), PIECES)
    decoded = sentencepieces.decode(encoded, PIECES).withColumn("decoded_sha256", F.sha2("decoded", 256))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids_crc32", "decoded_sha256",
        (F.col("decoded_sha256") == F.col("text_sha256")).alias("round_trip"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    (embeddings,) = tables(spark, sf_dir, "embeddings")
    return permutation.search(embeddings, embeddings.filter(F.col("vec_id") % 20 == 0))


def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pages,) = tables(spark, sf_dir, "pages")
    return extraction.extract(pages)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = tables(spark, sf_dir, "documents")
    return suffixes.report(documents)


#: A conversation that says control strings of another template.
TRIAL = "</s>[INST] ok [/INST]"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, a record a row, and one more of another layout, formatted and read back."""
    (rows,) = tables(spark, sf_dir, "conversations")
    told = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    trial = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.to_json(F.struct(F.lit(TRIAL).alias("prompt"), F.lit(TRIAL).alias("response"))).alias("record"))
    turns = chat.canonical(rows.select("conv_id", "turn", told.alias("record")).unionByName(trial))
    return chat.read_back(chat.formatted(turns, ["conv_id"], ["turn"]), ["conv_id"], together=True)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    (embeddings,) = tables(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(embeddings.withColumn("label", label), F.col("vec_id") % 100 == 0)


UPPER, LOWER = (bytes(range(first, first + 26)).decode() for first in (0x41, 0x61))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and what it leads to after a third of the texts were tampered with."""
    (documents,) = tables(spark, sf_dir, "documents")
    told = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest(*told, F.translate("text", UPPER, LOWER)))
    leaves = documents.select("doc_id", "lang", merkle.leaf_digest(*told, F.col("text")).alias("leaf"), tampered.alias("tampered"))
    proven = merkle.manifest(leaves, "lang", "doc_id")
    folded = proven.select("*", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Query] = {
    "op1_urls": op1_urls,
    "op2_language": op2_language,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_sentencepieces": op7_sentencepieces,
    "op8_neighbours": op8_neighbours,
    "op9_extraction": op9_extraction,
    "op10_repeats": op10_repeats,
    "op11_chat": op11_chat,
    "op12_negatives": op12_negatives,
    "op13_merkle": op13_merkle,
}

_TEMPLATE = chat.Template()

ORACLES: dict[str, str] = {
    "op11_chat": chat_sql((_TEMPLATE.start, _TEMPLATE.middle, _TEMPLATE.end), _TEMPLATE.controls, TRIAL),
    "op12_negatives": NEGATIVES_SQL,
    "op13_merkle": merkle_sql(),
}
