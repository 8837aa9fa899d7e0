"""From raw documents to packed training sequences: five stages, each written as Parquet before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language, packing, quality, simhash, suffixes
from ledgerloom.llm.queries import TOKENIZER, held_out
from ledgerloom.llm.shared import tables, written

#: A text whose letters are so far from every known language is none of them.
LEAST_LANGUAGE_SCORE = 0.2


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labelled ones among them, held-out rows excepted."""
    (labels,) = tables(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.filter(~held_out()))
    return quality.score(docs, model).filter("predicted = 1").select(*docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of a language that some document is marked with."""
    profiles = language.learn(docs.filter(~held_out()))
    named = language.identify(docs, profiles)
    return named.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that come elsewhere too; n_chars follows the text."""
    return suffixes.remove(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their ids, sequence and place."""
    return packing.pack_documents(docs, TOKENIZER, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: The stages are models, graphs and a packing: SQL cannot state their rows. The tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
