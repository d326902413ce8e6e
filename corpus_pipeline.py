"""A corpus pipeline out of the training-data operators: every stage takes documents and hands on what it keeps.

The first four stages return the columns of documents. Rows are known by their id and a hash of their text, so rows that
share an id with others do not share their fate; rows alike in both are repeats, of which exact dedup leaves one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, bitmap, possible
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.langid import accept, train
from tidemark.llm.packing import best_fit_packing
from tidemark.llm.queries import tokenizer
from tidemark.llm.secrets import redact
from tidemark.llm.simhash import near_duplicates

CACHED = 100_000  # a quarter of the encoder's own: here its worker shares an executor with what earlier stages leave in memory
LEAST_SCORE = 0.5  # calibrated probability of the language; below it a document is rejected


def _stay(spark: SparkSession, docs: DataFrame, groups: DataFrame) -> DataFrame:
    """groups(doc_id, text_hash, stays): the rows of all groups of more than one. Rows of docs in none of them stay, and a
    bitmap of the groups' text hashes leaves their texts where they are; the others are joined by id and text hash, and of
    those that repeat in both one stays."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    own = groups.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "stays").distinct()
    own = Scratch(spark, "stay").table(own, "groups")
    marks = bitmap(own.select("own_hash"))
    near = rows.where(possible(spark, marks, F.col("hash"))).join(own.hint("merge"), F.col("id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash")), "left")
    near = near.where("stays IS NULL OR stays").dropDuplicates(["id", "hash"])
    far = rows.where(~possible(spark, marks, F.col("hash")))
    return near.select("row.*").unionByName(far.select("row.*"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter in the text, or no language likelier than not."""
    return accept(docs, train(docs), LEAST_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of those whose texts differ in white space at most."""
    return _stay(spark, docs, exact_dedup(docs).where("group_size > 1"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document, that of the smallest id, of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return _stay(spark, docs, near_duplicates(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets masked and n_chars counted anew."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in training sequences."""
    return best_fit_packing(docs, tokenizer("byte_bpe_50k.json"), cached=CACHED)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near), ("secret_scan", secrets), ("best_fit_packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
