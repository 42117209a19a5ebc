"""The corpus pipeline: documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.llm import language, lines, mixing, queries, simhash
from lumetric.session import settle

# Mean probability of the predicted language over all bytes, below which a text is in none of them.
LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; a missing language is filled in."""
    found = language.identify(docs)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)
    return found.where(known).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines of repeated three-line windows; their sizes follow."""
    found = lines.dedupe_lines(docs)
    size = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", size.cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens."""
    return queries.pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedupe_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

# A trained network, shingle hashes and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
