"""The corpus operators as queries over whole tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lumetric.llm
from lumetric.llm import bitslice, hashing, infill, language, lines, mixing, packing, personal, ppm, simhash, spelling, tokens, toxicity
from lumetric.llm.common import read_table
from lumetric.session import scratch_path

# Workers get the functions of this package with the task, wherever they run.
cloudpickle.register_pickle_by_value(lumetric.llm)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_store(spark, sf_dir):
    path = scratch_path(spark, "token-store")
    tokens.write_store(
        read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    found = tokens.read_store(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_multi_index(spark, sf_dir):
    return hashing.search(read_table(spark, sf_dir, "embeddings"))


@query
def op3_personal_data(spark, sf_dir):
    return personal.report(personal.find(read_table(spark, sf_dir, "documents")))


@query
def op4_line_windows(spark, sf_dir):
    found = lines.dedupe_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "lines_removed")


ORACLES["op4_line_windows"] = lines.ORACLE


@query
def op5_pareto_mix(spark, sf_dir):
    found = mixing.mix(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op5_pareto_mix"] = mixing.ORACLE


@query
def op6_simhash_vantage(spark, sf_dir):
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@query
def op7_toxicity_neighbours(spark, sf_dir):
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op8_bit_sliced(spark, sf_dir):
    return bitslice.search(read_table(spark, sf_dir, "embeddings"))


ORACLES["op8_bit_sliced"] = bitslice.ORACLE


@query
def op9_byte_gru(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    languages, params = language.fit(docs)
    rows = docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language.predict(rows, languages, params).drop("text")


@query
def op10_best_fit_packing(spark, sf_dir):
    return pack_documents(read_table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces = packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(digests)


@query
def op11_partial_matching(spark, sf_dir):
    return ppm.score(read_table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(read_table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark, sf_dir):
    return infill.report(infill.transform(read_table(spark, sf_dir, "documents")))


ORACLES["op13_fill_in_middle"] = infill.ORACLE
