"""The queries of this folder, as (spark, folder) -> DataFrame, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.llm import (
    bpe, centroids, chat, chosen_path, language, learned_partitions, line_quality, lines, mixture, multi_index, runs, toxicity, wrappers,
)
from bidlens.llm.shared import cut, id_hash

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@lru_cache(maxsize=4)
def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(spark, bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


@query
def op1_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return learned_partitions.search(rows, rows.where("vec_id % 100 = 0"))


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), tokenizer(spark))


@query
def op3_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, folder, "embeddings"))


@query
def op4_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


@query
def op5_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = id_hash(F.col("doc_id"), 3) == 1
    net = language.fit(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), net).drop("text")


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(table(spark, folder, "documents"))


ORACLES["op6_line_dedup"] = lines.SQL


@query
def op7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.taken(table(spark, folder, "documents"))


ORACLES["op7_mixture"] = mixture.SQL


@query
def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(table(spark, folder, "conversations"))


ORACLES["op8_chat"] = chat.SQL


@query
def op9_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = cut(wrappers.wrappers(pages), "wrappers")
    return wrappers.extract(pages, found).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op10_nb_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held_out = id_hash(F.col("doc_id"), 5) == 0
    model = toxicity.fit(toxicity.labelled(docs, labels.where(~held_out)))
    out = toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op11_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held_out = id_hash(F.col("doc_id"), 5) == 0
    chain = line_quality.fit(line_quality.labelled(docs, labels.where(~held_out)))
    out = line_quality.score(docs.select("doc_id", "text", held_out.alias("held_out")), chain).drop("text")
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op13_subvectors(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


ORACLES["op13_subvectors"] = centroids.sql()
