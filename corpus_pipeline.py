"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bidlens.llm import bpe, chosen_path, language, lines, mixture
from bidlens.llm.queries import tokenizer
from bidlens.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: Less than this probability for the likeliest language is no language.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without text or letters go.

    The network learns from a bounded sample of the documents with a language;
    if there is none, nothing can be told and all documents stay.
    """
    docs = docs.select(*COLUMNS)
    net = language.fit(docs)
    if net is None:
        return docs
    out = language.identify(docs, net, lang="_found", score="_score")
    return out.where(f"_found <> '{language.UNKNOWN}' AND _score >= {LEAST_SCORE}").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars is counted anew."""
    out = lines.drop_repeated_lines(docs.select(*COLUMNS))
    return out.selectExpr("doc_id", "kept AS text", "lang", "source", "CAST(char_length(kept) AS BIGINT) AS n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    docs = docs.select(*COLUMNS)
    gone = chosen_path.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixture.mix(docs.select(*COLUMNS))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digest of what they decode to."""
    out = bpe.round_trip(docs.select(*COLUMNS), tokenizer(spark))
    return out.selectExpr("doc_id", "source", "lang", "ids", "CAST(size(ids) AS BIGINT) AS n_tokens", "sha2(decoded, 256) AS decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("byte_bpe", encoding),
]
#: Language ID, MinHash links and BPE have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
