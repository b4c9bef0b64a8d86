"""Bid documents: admission, budgets, and the text of a bid put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.rules import Rules

FLAG_BUDGET = (
    "Not all tender documents were read (per-run download budget reached) "
    "— review the remaining attachments manually."
)
FLAG_NO_TEXT = (
    "No tender document text could be extracted — every requirement below "
    "comes from the portal listing only."
)
FLAG_NO_DETAIL = (
    "Detail page not fetched (per-run budget reached) — "
    "figures below come from the search listing only."
)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as ``url, content, bytes``; nothing is read before it is asked for."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("url"), "content", F.col("length").alias("bytes")
    )


def admit(docs: DataFrame, rules: Rules) -> DataFrame:
    """Adds sha256 and extraction status from ``content, bytes, content_type``.

    Files of any size are read, unless the rules set ``max_document_bytes``.
    """
    most = rules.portal.get("max_document_bytes")
    too_big = F.lit(False) if most is None else F.col("bytes") > most
    known = F.col("content_type").isin(*rules.portal["document_types"])
    return docs.withColumns({
        "sha256": F.when(~too_big, F.sha2(F.col("content").cast("binary"), 256)),
        "extraction_method": F.when(too_big, "failed").when(~known, "skipped").otherwise("text"),
        "error": F.when(too_big, "download failed (see access issues)")
        .when(~known, F.concat(F.lit("unsupported content type '"), F.col("content_type"), F.lit("'")))
        .otherwise(""),
    })


def has_text(docs: DataFrame) -> DataFrame:
    """``identity_key, has_document_text``."""
    return docs.groupBy("identity_key").agg(F.bool_or(F.col("text_chars") > 0).alias("has_document_text"))


def assemble(docs: DataFrame) -> DataFrame:
    """``identity_key, doc_text``: texts in order, each under its header.

    ``docs`` is ``identity_key, pos, name, kind, text``. Parts are put together
    within each map task first, so only one partial list per task and bid moves.
    """
    part = F.concat(
        F.lit("\n===== "), F.col("name"), F.lit(" ("), F.col("kind"), F.lit(") =====\n"), F.col("text")
    )
    parts = docs.filter(F.coalesce(F.length("text"), F.lit(0)) > 0).select("identity_key", F.struct("pos", part.alias("part")).alias("p"))
    grouped = parts.groupBy("identity_key").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return grouped.select("identity_key", F.array_join(F.transform("p", lambda x: x["part"]), "\n").alias("doc_text"))


def within_budget(df: DataFrame, order: list[Column], cap: int | None = None, name: str = "in_budget") -> DataFrame:
    """Flag the first ``cap`` rows of the run order (all without a cap); the rest stay, flagged false.

    A distributed top-k finds the last row inside the budget; every row then
    compares its own place with that one row. ``order`` are columns that sort
    ascending and together are unique.
    """
    if cap is None:
        return df.withColumn(name, F.lit(True))
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    last = df.select(place.alias("_last")).orderBy("_last").limit(cap).agg(F.max("_last").alias("_last"))
    return df.crossJoin(F.broadcast(last)).withColumn(name, F.coalesce(place <= F.col("_last"), F.lit(False))).drop("_last")


def document_budget(docs: DataFrame, order: list[Column], cap: int | None = None) -> DataFrame:
    """Per bid: documents, how many are read, and whether reading stopped halfway."""
    marked = within_budget(docs, order, cap)
    per_bid = marked.groupBy("identity_key").agg(
        F.count("*").alias("documents"),
        F.count_if("in_budget").alias("documents_read"),
        F.coalesce(F.bool_or((F.col("text_chars") > 0) & F.col("in_budget")), F.lit(False)).alias("has_document_text"),
    )
    cut = (F.col("documents_read") > 0) & (F.col("documents_read") < F.col("documents"))
    return per_bid.withColumns({
        "budget_flag": F.when(cut, FLAG_BUDGET),
        "no_text_flag": F.when((F.col("documents_read") > 0) & ~F.col("has_document_text"), FLAG_NO_TEXT),
    })
