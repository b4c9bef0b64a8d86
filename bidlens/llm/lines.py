"""Dedup of lines across documents, with DataFrame functions only.

Lines are exploded with their place and hashed by their normalised form; hashes
that enough documents hold are found by a partial aggregate, so a line that a
third of all documents share shrinks before the shuffle; the places to drop go
back to their document, whose lines are joined again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.shared import SPACE, cut, lower_ascii


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def drop_repeated_lines(df: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Adds n_lines, n_dropped and kept (the text without its dropped lines).

    A line is dropped if its key (ASCII white space stripped at both ends, A-Z
    lowered) has ``min_chars`` code points, ``min_docs`` ids hold it, and its
    document's id isn't the largest of those. Rows without an id count for
    nothing and keep all their lines; rows that repeat an id count as one
    document, each losing its own lines. A text whose lines all go, and a null
    text, become "". An empty table gives an empty one. Columns with the names
    that are added are replaced.
    """
    row = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), F.col(id).alias("_id"), F.col(text).alias("_text"))
    row = row.withColumn("_hash", F.xxhash64("_text"))
    lines = row.where("_id is not null").select("_id", "_hash", F.posexplode(F.transform(split_lines(F.col("_text")), line_key)).alias("_at", "_key"))
    lines = lines.where(F.char_length("_key") >= min_chars)
    # Two 64-bit hashes: different keys don't meet in practice.
    lines = cut(lines.select("_id", "_hash", "_at", F.xxhash64("_key").alias("_k1"), F.xxhash64(F.lit(1), "_key").alias("_k2")), "lines")
    common = lines.groupBy("_k1", "_k2").agg(F.count_distinct("_id").alias("_n"), F.max("_id").alias("_last"))
    # Written, so that the join below deals lines out anew and may split a common one's.
    common = cut(common.where(F.col("_n") >= min_docs).drop("_n"), "common")
    gone = lines.join(common, ["_k1", "_k2"]).where("_id <> _last").groupBy("_id", "_hash").agg(F.collect_set("_at").alias("_gone"))
    out = row.join(gone, ["_id", "_hash"], "left")
    kept = F.filter(split_lines(F.col("_text")), lambda line, at: ~F.coalesce(F.array_contains("_gone", at), F.lit(False)))
    out = out.withColumn("_kept", kept).withColumn("_n", F.size(split_lines(F.col("_text"))).cast("long"))
    added = {"n_lines": F.col("_n"), "n_dropped": F.col("_n") - F.size("_kept"), "kept": F.array_join("_kept", "\n")}
    return out.select(*[F.col("_row").getField(c).alias(c) for c in df.columns if c.lower() not in added], *[v.alias(k) for k, v in added.items()])


def digests(df: DataFrame) -> DataFrame:
    return drop_repeated_lines(df.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, c.last IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c ON c.key = k.key AND length(k.key) >= 40)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""
