"""Mixing sources to target weights, with DataFrame functions only and without sorting documents.

Each document has a hash of its id. Per source, words are summed by the hash's
leading bits; the budget's threshold falls into one bucket, and only that
bucket's documents are summed again by the following bits. Documents below the
threshold are taken once more than the others. A source that holds a third of
all rows is summed before the shuffle like any other; what is ordered is one
row per source and at most 1,024 per source and level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidlens.llm.shared import cut, n_words, unused

LEVELS, BITS, HEX = 3, 10, 15
MOST = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0) -> DataFrame:
    """Adds target to one row per source (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn. ``share`` of all
    sizes is split by weight; a target stops at MOST times its source's size and
    the excess is split among the others by weight, until none is above. Sorted
    by size per weight, the sources that stop come first, so one running sum
    finds them all.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    order = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0))
    rows = sizes.withColumn("w", weight).withColumn("left", left).withColumn("ws", F.sum("w").over(after))
    full = MOST * F.col("source_size") * F.col("ws") <= F.col("left") * F.col("w")
    rows = rows.withColumn("full", full)
    first = F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("w"), F.col("source").isNull(), "source", "left", "ws"))).over(everything)
    rows = rows.withColumn("first", first)
    target = F.when(F.col("full"), (MOST * F.col("source_size")).cast("double"))
    return rows.select("source", "source_size", target.otherwise(F.col("first.left") * F.col("w") / F.col("first.ws")).cast("double").alias("target"))


def plan(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0) -> DataFrame:
    """Rows (id, source, size, source_size, target, copies): how often the mix takes each document.

    A null text has size 0; null sources form one source; null ids share one
    hash. Repeated rows of an id are taken alike. Documents of no words are taken
    as often as others of their hash and add nothing. An empty table gives none.
    """
    digest = F.conv(F.substring(F.md5(F.coalesce(F.col(id).cast("string"), F.lit("null"))), 1, HEX), 16, 10).cast("long")
    docs = cut(df.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), digest.alias("hash")), "sizes")
    sums = cut(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    per = targets(sums, weights, share)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(F.lit(0)).cast("int")
    per = cut(per.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")

    prefix = lambda level: F.shiftright("hash", 4 * HEX - BITS * level)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    # Each level: the bucket in which the running sum of words passes the rest, and the sum before it.
    edge = per.select("source", "rest", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("below"))
    for level in range(1, LEVELS + 1):
        inside = docs.join(edge, same(docs, edge) & (prefix(level - 1) == edge["bucket"])) if level > 1 else docs.join(edge, same(docs, edge))
        sums = inside.groupBy(docs["source"].alias("source"), prefix(level).alias("bucket")).agg(F.sum("size").alias("n"), F.first("rest").alias("rest"), F.first("below").alias("below"))
        through = F.col("below") + F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("through", through).where("through > rest")
        edge = cut(sums.groupBy("source").agg(F.min_by(F.struct("rest", "bucket", (F.col("through") - F.col("n")).alias("below"), "through"), "bucket").alias("e")).select("source", "e.*"), "edges")
    # The last bucket is taken if that comes nearer to the target.
    nearer = F.col("through") - F.col("rest") < F.col("rest") - F.col("below")
    edge = edge.select("source", (F.col("bucket") + F.when(nearer, 1).otherwise(0)).alias("threshold"))
    per = per.join(edge, same(per, edge), "left").select(per["source"], "source_size", "target", "whole", "threshold", "rest")
    out = docs.join(per, same(docs, per)).withColumn("below", F.coalesce(prefix(LEVELS) < F.col("threshold"), F.lit(True)))
    more = F.when(F.col("below") & (F.col("rest") > 0) & (F.col("whole") < MOST), 1).otherwise(0)
    return out.select(docs["id"], docs["source"], "size", "source_size", "target", (F.col("whole") + more).alias("copies"))


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken. Rows of one id have one hash and so one count."""
    key, name, copies = (unused(df, x) for x in ("_mix_id", "_mix_source", "_mix_copies"))
    counts = plan(df, id, text, source, weights, share).groupBy(F.col("id").alias(key), F.col("source").alias(name)).agg(F.max("copies").alias(copies))
    rows = df.join(counts, df[id].eqNullSafe(counts[key]) & df[source].cast("string").eqNullSafe(counts[name]))
    return rows.where(F.col(copies) > 0).withColumn(key, F.explode(F.sequence(F.lit(1), copies))).select(*[df[c] for c in df.columns])


def taken(df: DataFrame) -> DataFrame:
    return plan(df.select("doc_id", "text", "source")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) >> 30 AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 AS w FROM s),
o AS (SELECT *, CAST(sum(n) OVER () AS DOUBLE) - coalesce(sum(3 * n) OVER (ORDER BY n / w, source IS NULL, source COLLATE "C" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (ORDER BY n / w, source IS NULL, source COLLATE "C" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM w),
f AS (SELECT *, 3 * n * ws <= rest * w AS full_ FROM o),
g AS (SELECT arg_min(rest, rest / ws) AS r0, arg_min(ws, rest / ws) AS ws0 FROM (SELECT * FROM f WHERE NOT full_ QUALIFY row_number() OVER (ORDER BY n / w, source IS NULL, source COLLATE "C") = 1)),
t AS (SELECT source, n, CASE WHEN full_ THEN CAST(3 * n AS DOUBLE) ELSE CAST(r0 * w / ws0 AS DOUBLE) END AS target FROM f LEFT JOIN g ON true),
q AS (SELECT *, CASE WHEN n > 0 THEN least(CAST(floor(target / n) AS BIGINT), 3) ELSE 0 END AS whole FROM t),
b AS (SELECT source, h, sum(size) AS n FROM d GROUP BY ALL),
c AS (SELECT b.source, b.h, b.n, q.target - q.whole * q.n AS rest, sum(b.n) OVER (PARTITION BY b.source ORDER BY b.h) AS through FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source),
x AS (SELECT source, h, rest > 0 AND (through <= rest OR (through - n <= rest AND through - rest < rest - (through - n))) AS more FROM c)
SELECT d.doc_id, d.size, q.n AS source_size, q.target, CAST(d.size * (q.whole + CASE WHEN x.more AND q.whole < 3 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h"""
