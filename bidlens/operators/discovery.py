"""Candidates from several sources: union, first-seen dedupe, who found what.

A source is any DataFrame of candidates with a query and positions; grouping is
by identity key with map-side partial aggregates, so a bid that is found very
often shrinks before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.schema import conform
from bidlens.session import stable

ORDER = ("adapter_pos", "query_pos", "page_pos", "pos")


def tagged(df: DataFrame, adapter: str, adapter_pos: int) -> DataFrame:
    """Mark one source's candidates; missing positions count as 0."""
    for c in ORDER[1:]:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0))
    if "query" not in df.columns:
        df = df.withColumn("query", F.lit(""))
    return conform(df).withColumns({"adapter": F.lit(adapter), "adapter_pos": F.lit(adapter_pos)})


def first_seen(candidates: DataFrame) -> DataFrame:
    """One row per identity key: the first in discovery order."""
    rest = [c for c in candidates.columns if c != "identity_key"]
    order = F.struct(*[F.col(c).cast("bigint") for c in ORDER])
    best = candidates.groupBy("identity_key").agg(F.min_by(F.struct(*rest), order).alias("r"))
    return best.select("identity_key", "r.*")


def _sighted(candidates: DataFrame, *more: str) -> DataFrame:
    """Per bid, source and query: the first place (``more`` columns settle ties) and how many sightings.

    A partial aggregate of a few narrow columns; how often a bid was seen does not matter after it.
    """
    place = F.struct(*[F.col(c).cast("bigint") for c in ORDER], *more)
    return candidates.groupBy("identity_key", "adapter", "query").agg(F.min(place).alias("first"), F.count("*").alias("n"))


def _finders(per_query: DataFrame) -> DataFrame:
    """``identity_key, first, found, sightings``: lists no longer than those of queries and sources."""
    found = F.struct("first", "query", "adapter", "n")
    return per_query.groupBy("identity_key").agg(
        F.min("first").alias("first"), F.array_sort(F.collect_list(found)).alias("found"), F.sum("n").alias("sightings")
    )


def _told(lists: DataFrame) -> dict[str, Column]:
    """The columns that tell who found a bid, from ``found``."""
    return {
        "matched_queries": F.transform("found", lambda x: F.struct(x["query"].alias("query"), x["n"].alias("sightings"))),
        "discovered_via": F.array_distinct(F.transform("found", lambda x: x["adapter"])),
    }


def found_by(candidates: DataFrame) -> DataFrame:
    """``identity_key, matched_queries, discovered_via, sightings``.

    First counted per bid and query, then collected: a bid's lists are no longer
    than the lists of queries and sources, however often it was seen.
    """
    lists = _finders(_sighted(candidates))
    return lists.withColumns(_told(lists)).select("identity_key", "matched_queries", "discovered_via", "sightings")


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Union the sources in order, keep each bid once, record who found it.

    The union is written once, with a row number. One aggregation of the narrow
    columns finds each bid's first row and its finders; whole rows move only for
    the late join by row number. ``found`` keeps the finders for ``dedupe``.
    """
    parts = [tagged(df, name, i) for i, (name, df) in enumerate(sources.items())]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part, allowMissingColumns=True)
    everything = stable(everything.withColumn("_row", F.monotonically_increasing_id()))
    lists = _finders(_sighted(everything, "source_url", "_row"))
    lists = lists.withColumns({**_told(lists), "_row": F.col("first._row")})
    return everything.join(lists.select("_row", "found", "matched_queries", "discovered_via", "sightings"), "_row").drop("_row")


def dedupe(bids: DataFrame, row: str) -> DataFrame:
    """One row per identity key again, after keys have changed; finders of the rows that became one are put together.

    ``bids`` comes from ``merge_sources``, with its keys made anew; ``row`` names a
    unique column (the key from before, say). Of the rows of a key the first seen
    stays. Only keys, places and finders are grouped; a bid whose key was taken up
    by very many rows is counted per query first, like any other.
    """
    seen = bids.select("identity_key", F.explode("found").alias("f"), row)
    first = F.struct(F.col("f.first").alias("at"), F.col(row).alias("row"))
    per_query = seen.groupBy("identity_key", F.col("f.adapter").alias("adapter"), F.col("f.query").alias("query")).agg(
        F.min(first).alias("first"), F.sum("f.n").alias("n")
    )
    lists = _finders(per_query)
    lists = lists.select(F.col("first.row").alias(row), F.transform("found", lambda x: x.withField("first", x["first"]["at"])).alias("found"), "sightings")
    lists = lists.withColumns(_told(lists))
    return bids.drop("found", "matched_queries", "discovered_via", "sightings").join(lists, row)


def zero_results(candidates: DataFrame, queries: DataFrame, at: str, target: str) -> DataFrame:
    """An issue row if queries ran and nothing at all came back."""
    ran = queries.agg(F.count("*").alias("n_queries"))
    got = candidates.agg(F.count("*").alias("n_found"))
    return ran.crossJoin(got).filter("n_queries > 0 AND n_found = 0").select(
        F.lit(at).cast("timestamp_ntz").alias("occurred_at"), F.lit("listing").alias("stage"),
        F.lit(target).alias("target"), F.lit("ZERO_RESULTS_ALL_QUERIES").alias("error_type"),
        F.concat(F.col("n_queries").cast("string"), F.lit(" search terms returned no rows")).alias("detail"),
    )
