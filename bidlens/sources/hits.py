"""Saved search-engine hits as candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.functions.identity import bid_number, is_allowed_host
from bidlens.functions.text import blank_to, clean
from bidlens.rules import Rules


def candidates(hits: DataFrame, rules: Rules) -> DataFrame:
    """``query, title, snippet, link`` to candidates; other hosts are dropped.

    Extra columns (positions, say) are kept.
    """
    df = hits.filter(is_allowed_host("link", rules.portal["allowed_hosts"]))
    df = df.withColumns({"title": clean("title"), "snippet": clean("snippet")})
    return df.withColumns({
        "bid_number": bid_number(F.concat_ws(" ", "title", "snippet", "link")),
        "source_url": F.col("link"),
        "item_description": F.col("snippet"),
        "listing_text": F.concat_ws(" ", "title", "snippet"),
        "title": blank_to("title", "snippet", "link"),
    }).drop("snippet", "link")


def read_saved(spark, path: str) -> DataFrame:
    """Saved API answers (JSON lines with ``query`` and ``items``), one row per hit."""
    schema = "query string, items array<struct<title:string,snippet:string,link:string>>"
    return spark.read.schema(schema).json(path).select("query", F.posexplode("items").alias("hit_pos", "i")).select(
        "query", "hit_pos", "i.title", "i.snippet", "i.link"
    )
