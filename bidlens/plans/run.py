"""A whole run: listing pages, search hits, detail pages and documents in, judged bids out.

    find        candidates of all sources, each bid once under the key its source gives it
    screen      what the listing alone rules out
    complete    detail pages laid over the shortlist, keys made anew, bids that turn out
                to be one put together, documents attached
    judge       full analysis and gate

Every step is written to the shared folder before the next one reads it: a step
is computed once, and lost executors cost no more than the step they worked on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.operators import discovery
from bidlens.plans import daily
from bidlens.rules import Rules
from bidlens.session import stable
from bidlens.sources import documents, hits, pages


@dataclass(frozen=True)
class Run:
    """What a run leaves: every table is written."""

    candidates: DataFrame
    screened_out: DataFrame
    judged: DataFrame
    #: The detail pages (url) and the documents (url) that the shortlist made the run read.
    details_read: DataFrame
    documents_read: DataFrame


def find(listings: DataFrame, found: DataFrame | None, rules: Rules) -> DataFrame:
    """Candidates of saved listing pages (``url, html``) and search hits, with who found them."""
    sources = {"portal": pages.listing_cards(listings, rules).drop("page_url")}
    if found is not None:
        sources["search"] = hits.candidates(found, rules)
    return discovery.merge_sources(sources)


def complete(shortlist: DataFrame, details: DataFrame, rules: Rules) -> DataFrame:
    """The shortlist with its detail pages (``url, html``), each bid once.

    A page may tell the number of a bid that was found without one, so keys are made
    anew after the merge, and rows that now bear the same key become the first seen of
    them, with the finders of all. Column ``first_key`` is the key it was found under.
    """
    known = shortlist.withColumn("first_key", F.col("identity_key"))
    return discovery.dedupe(stable(pages.merge_details(known, details, rules, by="url")), "first_key")


def attach(bids: DataFrame, details: DataFrame, files: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(bids with ``doc_text``, documents read): files (``url, text``) that the bids' detail pages link to."""
    read = details.join(bids.select(F.col("detail_url").alias("url")).distinct(), "url", "left_semi")
    links = pages.attachments(read, rules)
    parts = links.join(files.select("url", "text"), "url").select(
        F.col("page_url").alias("identity_key"), F.struct("rank", "pos").alias("pos"), "name", "kind", "url", "text"
    )
    texts = documents.assemble(parts).select(F.col("identity_key").alias("detail_url"), F.col("doc_text").alias("_text"))
    joined = bids.join(texts, "detail_url", "left").withColumn("doc_text", F.coalesce("_text", F.lit(""))).drop("_text")
    return joined, parts.select("url")


def run_report(
    listings: DataFrame, found: DataFrame | None, details: DataFrame, files: DataFrame, rules: Rules, now: str,
    corrections: DataFrame | None = None,
) -> Run:
    """Saved pages, hits and documents to verdicts.

    A bid without a detail page or documents is judged by its listing. Several pages
    under one url count as one (see ``merge_details``); several files under one url
    are all read.
    """
    candidates = stable(find(listings, found, rules))
    screened = stable(daily.screen_reasons(candidates, rules, now))
    shortlist = screened.filter("screen_reason IS NULL").select(*candidates.columns)
    bids = stable(complete(shortlist, details, rules))
    bids, read = attach(bids, details, files, rules)
    judged = stable(daily.judge(daily.analyse(stable(bids), rules, now, corrections, once=True), rules).drop("doc_text"))
    return Run(
        candidates, screened.filter("screen_reason IS NOT NULL"), judged,
        judged.filter("detail_url IS NOT NULL").select(F.col("detail_url").alias("url")).distinct(), read,
    )
