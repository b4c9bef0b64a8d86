"""Tables for the shared workbook: bids, change log, run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.functions.text import blank_to
from bidlens.operators import security

# Column headers of the three tabs.
BIDS = (
    "Date Found", "Last Seen", "Tender Title", "Bid Number", "Tender ID", "Buyer", "Department",
    "Product Category", "Product / Service", "Location", "Districts", "Closing Date", "Days Remaining",
    "Urgency", "EMD Required", "EMD Amount", "ePBG Required", "ePBG %", "Estimated Value",
    "Opportunity Score", "Score Band", "Match Level", "Status", "Official GeM Link",
    "Google Doc Report Link", "Verification Flags",
)
CHANGES = ("Detected On", "Bid Number", "Field", "Old Value", "New Value", "Note")
RUNS = (
    "Run ID", "Started", "Finished", "Queries", "Bids Seen", "Details Fetched", "Documents", "Accepted",
    "Watchlist", "New", "Updated", "Access Issues", "Degraded Modes", "Report Link",
)


def bid_rows(judged: DataFrame, today: str, report_url: str = "") -> DataFrame:
    """Needs ``first_seen_on`` on the judged bids (null = today)."""
    cells = (
        F.coalesce("first_seen_on", F.lit(today)), F.lit(today), F.col("title"), F.col("bid_number"),
        F.col("gem_tender_id"), F.col("buyer_organization"), blank_to("department", "ministry"),
        F.array_join("classification.categories", ", "), F.col("classification.kind"),
        blank_to("delivery_location", "buyer_address"), F.array_join("geo.districts", ", "),
        F.coalesce(F.date_format("bid_end_at", "yyyy-MM-dd HH:mm"), F.lit("")), F.col("days_remaining"),
        F.col("urgency"), F.col("emd.status"), F.col("emd.amount"), security.headline(),
        F.col("security.percentage"), F.col("estimated_value"), F.col("score.total"), F.col("score.band"),
        F.col("eligibility.match_level"), F.lit("open"), F.col("source_url"), F.lit(report_url),
        F.array_join("flags", " | "),
    )
    return judged.select(*[c.alias(n) for c, n in zip(cells, BIDS)])


def upsert(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Today's rows replace those with the same bid number; blank numbers are added."""

    def key():
        return F.upper(F.trim(F.coalesce(F.col("`Bid Number`"), F.lit(""))))

    seen = rows.select(key().alias("_seen")).filter("_seen <> ''").distinct()
    kept = existing.join(seen, key() == F.col("_seen"), "left_anti")
    return kept.unionByName(rows)


def change_rows(changes: DataFrame, judged: DataFrame) -> DataFrame:
    numbers = judged.select("identity_key", "bid_number")
    df = changes.join(numbers, "identity_key", "left")
    cells = (
        F.col("detected_on"), F.coalesce("bid_number", "identity_key"), F.col("field_name"),
        F.col("old_value"), F.col("new_value"), F.col("note"),
    )
    return df.select(*[c.alias(n) for c, n in zip(cells, CHANGES)])


def run_rows(manifest: DataFrame, report_url: str = "") -> DataFrame:
    """The run tab. Its cell of access issues counts them by type and stage; the lines are rows of ``report.access_issues``."""
    told = F.transform("issues", lambda e: F.concat(e["error_type"], F.lit(" at "), e["stage"], F.lit(" ("), e["n"].cast("string"), F.lit(")")))
    cells = (
        F.col("run_id"), F.col("started_at"), F.coalesce("finished_at", F.lit("")), F.col("queries"),
        F.col("listings_seen"), F.col("details_fetched"), F.col("documents_downloaded"), F.col("accepted"),
        F.col("watchlist"), F.col("new_tenders"), F.col("updated_tenders"),
        F.array_join(told, " | "), F.array_join("degraded_modes", ", "), F.lit(report_url),
    )
    return manifest.select(*[c.alias(n) for c, n in zip(cells, RUNS)])
