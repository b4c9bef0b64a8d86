"""The columns of a bid and the structs the analysis adds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.functions.identity import identity_key

# Status words shared by all steps.
REQUIRED, NOT_REQUIRED, NOT_STATED = "required", "not_required", "not_stated"
CONFIRMED, INFERRED, UNCLEAR, NOT_FOUND = "confirmed", "inferred", "unclear", "not_found"

TEXT = (
    "bid_number", "gem_tender_id", "source_url", "title", "item_description", "category",
    "buyer_organization", "ministry", "department", "office", "buyer_address",
    "delivery_location", "service_location", "installation_location", "quantity_unit",
    "listing_text", "portal_status", "ra_enabled", "portal_emd_text", "portal_epbg_text",
    "doc_text",
)
OTHER = {
    "consignee_locations": "array<string>",
    "quantity": "double",
    "published_at": "timestamp_ntz",
    "bid_start_at": "timestamp_ntz",
    "bid_end_at": "timestamp_ntz",
    "bid_open_at": "timestamp_ntz",
    "estimated_value": "double",
    "portal_emd_amount": "double",
    "portal_epbg_pct": "double",
    "flags": "array<string>",
}
FLAGS = ("msme_portal_flag", "startup_portal_flag")

EVIDENCE = "struct<source_url:string,locator:string,quote:string,extractor:string>"
EVIDENCE_LIST = f"array<{EVIDENCE}>"


def conform(df: DataFrame) -> DataFrame:
    """Give a table of bids every column the analysis reads.

    Absent text is '', absent lists are empty, absent numbers, dates and
    portal answers stay null / not_stated: nothing unknown becomes a value.
    """
    have = set(df.columns)

    def column(name: str):
        return F.col(name) if name in have else F.lit(None)

    made = [F.coalesce(column(c).cast("string"), F.lit("")).alias(c) for c in TEXT]
    for name, kind in OTHER.items():
        typed = column(name).cast(kind)
        if kind.startswith("array"):
            typed = F.coalesce(typed, F.array().cast(kind))
        made.append(typed.alias(name))
    made += [F.coalesce(column(c).cast("string"), F.lit(NOT_STATED)).alias(c) for c in FLAGS]
    rest = [F.col(c) for c in df.columns if c not in {*TEXT, *OTHER, *FLAGS, "identity_key"}]
    return df.select(*made, *rest).withColumn("identity_key", identity_key())


def evidence(source_url, locator: str, quote, extractor: str):
    return F.struct(
        F.coalesce(source_url, F.lit("")).alias("source_url"),
        F.lit(locator).alias("locator"),
        F.coalesce(quote, F.lit("")).alias("quote"),
        F.lit(extractor).alias("extractor"),
    )
