"""Daily snapshots: flat rows, merge with yesterday, amendments, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import as_column
from bidlens.functions.text import blank_to
from bidlens.operators import security

# Announced fields with their labels.
TRACKED = (
    ("bid_end_at", "Closing date"),
    ("emd_status", "EMD requirement"),
    ("emd_amount", "EMD amount"),
    ("epbg_status", "Performance security requirement"),
    ("epbg_percentage", "ePBG percentage"),
    ("estimated_value", "Estimated value"),
    ("title", "Tender title"),
    ("status", "Tender status"),
)
NUMERIC = ("emd_amount", "epbg_percentage", "estimated_value")
FIRST_TIME = "first time this was stated on the portal"
ROW = (
    "identity_key", "bid_number", "gem_tender_id", "title", "buyer", "department", "categories", "kind",
    "location", "districts", "published_at", "bid_end_at", "days_remaining", "urgency", "emd_status",
    "emd_amount", "epbg_status", "epbg_percentage", "estimated_value", "score", "score_band",
    "match_level", "status", "source_url", "report_doc_url", "first_seen_on", "last_seen_on", "payload",
)


def iso(col: Column | str) -> Column:
    return F.date_format(as_column(col), "yyyy-MM-dd'T'HH:mm:ss'+05:30'")


def flat_rows(judged: DataFrame, today: str) -> DataFrame:
    """The 28-column row that is stored per bid."""
    payload = F.to_json(F.struct(*[F.col(c) for c in judged.columns if c != "doc_text"]))
    values = {
        "buyer": F.col("buyer_organization"),
        "department": blank_to("department", "ministry"),
        "categories": F.array_join("classification.categories", ", "),
        "kind": F.col("classification.kind"),
        "location": blank_to("delivery_location", "buyer_address"),
        "districts": F.array_join("geo.districts", ", "),
        "published_at": iso("published_at"),
        "bid_end_at": iso("bid_end_at"),
        "emd_status": F.col("emd.status"),
        "emd_amount": F.col("emd.amount"),
        "epbg_status": security.headline(),
        "epbg_percentage": F.col("security.percentage"),
        "score": F.col("score.total"),
        "score_band": F.col("score.band"),
        "match_level": F.col("eligibility.match_level"),
        "status": F.lit("open"),
        "report_doc_url": F.lit(""),
        "first_seen_on": F.lit(today),
        "last_seen_on": F.lit(today),
        "payload": payload,
    }
    return judged.select(*[values[c].alias(c) if c in values else F.col(c) for c in ROW])


def joined(previous: DataFrame, today_rows: DataFrame) -> DataFrame:
    """Both days side by side, as structs ``p`` and ``t``, one row per key."""
    p = previous.select(F.col("identity_key").alias("_k"), F.struct(*previous.columns).alias("p"))
    t = today_rows.select("identity_key", F.struct(*today_rows.columns).alias("t"))
    return t.join(p, F.col("identity_key") == F.col("_k"), "full_outer").select(
        F.coalesce("identity_key", "_k").alias("identity_key"), "p", "t"
    )


def merge(both: DataFrame, columns: list[str]) -> DataFrame:
    """New snapshot: today's values win; first sight and an old report link stay."""

    def value(c: str) -> Column:
        p, t = F.col(f"p.{c}"), F.col(f"t.{c}")
        if c == "first_seen_on":
            return F.coalesce(p, t)
        if c == "report_doc_url":
            return F.when(F.col("t").isNull(), p).otherwise(blank_to(t, p))
        return F.when(F.col("t").isNotNull(), t).otherwise(p)

    return both.select(
        "identity_key", *[value(c).alias(c) for c in columns if c != "identity_key"],
        F.when(F.col("t").isNull(), "kept").when(F.col("p").isNull(), "new").otherwise("updated").alias("action"),
    )


def same_number(old: Column, new: Column) -> Column:
    """Equal within a paisa; null counts as 0."""
    return F.abs(F.coalesce(old, F.lit(0.0)) - F.coalesce(new, F.lit(0.0))) < 0.01


def same_text(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit("")) == F.coalesce(new, F.lit(""))


def display(value: Column, numeric: bool = False) -> Column:
    """Wording of a value in the change log."""
    if numeric:
        # A DOUBLE is written the way the stored figure reads: 75000.0, 3.5.
        return F.coalesce(plain_number(value), F.lit("not stated"))
    day = F.substring(value, 1, 10).try_cast("date")
    dated = (F.length(value) >= 10) & (F.substring(value, 5, 1) == "-") & day.isNotNull()
    return (
        F.when(value.isNull() | value.isin("", "not_stated"), "not stated")
        .when(dated, F.date_format(day, "dd MMMM yyyy"))
        .otherwise(value)
    )


def plain_number(value: Column) -> Column:
    """A DOUBLE without exponent and with at least one decimal."""
    whole = value == F.floor(value)
    return F.when(whole & (F.abs(value) < 1e15), F.concat(value.cast("bigint").cast("string"), F.lit(".0"))).when(
        F.abs(value).between(1e-3, 1e7), value.cast("string")
    ).otherwise(F.regexp_replace(F.format_string("%.6f", value), "0+$", ""))


def changes(both: DataFrame, today: Column | str) -> DataFrame:
    """One row per announced field that differs on a bid seen on both days; ``today`` is a day or a column of days."""
    rows = []
    for field, label in TRACKED:
        old, new, numeric = F.col(f"p.{field}"), F.col(f"t.{field}"), field in NUMERIC
        same = same_number(old, new) if numeric else same_text(old, new)
        unstated = old.isNull() if numeric else (old.isNull() | old.isin("", "not_stated"))
        rows.append(F.when(~same, F.struct(
            F.lit(label).alias("field_name"),
            display(old, numeric).alias("old_value"),
            display(new, numeric).alias("new_value"),
            old.cast("string").alias("old_raw"),
            new.cast("string").alias("new_raw"),
            F.when(unstated, FIRST_TIME).otherwise("").alias("note"),
        )))
    seen = both.filter(F.col("p").isNotNull() & F.col("t").isNotNull())
    day = F.lit(today) if isinstance(today, str) else today
    return seen.select("identity_key", day.alias("detected_on"), F.explode(F.array_compact(F.array(*rows))).alias("c")).select(
        "identity_key", "c.*", "detected_on"
    )


def change_sentence() -> Column:
    return F.concat(
        F.lit("⚠ "), F.replace("field_name", F.lit("_"), F.lit(" ")), F.lit(" changed from "),
        F.col("old_value"), F.lit(" to "), F.col("new_value"),
    )


def expire(snapshot: DataFrame, today: str) -> DataFrame:
    """Close open bids whose closing day has passed; adds ``just_closed``."""
    past = F.coalesce((F.col("status") == "open") & (F.substring("bid_end_at", 1, 10) < today), F.lit(False))
    return snapshot.withColumns({"just_closed": past, "status": F.when(past, "closed").otherwise(F.col("status"))})


def open_bids(snapshot: DataFrame, n: int | None = None) -> DataFrame:
    """Open bids by closing day; all of them unless ``n`` is given."""
    rows = snapshot.filter("status = 'open'").orderBy(F.col("bid_end_at").asc_nulls_first(), "identity_key")
    return rows if n is None else rows.limit(n)
