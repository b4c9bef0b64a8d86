"""Deadline, screen, gate and watchlist: why a bid is in or out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions.identity import is_allowed_host
from bidlens.functions.lists import add_distinct, present
from bidlens.functions.text import escape
from bidlens.functions.values import days_remaining, urgency
from bidlens.rules import Rules

FLAG_NO_DEADLINE = (
    "Bid closing date could not be read from the official listing — "
    "confirm the deadline on GeM before planning any submission."
)


def deadline(df: DataFrame, rules: Rules, now: str) -> DataFrame:
    """Adds days_remaining and urgency; flags an unreadable deadline."""
    df = df.withColumn("days_remaining", days_remaining("bid_end_at", now))
    return df.withColumns(
        {
            "urgency": urgency("days_remaining", rules.deadline["bands"]),
            "flags": add_distinct(
                "flags", present(F.when(F.col("days_remaining").isNull(), FLAG_NO_DEADLINE))
            ),
        }
    )


def in_main_window(rules: Rules, days: Column | None = None) -> Column:
    d = F.col("days_remaining") if days is None else days
    return d.isNotNull() & d.between(0, rules.deadline["main_window_days"])


def in_watch_window(rules: Rules, days: Column | None = None) -> Column:
    d = F.col("days_remaining") if days is None else days
    low, high = rules.deadline["main_window_days"] + 1, rules.deadline["watch_window_days"]
    return d.isNotNull() & d.between(low, high)


def is_active(rules: Rules) -> Column:
    """No cancelled marker in the portal status or the listing."""
    seen = F.lower(F.concat_ws(" ", "portal_status", "listing_text"))
    return ~seen.rlike("|".join(escape(m) for m in rules.decision["cancelled_markers"]))


def dated_out(rules: Rules) -> Column:
    """Why the closing date alone rules a bid out, or null; an unknown deadline passes."""
    d = F.col("days_remaining")
    return F.when(d < 0, "expired").when(d > rules.deadline["watch_window_days"], "outside_10_day_window")


def screen_reason(rules: Rules) -> Column:
    """First-pass screen on listing data."""
    return F.coalesce(
        dated_out(rules),
        F.when(~F.col("classification.is_it_related"), "not_it_related").when(~F.col("geo.in_region"), "not_jharkhand"),
    )


def listing_reason(rules: Rules) -> Column:
    """The first checks of the gate: those that read the listing only."""
    return F.when(~is_allowed_host("source_url", rules.portal["allowed_hosts"]), "not_official_gem_source").when(~is_active(rules), "not_active")


def gate_reason(rules: Rules) -> Column:
    """First failing check, or null."""
    d = F.col("days_remaining")
    return (
        listing_reason(rules)
        .when(~F.col("classification.is_it_related"), "not_it_related")
        .when(~F.col("geo.in_region"), "not_jharkhand")
        .when(d.isNull(), "no_closing_date")
        .when(d < 0, "expired")
        .when(d > rules.deadline["main_window_days"], "outside_10_day_window")
    )


def verdict(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds verdict (accepted / watchlist / rejected) and rejected_reason."""
    df = df.withColumn("_reason", gate_reason(rules))
    watch = (
        (F.col("_reason") == "outside_10_day_window")
        & in_watch_window(rules)
        & (F.col("score.total") >= rules.deadline["watch_min_score"])
    )
    df = df.withColumn(
        "verdict",
        F.when(F.col("_reason").isNull(), "accepted").when(watch, "watchlist").otherwise("rejected"),
    )
    return df.withColumns(
        {
            "rejected_reason": F.when(F.col("verdict") == "rejected", F.col("_reason")),
            "urgency": F.when(F.col("verdict") == "watchlist", "WATCHLIST").otherwise(F.col("urgency")),
        }
    ).drop("_reason")
