"""Opportunity score: seven weighted components with reasons. Adds ``score``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import literal
from bidlens.functions.lists import present, strings
from bidlens.functions.text import blank_to
from bidlens.functions.values import rupees, short_number
from bidlens.operators import security
from bidlens.operators.eligibility import capability, profile_of, serves_district
from bidlens.rules import Rules
from bidlens.schema import CONFIRMED, INFERRED, NOT_REQUIRED, REQUIRED

# Component names and kind labels.
COMPONENTS = {
    "product_match": "Product Match",
    "location_match": "Location Match",
    "business_capability": "Business Capability",
    "document_complexity": "Document Complexity",
    "deadline_urgency": "Deadline Urgency",
    "commercial_potential": "Commercial Potential",
    "procurement_complexity": "Procurement Complexity",
}
KINDS = {
    "product_supply": "product supply", "service": "service",
    "supply_and_service": "supply + service", "unknown": "type unclear",
}


def _concat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def product(m: float) -> tuple[Column, Column]:
    c = F.col("classification")
    n = F.size(c["categories"])
    base = F.when(c["confidence"] == CONFIRMED, F.lit(m)).otherwise(F.lit(m * 0.7))
    base = F.when(n >= 2, F.least(F.lit(m), base + m * 0.1)).otherwise(base)
    base = F.when(F.size(c["matched_signals"]) == 1, base * 0.85).otherwise(base)
    kinds = literal(KINDS, "map<string,string>")
    return (
        F.when(c["is_it_related"], base).otherwise(0.0),
        F.when(c["is_it_related"], _concat(
            F.array_join(c["categories"], ", "), " (", F.element_at(kinds, c["kind"]), ")"
        )).otherwise("Not an IT product or service"),
    )


def location(m: float, rules: Rules, profile: Column) -> tuple[Column, Column]:
    g, state = F.col("geo"), rules.geography["state"]
    outside = F.coalesce(~serves_district(g["districts"], profile), F.lit(False))
    sure, inferred = g["confidence"] == CONFIRMED, g["confidence"] == INFERRED
    points = (
        F.when(~g["in_region"], 0.0)
        .when(sure & outside, m * 0.75).when(sure, F.lit(m))
        .when(inferred, m * 0.7).otherwise(m * 0.4)
    )
    where = F.array_join(g["districts"], ", ")
    reason = (
        F.when(~g["in_region"], g["reason"])
        .when(sure, _concat(
            f"{state} confirmed (", F.when(where != "", where).otherwise("state-level"), ")",
            F.when(outside, " — outside our listed service districts").otherwise(""),
        ))
        .when(inferred, f"{state} mentioned but not in a location field")
        .otherwise(f"Pan-India / inferred only — confirm {state} is in scope")
    )
    return points, reason


def business(m: float) -> tuple[Column, Column]:
    level, fit = F.col("_cap.level"), F.col("eligibility.match_level")
    share = (
        F.when(level == "strong", 1.0).when(level == "moderate", 0.7).when(level == "weak", 0.3).otherwise(0.4)
    )
    points = F.lit(m) * share
    points = F.when(fit == "LOW", points * 0.5).when(fit == "HIGH", F.least(F.lit(m), points * 1.1)).otherwise(points)
    reason = (
        F.when(level == "unknown", "Company profile does not cover this category — scored neutrally")
        .when(fit == "LOW", _concat(F.col("_cap.reason"), "; eligibility gaps identified"))
        .otherwise(F.col("_cap.reason"))
    )
    return points, reason


def paperwork(m: float, rules: Rules) -> tuple[Column, Column]:
    """More points for easier paperwork."""
    n = F.size("required_documents")
    hard_kinds = strings(rules.requirements["hard_documents"])
    hard = F.size(F.filter("required_documents", lambda d: F.array_contains(hard_kinds, d["canonical"])))
    over = F.greatest(F.lit(0), n - 6) * (m * 0.06)
    points = F.greatest(F.lit(0.0), F.lit(m) - F.least(F.lit(m * 0.5), over) - hard * (m * 0.12))
    reason = _concat(
        n.cast("string"), " documents required",
        F.when(hard > 0, _concat(", ", hard.cast("string"), " of them hard to arrange")).otherwise(""),
    )
    return (
        F.when(n == 0, m * 0.5).otherwise(points),
        F.when(n == 0, "Document requirements unknown — scored neutrally").otherwise(reason),
    )


def preparation(m: float) -> tuple[Column, Column]:
    """More points for more time."""
    d = F.col("days_remaining")
    text = d.cast("string")
    points = (
        F.when(d.isNull(), m * 0.3).when(d < 0, 0.0).when(d <= 1, m * 0.25)
        .when(d <= 2, m * 0.45).when(d <= 5, m * 0.8).otherwise(F.lit(m))
    )
    reason = (
        F.when(d.isNull(), "Closing date unknown — verify on GeM")
        .when(d < 0, "Closed")
        .when(d <= 1, _concat(text, " day left — very little preparation time"))
        .when(d <= 2, _concat(text, " days left — tight"))
        .when(d <= 5, _concat(text, " days left — workable"))
        .otherwise(_concat(text, " days left — comfortable"))
    )
    return points, reason


def commercial(m: float, profile: Column) -> tuple[Column, Column]:
    """An unpublished value is neutral, never zero."""
    value, quantity = F.col("estimated_value"), F.col("quantity")
    floor, ceiling = profile["min_attractive_value_inr"], profile["max_comfortable_value_inr"]
    large = F.coalesce(quantity >= 25, F.lit(False))
    points = (
        F.when(value.isNull() & large, m * 0.65).when(value.isNull(), m * 0.5)
        .when(value < floor, m * 0.3).when(value > ceiling, m * 0.6).otherwise(F.lit(m))
    )
    reason = (
        F.when(value.isNull() & large, _concat(
            "Value not published; quantity of ", short_number(quantity), " ",
            blank_to("quantity_unit", F.lit("units")), " suggests a worthwhile order"))
        .when(value.isNull(), "Estimated value not published on GeM — scored neutrally")
        .when(value < floor, _concat(rupees(value), " is below our ", rupees(floor), " threshold"))
        .when(value > ceiling, _concat(rupees(value), " exceeds our ", rupees(ceiling), " comfort ceiling"))
        .otherwise(_concat(rupees(value), " sits in our target range"))
    )
    return points, reason


def procurement(m: float) -> tuple[Column, Column]:
    """More points for simpler procurement."""
    status, special = F.col("emd.status"), F.lower(F.array_join("requirements.special", " "))
    secured = security.headline() == security.HEAD_REQUIRED
    auction = F.contains(special, F.lit("reverse auction")) | (F.lower("ra_enabled") == "yes")
    penalty = special.rlike("liquidated damages|penalt")
    service = F.col("classification.kind") == "service"

    def share(test: Column, part: float) -> Column:
        return F.when(test, m * part).otherwise(0.0)

    deposit = F.when(status == REQUIRED, m * 0.15).when(status == NOT_REQUIRED, m * 0.1).otherwise(m * 0.2)
    points = (
        F.lit(m) - deposit - share(secured, 0.15) - share(auction, 0.2) - share(penalty, 0.1)
        + share(service, 0.05)
    )
    notes = present(
        F.when(status == REQUIRED, "EMD payable")
        .when(status == NOT_REQUIRED, "no EMD — expect more bidders")
        .otherwise("EMD terms unclear"),
        F.when(secured, "performance security required"),
        F.when(auction, "reverse auction — price pressure"),
        F.when(penalty, "penalty clauses"),
        F.when(service, "service contract — recurring revenue"),
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(m), points)), F.array_join(notes, "; ")


def band(total: Column, rules: Rules, key: str) -> Column:
    """Band label; bounds are whole numbers, so 79.5 falls between two bands."""
    out = F.when(F.lit(False), "")
    for b in rules.decision["score_bands"]:
        out = out.when(total.between(b["min"], b["max"]), b[key])
    return out.otherwise("")


def score(df: DataFrame, rules: Rules, profile: Column | None = None) -> DataFrame:
    """By the rules' profile, or by each row's own ``profile``."""
    profile = profile_of(rules) if profile is None else profile
    w = {k: float(v) for k, v in rules.decision["weights"].items()}
    df = df.withColumn("_cap", capability(F.col("classification.categories"), profile))
    parts = {
        "product_match": product(w["product_match"]),
        "location_match": location(w["location_match"], rules, profile),
        "business_capability": business(w["business_capability"]),
        "document_complexity": paperwork(w["document_complexity"], rules),
        "deadline_urgency": preparation(w["deadline_urgency"]),
        "commercial_potential": commercial(w["commercial_potential"], profile),
        "procurement_complexity": procurement(w["procurement_complexity"]),
    }
    df = df.withColumn(
        "_components",
        F.array(
            *[
                F.struct(
                    F.lit(COMPONENTS[k]).alias("name"),
                    F.bround(points.cast("double"), 1).alias("points"),
                    F.lit(w[k]).alias("max_points"),
                    reason.alias("reason"),
                )
                for k, (points, reason) in parts.items()
            ]
        ),
    )
    total = F.aggregate("_components", F.lit(0.0), lambda acc, c: acc + c["points"])
    df = df.withColumn("_total", F.bround(total, 1))
    return df.withColumn(
        "score",
        F.struct(
            F.col("_total").alias("total"),
            F.col("_components").alias("components"),
            band(F.col("_total"), rules, "label").alias("band"),
            band(F.col("_total"), rules, "rank").alias("rank_label"),
        ),
    ).drop("_cap", "_components", "_total")


def component_lines() -> Column:
    """'name: points/max — reason' per component."""
    return F.transform(
        "score.components",
        lambda c: F.concat(
            c["name"], F.lit(": "), F.format_number(c["points"], 0), F.lit("/"),
            F.format_number(c["max_points"], 0), F.lit(" — "), c["reason"],
        ),
    )
