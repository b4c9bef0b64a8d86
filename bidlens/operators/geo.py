"""Does the work land in the target region?

Adds ``geo``: in_region, matched_terms, matched_fields, districts, nationwide,
confidence, reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import let
from bidlens.functions.lists import distinct_ci, strings
from bidlens.functions.terms import alternation, begins, spaced, word
from bidlens.functions.text import clean, escape
from bidlens.rules import Rules
from bidlens.schema import CONFIRMED, INFERRED, UNCLEAR


def fields(doc_text: Column | None = None) -> Column:
    """ARRAY<STRUCT<name, text>> of the texts that may name a place."""
    texts = {
        "delivery_location": F.col("delivery_location"),
        "service_location": F.col("service_location"),
        "installation_location": F.col("installation_location"),
        "consignee_locations": F.array_join("consignee_locations", " "),
        "buyer_address": F.col("buyer_address"),
        "buyer_organization": F.concat_ws(
            " ", "buyer_organization", "department", "ministry", "office"
        ),
        "title": F.col("title"),
        "listing_text": F.col("listing_text"),
        "documents": F.lit("") if doc_text is None else doc_text,
    }
    return F.array(
        *[F.struct(F.lit(n).alias("name"), clean(t).alias("text")) for n, t in texts.items()]
    )


def place_pattern(terms: list[str]) -> str:
    """For ``spaced`` texts; the first group is the place."""
    low = [t.lower() for t in terms]
    if all(t[:1].isalnum() and t[-1:].isalnum() for t in low):
        return f"(?i){begins(f'({alternation(low)})')}"
    # The end of one place may be what stands before the next.
    return f"(?i)({word(alternation(low))})"


def match_fields(fields: Column, rules: Rules) -> Column:
    """Per field with a hit: its name, the hits in order and its districts."""
    g = rules.geography
    state, district, locality = (
        F.lit(place_pattern(g[k])) for k in ("state_aliases", "districts", "localities")
    )
    ambiguous = strings([t.lower() for t in g["ambiguous_localities"]])

    def places(text: Column, pattern: Column) -> Column:
        return F.regexp_extract_all(spaced(text), pattern, F.lit(1))

    # One pass tells whether a text names any place; the three that tell which run on those that do.
    anywhere = place_pattern([*g["state_aliases"], *g["districts"], *g["localities"]])

    def match(f: Column) -> Column:
        return F.struct(
            f["name"].alias("name"),
            # A two-letter alias is too weak to count.
            F.filter(places(f["text"], state), lambda h: F.length(h) > 2).alias("state"),
            places(f["text"], district).alias("district"),
            places(f["text"], locality).alias("locality"),
        )

    def settle(m: Column) -> Column:
        sure = F.concat(m["state"], m["district"])
        plain = F.filter(m["locality"], lambda h: ~F.array_contains(ambiguous, F.lower(h)))
        backed = F.when(
            F.size(sure) > 0,
            F.filter(m["locality"], lambda h: F.array_contains(ambiguous, F.lower(h))),
        ).otherwise(strings([]))
        return F.struct(
            m["name"].alias("name"),
            F.concat(sure, plain, backed).alias("hits"),
            m["district"].alias("districts"),
        )

    named = F.filter(fields, lambda f: spaced(f["text"]).rlike(anywhere))
    settled = F.transform(F.transform(named, match), settle)
    return F.filter(settled, lambda m: F.size(m["hits"]) > 0)


def contains_any(text: Column, markers: list[str]) -> Column:
    """Plain substring test against a list of markers, in one pass."""
    return text.rlike(alternation(markers)) if markers else F.lit(False)


def assess(df: DataFrame, rules: Rules, doc_text: Column | None = None, where: Column | None = None) -> DataFrame:
    """Adds ``geo``. Rows outside ``where`` are not read: they are judged like a bid without text."""
    g = rules.geography
    state = g["state"]
    texts = fields(doc_text)
    df = df.withColumn("_fields", texts if where is None else F.when(where, texts).otherwise(F.slice(texts, 1, 0)))
    df = df.withColumns(
        {
            "_matches": match_fields(F.col("_fields"), rules),
            "_blob": F.lower(F.array_join(F.transform("_fields", lambda f: f["text"]), " ")),
        }
    )
    df = df.withColumns(
        {
            "_terms": distinct_ci(F.flatten(F.transform("_matches", lambda m: m["hits"]))),
            "_where": F.transform("_matches", lambda m: m["name"]),
            "_districts": F.transform(
                distinct_ci(F.flatten(F.transform("_matches", lambda m: m["districts"]))), F.initcap
            ),
            "_nationwide": contains_any(F.col("_blob"), g["nationwide_markers"]),
            "_local_org": spaced("_blob").rlike(
                place_pattern(g["local_organisations"]).replace(" ", "\\s+")
            ),
        }
    )
    strong = F.arrays_overlap(F.col("_where"), strings(g["accept_fields"]))
    # As if the terms were counted, but a screen that asks for no more makes no lists.
    named = F.exists("_matches", lambda m: F.exists(m["hits"], lambda h: F.trim(h) != ""))
    nationwide = F.col("_nationwide") & F.lit(bool(g["keep_nationwide"]))
    in_region = strong | named | nationwide | F.col("_local_org")
    # Asked of bids outside the region only.
    df = df.withColumn("_others", F.when(
        ~in_region & contains_any(F.col("_blob"), g["other_states"]),
        let(F.col("_blob"), lambda b: F.filter(strings(g["other_states"]), lambda s: F.contains(b, s))),
    ).otherwise(strings([])))
    reason = (
        F.when(strong, F.concat(
            F.lit(f"{state} found in "), F.array_join("_where", ", "), F.lit(": "),
            F.array_join("_terms", ", "),
        ))
        .when(named, F.concat(
            F.lit(f"{state} mentioned, but not in a delivery/service/buyer-address field ("),
            F.array_join("_where", ", "), F.lit(") — confirm the actual work location"),
        ))
        .when(nationwide, f"Pan-India / multi-state tender: {state} is likely in scope but is "
              "not named — confirm the consignee list before bidding")
        .when(F.col("_local_org"), f"Buyer is an organisation that operates mainly in {state}, but no "
              f"{state} location is stated — confirm the delivery location")
        .when(F.size("_others") > 0, F.concat(
            F.lit(f"No {state} reference; locations point to "), F.array_join("_others", ", ")
        ))
        .otherwise(f"No {state} reference found in any location field")
    )
    confidence = (
        F.when(strong, CONFIRMED).when(named, INFERRED)
        .when(nationwide | F.col("_local_org"), UNCLEAR).otherwise(CONFIRMED)
    )
    return df.withColumn(
        "geo",
        F.struct(
            in_region.alias("in_region"),
            F.col("_terms").alias("matched_terms"),
            F.col("_where").alias("matched_fields"),
            F.col("_districts").alias("districts"),
            F.col("_nationwide").alias("nationwide"),
            confidence.alias("confidence"),
            reason.alias("reason"),
        ),
    ).drop("_fields", "_matches", "_blob", "_terms", "_where", "_districts", "_nationwide",
           "_local_org", "_others")
