"""Is it in the taxonomy, and is it a purchase, a service or both?

Adds ``classification``: is_it_related, kind, categories, matched_signals,
vetoed_by, confidence, reason.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import let, literal
from bidlens.functions.lists import distinct_ci
from bidlens.functions.terms import TermTable
from bidlens.functions.text import clean, normalize_key
from bidlens.rules import Rules
from bidlens.schema import CONFIRMED, INFERRED, NOT_FOUND


@lru_cache(maxsize=8)
def _tables(terms: tuple[str, ...]) -> TermTable:
    return TermTable(terms)


def table(terms: list[str]) -> TermTable:
    return _tables(tuple(t.lower() for t in terms))


def haystack(doc_text: Column | None = None) -> Column:
    """Everything a bid says, as one cleaned lower-case string."""
    parts = [
        F.nullif(F.col(c), F.lit(""))
        for c in ("title", "category", "item_description", "buyer_organization", "department",
                  "listing_text")
    ]
    if doc_text is not None:
        parts.append(F.nullif(doc_text, F.lit("")))
    return F.lower(clean(F.concat_ws(" ", *parts)))


def headline() -> Column:
    """What the buyer calls the bid: title, category and item."""
    return normalize_key(F.concat_ws(" ", "title", "category", "item_description"))


def _layout(rules: Rules) -> tuple[list[str], list[dict]]:
    """All signals and negatives in one list, with each group's ranges in it."""
    terms: list[str] = []
    spans = []
    for group in rules.groups:
        start = len(terms)
        terms += group["signals"]
        middle = len(terms)
        terms += group["negatives"]
        spans.append({**group, "start": start, "middle": middle, "end": len(terms)})
    return terms, spans


def match_groups(text: Column, rules: Rules) -> Column:
    """ARRAY<STRUCT<label, kind, hits, negatives>>, one entry per group with a hit."""
    terms, spans = _layout(rules)
    book = table(terms + rules.taxonomy["hard_vetoes"])
    table_of = literal(
        [{k: s[k] for k in ("label", "kind", "start", "middle", "end")} for s in spans]
        + [{"label": "", "kind": "veto", "start": len(terms), "middle": len(book.terms), "end": 0}],
        "array<struct<label:string,kind:string,start:int,middle:int,end:int>>",
    )

    def between(numbers: Column, lo: Column, hi: Column) -> Column:
        return book.names(F.filter(numbers, lambda i: (i >= lo) & (i < hi)))

    def groups(numbers: Column) -> Column:
        hit = F.filter(table_of, lambda g: F.exists(numbers, lambda i: (i >= g["start"]) & (i < g["middle"])))
        return F.transform(
            F.when(F.size(numbers) > 0, hit).otherwise(F.slice(table_of, 1, 0)),
            lambda g: F.struct(
                g["label"].alias("label"),
                g["kind"].alias("kind"),
                between(numbers, g["start"], g["middle"]).alias("hits"),
                between(numbers, g["middle"], g["end"]).alias("negatives"),
            ),
        )

    return let(book.numbers(text), groups)


def outweighed(group: Column) -> Column:
    """Do the negatives veto the group? Only if they are as many as the hits."""
    n = F.size(group["negatives"])
    return (n > 0) & (n >= F.size(group["hits"]))


def _kind(rules: Rules, head: Column, text: Column, kept: Column) -> Column:
    supply, service = table(rules.taxonomy["supply_verbs"]), table(rules.taxonomy["service_verbs"])
    in_head = F.struct(supply.occurs(head).alias("buy"), service.occurs(head).alias("serve"))

    def by_group(kept: Column) -> Column:
        product = F.exists(kept, lambda g: g["kind"] == "product")
        serving = F.exists(kept, lambda g: g["kind"] == "service")
        return (
            F.when(serving & ~product, "service")
            .when(product & ~serving, "product_supply")
            .otherwise("unknown")
        )

    def by_body(balance: Column) -> Column:
        return (
            F.when(balance > 0, "service")
            .when(balance < 0, "product_supply")
            .otherwise(by_group(kept))
        )

    body = let(F.size(service.numbers(text)) - F.size(supply.numbers(text)), by_body)
    return let(
        in_head,
        lambda h: F.when(h["buy"] & h["serve"], "supply_and_service")
        .when(h["buy"], "product_supply")
        .when(h["serve"], "service")
        .otherwise(body),
    )


def classify(df: DataFrame, rules: Rules, doc_text: Column | None = None, where: Column | None = None) -> DataFrame:
    """Adds ``classification``. Rows outside ``where`` are not read: they are classified like a bid without text."""
    all_signals = table([t for g in rules.groups for t in g["signals"]])
    text, head = haystack(doc_text), headline()
    if where is not None:
        text, head = F.when(where, text).otherwise(""), F.when(where, head).otherwise("")
    df = df.withColumns({"_text": text, "_head": head})
    df = df.withColumn("_groups", match_groups(F.col("_text"), rules))
    df = df.withColumns(
        {
            "_kept": F.filter("_groups", lambda g: (g["kind"] != "veto") & ~outweighed(g)),
            "_vetoed_by": F.concat(
                F.flatten(
                    F.transform(
                        F.filter("_groups", lambda g: g["kind"] == "veto"), lambda g: g["hits"]
                    )
                ),
                F.transform(
                    F.filter("_groups", lambda g: (g["kind"] != "veto") & outweighed(g)),
                    lambda g: F.concat(
                        g["label"], F.lit(" ("), F.array_join(g["negatives"], ", "), F.lit(")")
                    ),
                ),
            ),
        }
    )
    df = df.withColumns(
        {
            "_cats": distinct_ci(F.transform("_kept", lambda g: g["label"])),
            "_sigs": distinct_ci(F.flatten(F.transform("_kept", lambda g: g["hits"]))),
        }
    )
    # As if the categories were counted, but a screen that asks for no more makes no lists.
    related = F.exists("_kept", lambda g: F.trim(g["label"]) != "")
    df = df.withColumns(
        {
            "_in_head": related
            & F.arrays_overlap(F.col("_sigs"), all_signals.names(all_signals.numbers(F.col("_head")))),
            "_kind": F.when(related, _kind(rules, F.col("_head"), F.col("_text"), F.col("_kept")))
            .otherwise("unknown"),
        }
    )
    vetoed = F.size("_vetoed_by") > 0
    reason = (
        F.when(
            related,
            F.concat(
                F.lit("Matched "), F.array_join("_cats", ", "), F.lit(" on "),
                F.when(F.col("_in_head"), "title/category").otherwise("tender documents"),
                F.lit(" via: "), F.array_join("_sigs", ", "),
            ),
        )
        .when(vetoed, F.concat(F.lit("No IT signal matched; vetoed by "), F.array_join("_vetoed_by", ", ")))
        .otherwise("No IT product or service signal found in title, category or documents")
    )
    confidence = (
        F.when(related & F.col("_in_head"), CONFIRMED)
        .when(related, INFERRED)
        .when(vetoed, CONFIRMED)
        .otherwise(NOT_FOUND)
    )
    return df.withColumn(
        "classification",
        F.struct(
            related.alias("is_it_related"),
            F.col("_kind").alias("kind"),
            F.col("_cats").alias("categories"),
            F.col("_sigs").alias("matched_signals"),
            F.col("_vetoed_by").alias("vetoed_by"),
            confidence.alias("confidence"),
            reason.alias("reason"),
        ),
    ).drop("_text", "_head", "_groups", "_kept", "_vetoed_by", "_cats", "_sigs", "_in_head", "_kind")
