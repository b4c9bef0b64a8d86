"""Reviewers' corrections: applied only where they come with a quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import let, literal
from bidlens.functions.lists import add_distinct, present, strings
from bidlens.functions.text import blank_to, clean
from bidlens.functions.values import short_number
from bidlens.operators.requirements import DOCUMENTS
from bidlens.rules import Rules
from bidlens.schema import INFERRED, UNCLEAR, evidence

# The payload and the kinds it may name.
PAYLOAD = (
    "struct<plain_summary:string,why_it_matters:string,next_action:string,risks:array<string>,"
    "is_it_related:boolean,tender_kind:string,classification_evidence:string,"
    "jharkhand_relevance:string,jharkhand_evidence:string,"
    "additional_required_documents:array<struct<name:string,evidence:string>>,"
    "key_eligibility_points:array<string>,key_technical_points:array<string>,"
    "unclear_points:array<string>>"
)
KINDS = ("product_supply", "service", "supply_and_service", "unknown")
BUYS = {
    "service": "is procuring services:",
    "supply_and_service": "is procuring supply and related services:",
    "product_supply": "is buying:",
    "unknown": "has published a requirement for:",
}
NARRATIVE = ("plain_summary", "why_it_matters", "next_action")


def read_payloads(df: DataFrame) -> DataFrame:
    """``identity_key, payload`` (JSON text) to ``identity_key, review`` (struct)."""
    return df.select("identity_key", F.from_json("payload", PAYLOAD).alias("review"))


def _lines(arr: Column) -> Column:
    cleaned = F.transform(F.coalesce(arr, strings([])), lambda x: clean(x))
    return F.filter(cleaned, lambda x: x != "")


def apply_corrections(df: DataFrame, payloads: DataFrame | None, rules: Rules) -> DataFrame:
    """Left-join the payloads and apply them; of several for a bid, the largest text counts."""
    empty = strings([])
    if payloads is None:
        return df.withColumns({n: F.lit("") for n in NARRATIVE} | {"risks": empty})
    state = rules.geography["state"]
    one = payloads.filter("identity_key <> ''").groupBy("identity_key").agg(F.max("payload").alias("payload"))
    df = df.join(read_payloads(one), "identity_key", "left")
    r, c, g = F.col("review"), F.col("classification"), F.col("geo")
    df = df.withColumns(
        {n: clean(r[n]) for n in NARRATIVE}
        | {
            "risks": _lines(r["risks"]),
            "_quote": clean(r["classification_evidence"]),
            "_place": clean(r["jharkhand_evidence"]),
            "_unclear": _lines(r["unclear_points"]),
            "_more_eligibility": _lines(r["key_eligibility_points"]),
            "_more_technical": _lines(r["key_technical_points"]),
            "_extra": F.transform(
                F.coalesce(r["additional_required_documents"], F.array().cast("array<struct<name:string,evidence:string>>")),
                lambda d: F.struct(clean(d["name"]).alias("name"), clean(d["evidence"]).alias("quote")),
            ),
        }
    )
    quoted = F.col("_quote") != ""
    flip = F.coalesce(quoted & (r["is_it_related"] != c["is_it_related"]), F.lit(False))
    kind = F.when(quoted & r["tender_kind"].isin(*KINDS), r["tender_kind"])
    says = r["jharkhand_relevance"]
    move = F.coalesce(
        says.isin("yes", "no") & (F.col("_place") != "") & ((says == "yes") != g["in_region"]), F.lit(False)
    )
    doubt = F.coalesce((says == "unclear") & g["in_region"], F.lit(False))

    def extra(known: Column) -> Column:
        named = F.filter("_extra", lambda d: (d["name"] != "") & (d["quote"] != ""))
        keyed = F.transform(
            named,
            lambda d: F.struct(
                F.concat(F.lit("llm:"), F.lower(d["name"])).alias("key"),
                d["name"].alias("name"),
                d["quote"].alias("quote"),
            ),
        )

        def new_ones(items: Column) -> Column:
            keys = F.array_except(F.array_distinct(F.transform(items, lambda d: d["key"])), known)

            def document(d: Column) -> Column:
                source = blank_to("source_url", F.lit("GeM tender documents"))
                return F.struct(
                    d["key"].alias("canonical"), d["name"].alias("name"), F.lit(INFERRED).alias("confidence"),
                    F.array(evidence(source, "tender documents (AI-identified)", d["quote"], "llm:review")).alias("evidence"),
                )

            return F.transform(
                keys, lambda k: document(F.get(F.filter(items, lambda d: d["key"] == k), F.lit(0)))
            ).cast(DOCUMENTS)

        return let(keyed, new_ones)

    q = F.col("requirements")
    df = df.withColumns(
        {
            "flags": add_distinct(
                add_distinct("flags", F.col("_unclear")),
                present(F.when(doubt, f"AI review could not confirm the {state} work location.")),
            ),
            "classification": c.withField("is_it_related", F.when(flip, r["is_it_related"]).otherwise(c["is_it_related"]))
            .withField("confidence", F.when(flip, INFERRED).otherwise(c["confidence"]))
            .withField("reason", F.when(flip, F.concat(
                F.lit("AI review overturned the keyword classification: "), "_quote"
            )).otherwise(c["reason"]))
            .withField("kind", F.coalesce(kind, c["kind"])),
            "geo": g.withField("in_region", F.when(move, says == "yes").otherwise(g["in_region"]))
            .withField("confidence", F.when(move, INFERRED).when(doubt, UNCLEAR).otherwise(g["confidence"]))
            .withField("reason", F.when(move, F.concat(
                F.lit("AI review of the documents: "), "_place"
            )).otherwise(g["reason"])),
            "required_documents": F.concat(
                "required_documents", extra(F.transform("required_documents", lambda d: d["canonical"]))
            ),
            "requirements": q.withField("eligibility", add_distinct(q["eligibility"], F.col("_more_eligibility")))
            .withField("technical", add_distinct(q["technical"], F.col("_more_technical"))),
        }
    )
    return df.drop("review", "_quote", "_place", "_unclear", "_more_eligibility", "_more_technical", "_extra")


def summary_text() -> Column:
    """One sentence built from the portal's facts."""
    buys = literal(BUYS, "map<string,string>")
    quantity = F.when(
        F.col("quantity") != 0,
        F.concat(F.lit(" ("), short_number("quantity"), F.lit(" "), blank_to("quantity_unit", F.lit("units")), F.lit(")")),
    )
    return clean(F.concat(
        blank_to("buyer_organization", "department", F.lit("A government buyer")), F.lit(" "),
        F.element_at(buys, F.col("classification.kind")), F.lit(" "),
        blank_to("item_description", "title", F.lit("an unspecified item")),
        F.coalesce(quantity, F.lit("")), F.lit(". Delivery/service location: "),
        blank_to("delivery_location", "buyer_address", F.lit("an unspecified location")), F.lit("."),
    ))


def fallback_summary(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "plain_summary", F.when(F.col("plain_summary") != "", F.col("plain_summary")).otherwise(summary_text())
    )
