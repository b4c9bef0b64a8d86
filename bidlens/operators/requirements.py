"""Required documents and requirement lines, sentence by sentence.

Everything works on the bid's own array of sentences: no explode, no shuffle.
Adds ``required_documents`` and ``requirements``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import let
from bidlens.functions.lists import add_distinct, present, strings
from bidlens.rules import Rules
from bidlens.rules.clauses import FLAGS
from bidlens.schema import CONFIRMED, EVIDENCE_LIST, UNCLEAR, evidence

DOCUMENTS = f"array<struct<canonical:string,name:string,confidence:string,evidence:{EVIDENCE_LIST}>>"
FLAG_NO_TEXT = (
    "Required-documents list is unavailable: no tender document text "
    "could be read. Open the bid on GeM to confirm what to upload."
)
FLAG_NO_DOCUMENTS = (
    "No specific document requirements were stated in the text we could "
    "read — check the bid's 'Documents Required' section on GeM."
)


def sentences(text: Column) -> Column:
    """Split after . ; : into pieces; blank ones go."""
    return F.filter(
        F.split(text, "(?U)(?<=[.;:])\\s+"), lambda s: s != ""
    )


def collect(lines: Column, cues: list[str]) -> Column:
    """The different sentences with a cue, in order."""
    pattern = FLAGS + "|".join(f"(?:{c})" for c in cues)

    def pick(hits: Column) -> Column:
        keys = F.transform(hits, lambda s: F.lower(s))
        return let(
            keys,
            lambda k: F.transform(
                F.array_distinct(k),
                lambda key: F.get(hits, F.array_position(k, key).cast("int") - 1),
            ),
        )

    return let(F.filter(lines, lambda s: s.rlike(pattern)), pick)


def required_documents(lines: Column, rules: Rules, source_url: Column) -> Column:
    """Documents a sentence demands by name; a firm sentence beats a hedged one."""
    table = rules.requirements
    demand, hedge = FLAGS + table["demand"], FLAGS + table["hedge"]
    asks = F.transform(
        F.filter(lines, lambda s: s.rlike(demand)),
        lambda s: F.struct(s.alias("text"), s.rlike(hedge).alias("hedged")),
    )

    def naming(asks: Column, pattern: str) -> Column:
        return F.filter(asks, lambda a: a["text"].rlike(FLAGS + pattern))

    def per_document(asks: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(canonical).alias("canonical"),
                    F.lit(name).alias("name"),
                    naming(asks, pattern).alias("asks"),
                )
                for canonical, name, pattern in table["documents"]
            ]
        )

    def quote(ask: Column) -> Column:
        return evidence(source_url, "tender documents", ask["text"], "rule:required_documents")

    def settle(doc: Column) -> Column:
        first = F.get(doc["asks"], F.lit(0))
        firm = F.filter(doc["asks"], lambda a: ~a["hedged"])
        firm_later = F.when(first["hedged"] & (F.size(firm) > 0), quote(F.get(firm, F.lit(0))))
        unclear = F.size(firm) == 0
        return F.struct(
            unclear.alias("unclear"),
            doc["name"].alias("name"),
            doc["canonical"].alias("canonical"),
            F.array_compact(F.array(firm_later, quote(first))).alias("evidence"),
        )

    def collected(asks: Column) -> Column:
        found = F.filter(per_document(asks), lambda d: F.size(d["asks"]) > 0)
        return F.transform(
            # Their names differ, so the order is that of array_sort, without its comparator.
            F.sort_array(F.transform(found, settle)),
            lambda d: F.struct(
                d["canonical"].alias("canonical"),
                d["name"].alias("name"),
                F.when(d["unclear"], UNCLEAR).otherwise(CONFIRMED).alias("confidence"),
                d["evidence"].alias("evidence"),
            ),
        ).cast(DOCUMENTS)

    return let(
        asks, lambda a: F.when(F.size(a) > 0, collected(a)).otherwise(F.array().cast(DOCUMENTS))
    )


def extract_requirements(df: DataFrame, rules: Rules) -> DataFrame:
    """Needs ``_doc``."""
    df = df.withColumn("_lines", sentences(F.col("_doc")))
    cues = rules.requirements["cues"]
    lists = {
        name: collect(F.col("_lines"), patterns)
        for name, patterns in cues.items()
    }
    df = df.withColumns(
        {
            "required_documents": required_documents(F.col("_lines"), rules, F.col("source_url")),
            "_payment": lists.pop("payment"),
        }
    )
    df = df.withColumn(
        "requirements",
        F.struct(
            *[c.alias(n) for n, c in lists.items()],
            F.get("_payment", F.lit(0)).alias("payment_terms"),
        ),
    )
    empty = F.size("required_documents") == 0
    flags = present(
        F.when((F.col("_doc") == "") & empty, FLAG_NO_TEXT),
        F.when((F.col("_doc") != "") & empty, FLAG_NO_DOCUMENTS),
    )
    return df.withColumn("flags", add_distinct("flags", flags)).drop("_lines", "_payment")
