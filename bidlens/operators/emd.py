"""Earnest-money clauses. Adds ``emd``; the portal's own figure always wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions.lists import add_distinct, present, strings
from bidlens.functions.text import clean, find, snippet
from bidlens.functions.values import parse_amount, rupees
from bidlens.rules import clauses
from bidlens.schema import EVIDENCE_LIST, NOT_REQUIRED, NOT_STATED, REQUIRED, evidence

FLAG_NO_TEXT = "EMD could not be determined: no document text was available."
FLAG_UNREAD = (
    "EMD is mentioned in the tender documents but no amount or "
    "exemption could be read — verify the EMD clause manually."
)
# Headlines.
HEADLINES = {
    NOT_REQUIRED: "✅ NO EMD REQUIRED",
    REQUIRED: "💰 EMD REQUIRED",
    NOT_STATED: "⚠ EMD INFORMATION NOT CLEAR – MANUAL VERIFICATION REQUIRED",
}


def cleaned_document(df: DataFrame) -> DataFrame:
    """Adds ``_doc``: the document text, cleaned once for all clause rules."""
    return df.withColumn("_doc", clean("doc_text"))


def place(*hits: tuple[str, str]) -> Column:
    """0-based position in ``_doc`` of the first (column, pattern) whose column holds a match; the pattern itself is located."""
    return F.coalesce(*[F.when(F.col(c).isNotNull(), F.regexp_instr("_doc", F.lit(p)) - 1) for c, p in hits])


def quoted(at: Column, extractor: str) -> Column:
    """Evidence for what stands at a position of ``_doc``."""
    return evidence(F.col("source_url"), "tender documents", snippet("_doc", at), extractor)


def headline(status: Column | str = "emd.status") -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return (
        F.when(s == NOT_REQUIRED, HEADLINES[NOT_REQUIRED])
        .when(s == REQUIRED, HEADLINES[REQUIRED])
        .otherwise(HEADLINES[NOT_STATED])
    )


def analyze_emd(df: DataFrame) -> DataFrame:
    """Needs ``_doc``."""
    doc, portal = F.col("_doc"), F.col("portal_emd_amount")
    rules = {k: clauses.FLAGS + v for k, v in clauses.EMD.items()}

    # Nothing below can match a text without any of these words.
    talks = doc.rlike(clauses.FLAGS + "emd|earnest|bid\\s+security|exempt")

    def hit(name: str, group: int = 0) -> Column:
        return F.when(talks, find(doc, rules[name], group))

    df = df.withColumns(
        {
            "_nil": hit("nil"),
            "_after": hit("amount_after"),
            "_before": hit("amount_before"),
            "_msme": hit("msme_exempt"),
            "_startup": hit("startup_exempt"),
        }
    )
    figure = F.when(F.col("_after").isNotNull(), hit("amount_after", 1)).when(
        F.col("_before").isNotNull(), hit("amount_before", 1)
    )
    df = df.withColumns(
        {
            "_amount": parse_amount(figure, cleaned=True),
            "_decided": portal.isNotNull(),
        }
    )
    amount = F.col("_amount")
    status = (
        F.when(F.col("_decided") & (portal > 0), REQUIRED)
        .when(F.col("_decided"), NOT_REQUIRED)
        .when(doc == "", NOT_STATED)
        .when(amount > 0, REQUIRED)
        .when(F.col("_nil").isNotNull(), NOT_REQUIRED)
        .when(amount == 0, NOT_REQUIRED)
        .otherwise(NOT_STATED)
    )
    exempt = F.col("_msme").isNotNull() | F.col("_startup").isNotNull()
    rule = "rule:emd"
    figure_at = place(("_after", rules["amount_after"]), ("_before", rules["amount_before"]))
    status_proof = F.when(amount > 0, figure_at).otherwise(F.coalesce(place(("_nil", rules["nil"])), figure_at))
    df = df.withColumns({"_status": status, "_status_proof": status_proof, "_at": figure_at})
    proofs = present(
        *[F.when(doc.rlike(clauses.FLAGS + p), F.lit(n)) for n, p in clauses.EMD_PROOFS.items()]
    )
    found = F.array_compact(
        F.array(
            F.when(F.col("_decided"), evidence(F.col("source_url"), "bid detail page", F.lit(""), "portal_field")),
            F.when(
                ~F.col("_decided") & (F.col("_status") != NOT_STATED), quoted(F.col("_status_proof"), rule)
            ),
            F.when(F.col("_msme").isNotNull(), quoted(place(("_msme", rules["msme_exempt"])), rule)),
        )
    ).cast(EVIDENCE_LIST)
    amount_evidence = F.when(
        F.col("_decided"),
        F.array(evidence(F.col("source_url"), "EMD amount field", F.col("portal_emd_text"), "portal_field")),
    ).when(amount.isNotNull(), F.array(quoted(F.col("_at"), rule))).otherwise(F.array().cast(EVIDENCE_LIST))
    df = df.withColumn(
        "emd",
        F.struct(
            F.col("_status").alias("status"),
            F.coalesce(portal, amount).alias("amount"),
            amount_evidence.alias("amount_evidence"),
            F.nullif(clean(hit("payment_mode", 1), normalise=False), F.lit("")).alias("payment_mode"),
            F.nullif(clean(hit("last_date", 1), normalise=False), F.lit("")).alias("last_date"),
            F.when(exempt, REQUIRED).otherwise(NOT_STATED).alias("exemption_available"),
            F.when(F.col("_msme").isNotNull(), REQUIRED).otherwise(F.col("msme_portal_flag")).alias("msme_exemption"),
            F.when(F.col("_startup").isNotNull(), REQUIRED).otherwise(F.col("startup_portal_flag")).alias("startup_exemption"),
            F.when(exempt, proofs).otherwise(strings([])).alias("exemption_proof_required"),
            found.alias("evidence"),
        ),
    )
    conflict = F.col("_decided") & (F.abs(portal - amount) > 1)
    flags = present(
        F.when((doc == "") & ~F.col("_decided"), FLAG_NO_TEXT),
        F.when(
            (doc != "") & ~F.col("_decided") & (F.col("_status") == NOT_STATED) & doc.rlike(rules["mention"]),
            FLAG_UNREAD,
        ),
        F.when(
            conflict,
            F.concat(
                F.lit("EMD amount differs between the GeM listing ("), rupees(portal),
                F.lit(") and the bid document ("), rupees(amount),
                F.lit(") — confirm which applies before paying."),
            ),
        ),
    )
    return df.withColumn("flags", add_distinct("flags", flags)).drop(
        "_nil", "_after", "_before", "_msme", "_startup", "_amount", "_at", "_decided", "_status",
        "_status_proof",
    )
