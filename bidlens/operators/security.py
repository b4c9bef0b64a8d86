"""Performance security, ePBG and security deposit. Adds ``security``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions.lists import add_distinct, present, strings
from bidlens.functions.text import clean, find
from bidlens.functions.values import parse_amount, rupees, short_number, to_number
from bidlens.operators.emd import place, quoted
from bidlens.rules import clauses
from bidlens.schema import EVIDENCE_LIST, NOT_REQUIRED, NOT_STATED, REQUIRED, evidence

# Headlines, labels in the order they are named, caveats.
HEAD_REQUIRED, HEAD_NOT_REQUIRED, HEAD_UNKNOWN = "Required", "Not Required", "⚠ Verification Required"
NAMED = {"epbg": "ePBG", "performance_security": "Performance Security", "security_deposit": "Security Deposit"}
LINE_UNKNOWN = "⚠ Verification Required — the tender documents do not state this clearly"
LINE_CAVEAT = (
    " — ⚠ no separate performance-security clause was found in the "
    "text we could read; confirm in the bid document"
)
FLAG_NO_TERMS = (
    "Performance security / ePBG is mentioned but its amount or "
    "percentage is not stated clearly — verify before bidding."
)


def _status(root: str) -> list[Column]:
    return [F.col(f"{root}{n}") for n in clauses.INSTRUMENTS]


def headline(root: str = "security.") -> Column:
    flags = F.array(*_status(root))
    return (
        F.when(F.array_contains(flags, REQUIRED), HEAD_REQUIRED)
        .when(F.array_contains(flags, NOT_REQUIRED), HEAD_NOT_REQUIRED)
        .otherwise(HEAD_UNKNOWN)
    )


def fully_stated(root: str = "security.") -> Column:
    return ~F.array_contains(F.array(*_status(root)), NOT_STATED)


def analyze_security(df: DataFrame) -> DataFrame:
    """Needs ``_doc``."""
    doc, portal = F.col("_doc"), F.col("portal_epbg_pct")
    rules = {k: clauses.FLAGS + v for k, v in clauses.SECURITY.items()}
    names = {k: clauses.FLAGS + v for k, v in clauses.INSTRUMENTS.items()}
    talks = doc.rlike(clauses.FLAGS + "performance\\s+(?:security|bank)|pbg|security\\s+deposit|valid")

    def hit(name: str, group: int = 0) -> Column:
        return F.when(talks, find(doc, rules[name], group))

    df = df.withColumns(
        {"_nil": hit("nil"), "_pct": hit("percentage"), "_amt": hit("amount")}
        | {f"_m_{n}": F.when(talks, find(doc, p)) for n, p in names.items()}
    )

    def from_text(name: str) -> Column:
        return (
            F.when(F.col(f"_m_{name}").isNull(), NOT_STATED)
            .when(F.col("_nil").rlike(names[name]), NOT_REQUIRED)
            .otherwise(REQUIRED)
        )

    df = df.withColumns({f"_s_{n}": from_text(n) for n in names})
    df = df.withColumn(
        "_s_epbg",
        F.when(portal > 0, REQUIRED).when(portal.isNotNull(), NOT_REQUIRED).otherwise(F.col("_s_epbg")),
    )
    digits = F.coalesce(hit("percentage", 1), hit("percentage", 2))
    df = df.withColumns(
        {
            "_percentage": F.coalesce(portal, to_number(digits)),
            "_amount": parse_amount(hit("amount", 1), cleaned=True),
        }
    )
    silent = F.lit(True)
    for n in names:
        silent = silent & (F.col(f"_s_{n}") == NOT_STATED)
    # A percentage without a named instrument still means something is owed.
    df = df.withColumn(
        "_s_performance_security",
        F.when(F.col("_percentage").isNotNull() & silent, REQUIRED).otherwise(F.col("_s_performance_security")),
    )
    rule = "rule:security"

    def proof(name: str) -> Column:
        told = F.col(f"_m_{name}").isNotNull()
        if name == "epbg":
            told = told & portal.isNull()
        at = F.when(F.col("_nil").rlike(names[name]), place(("_nil", rules["nil"]))).otherwise(place((f"_m_{name}", names[name])))
        return F.when(told, quoted(at, rule))

    none = F.array().cast(EVIDENCE_LIST)
    exempt = hit("exemption")
    df = df.withColumn(
        "security",
        F.struct(
            *[F.col(f"_s_{n}").alias(n) for n in names],
            F.col("_percentage").alias("percentage"),
            F.when(
                portal.isNotNull(),
                F.array(evidence(F.col("source_url"), "ePBG percentage field", F.col("portal_epbg_text"), "portal_field")),
            ).when(F.col("_percentage").isNotNull(), F.array(quoted(place(("_pct", rules["percentage"])), rule))).otherwise(none).alias("percentage_evidence"),
            F.col("_amount").alias("amount"),
            F.when(F.col("_amount").isNotNull(), F.array(quoted(place(("_amt", rules["amount"])), rule))).otherwise(none).alias("amount_evidence"),
            F.nullif(clean(F.coalesce(hit("validity_near", 1), hit("validity")), normalise=False), F.lit("")).alias("validity"),
            F.nullif(clean(hit("timeline", 1), normalise=False), F.lit("")).alias("submission_timeline"),
            F.when(exempt.isNotNull(), F.array(clean(exempt, normalise=False)))
            .otherwise(strings([])).alias("exemptions"),
            F.array_compact(
                F.array(
                    F.when(portal.isNotNull(), evidence(F.col("source_url"), "bid detail page", F.lit(""), "portal_field")),
                    *[proof(n) for n in names],
                )
            ).cast(EVIDENCE_LIST).alias("evidence"),
        ),
    )
    mentioned = F.col("_m_performance_security").isNotNull() | F.col("_m_epbg").isNotNull()
    unclear = F.when((headline() == HEAD_UNKNOWN) & mentioned, FLAG_NO_TERMS)
    drop = ["_nil", "_pct", "_amt", "_percentage", "_amount"]
    drop += [f"_m_{n}" for n in names] + [f"_s_{n}" for n in names]
    return df.withColumn("flags", add_distinct("flags", present(unclear))).drop(*drop)


def security_line() -> Column:
    """One-line summary of the ``security`` struct."""

    def named(status: str) -> Column:
        return F.array_join(
            present(*[F.when(F.col(f"security.{n}") == status, F.lit(label)) for n, label in NAMED.items()]),
            " / ",
        )

    required = F.array_join(
        present(
            F.concat(named(REQUIRED), F.lit(": Required")),
            F.concat(short_number("security.percentage"), F.lit("% of contract value")),
            rupees("security.amount"),
            F.concat(F.lit("validity "), F.col("security.validity")),
            F.concat(F.lit("submit within "), F.col("security.submission_timeline")),
        ),
        " — ",
    )
    return (
        F.when(headline() == HEAD_UNKNOWN, LINE_UNKNOWN)
        .when(
            headline() == HEAD_NOT_REQUIRED,
            F.concat(
                named(NOT_REQUIRED), F.lit(": Not Required"),
                F.when(fully_stated(), "").otherwise(LINE_CAVEAT),
            ),
        )
        .otherwise(required)
    )
