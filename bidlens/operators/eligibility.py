"""How a bid fits the supplier profile. Adds ``eligibility``; never says eligible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import let, literal
from bidlens.functions.lists import present, strings
from bidlens.functions.values import rupees, short_number, to_number
from bidlens.operators import security
from bidlens.rules import Rules, clauses
from bidlens.schema import CONFIRMED, NOT_REQUIRED, REQUIRED

# The verdict vocabulary.
LIKELY, POTENTIAL = "Likely Suitable", "Potentially Suitable"
VERIFY, GAP = "Requires Verification", "Major Requirement Gap"


#: A supplier profile as a column; a null field is not known.
PROFILE = (
    "struct<legal_name:string,years_in_business:int,msme_registered:boolean,annual_turnover_inr:double,can_arrange_emd_upto_inr:double,"
    "strong:array<string>,moderate:array<string>,weak:array<string>,oem_held:array<string>,oem_obtainable:array<string>,"
    "government_supply_experience:boolean,service_districts:array<string>,min_attractive_value_inr:double,max_comfortable_value_inr:double,"
    "avoid_keywords:array<string>>"
)


def profile_of(rules: Rules) -> Column:
    """The rules' own profile as one constant."""
    return literal(rules.profile, PROFILE)


def _listed(profile: Column, name: str) -> Column:
    return F.coalesce(profile[name], strings([]))


def configured(profile: Column) -> Column:
    named = F.coalesce(profile["legal_name"], F.lit("")) != ""
    return (F.size(_listed(profile, "strong")) > 0) | (F.size(_listed(profile, "moderate")) > 0) | named


def capability(categories: Column, profile: Column) -> Column:
    """STRUCT<level, reason>: best profile level that lists one of the categories."""
    wording = {"strong": "core category", "moderate": "adjacent category", "weak": "outside usual scope"}
    low = F.transform(categories, lambda c: F.lower(c))
    hits = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                F.array_sort(F.array_intersect(low, F.transform(_listed(profile, level), lambda c: F.lower(c)))).alias("hit"),
                F.lit(words).alias("words"),
            )
            for level, words in wording.items()
        ]
    )
    known = configured(profile)

    def describe(best: Column) -> Column:
        return F.struct(
            F.when(known, F.coalesce(best["level"], F.lit("unknown"))).otherwise("unknown").alias("level"),
            F.when(known, F.coalesce(
                F.concat(best["words"], F.lit(" ("), F.array_join(best["hit"], ", "), F.lit(")")),
                F.lit("category not listed in the company profile"),
            )).otherwise("company profile not configured").alias("reason"),
        )

    return let(F.get(F.filter(hits, lambda h: F.size(h["hit"]) > 0), F.lit(0)), describe)


def serves_district(districts: Column, profile: Column) -> Column:
    """True / false / null when either side is not known."""
    mine = F.transform(_listed(profile, "service_districts"), lambda d: F.lower(d))
    low = F.transform(districts, lambda d: F.lower(d))
    return F.when((F.size(districts) > 0) & (F.size(mine) > 0), F.arrays_overlap(low, mine))


def required_turnover(lines: Column) -> Column:
    """Turnover figure of the first eligibility line that states one."""
    pattern = clauses.FLAGS + clauses.TURNOVER
    scales = literal(clauses.TURNOVER_SCALES, "map<string,double>")

    def read(line: Column) -> Column:
        factor = F.element_at(scales, F.lower(F.regexp_extract(line, pattern, 2)))
        return to_number(F.regexp_extract(line, pattern, 1)) * F.coalesce(factor, F.lit(1.0))

    return F.get(F.array_compact(F.transform(lines, read)), F.lit(0))


def required_years(lines: Column) -> Column:
    pattern = clauses.FLAGS + clauses.EXPERIENCE_YEARS
    return F.get(
        F.array_compact(
            F.transform(lines, lambda s: F.regexp_extract(s, pattern, 1).try_cast("int"))
        ),
        F.lit(0),
    )


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def assess_eligibility(df: DataFrame, rules: Rules, profile: Column | None = None) -> DataFrame:
    """By the rules' profile, or by each row's own ``profile`` (a PROFILE struct): the plan is the same for any number of profiles."""
    p = profile_of(rules) if profile is None else profile
    state = rules.geography["state"]
    df = df.withColumns(
        {
            "_cap": capability(F.col("classification.categories"), p),
            "_serves": serves_district(F.col("geo.districts"), p),
            "_turnover": required_turnover(F.col("requirements.eligibility")),
            "_years": required_years(F.col("requirements.eligibility")),
            "_asked": F.transform("required_documents", lambda d: d["canonical"]),
        }
    )
    level, reason = F.col("_cap.level"), F.col("_cap.reason")
    where = F.array_join("geo.districts", ", ")
    located = F.col("geo.in_region") & (F.col("geo.confidence") == CONFIRMED)
    turnover, years = F.col("_turnover"), F.col("_years").cast("string")
    emd, emd_known = F.col("emd.amount"), (F.col("emd.status") == REQUIRED) & F.col("emd.amount").isNotNull()
    support: list[Column] = []
    gaps: list[Column] = []
    verify: list[Column] = []

    verify.append(F.when(~configured(p), (
        "Everything below is unverified: the company profile has not "
        "been filled in, so the system has no basis to judge our capability."
    )))
    # Category.
    support.append(
        F.when(level == "strong", _text("Product/service category matches our core business — ", reason, "."))
        .when(level == "moderate", _text("Product/service category is workable for us — ", reason, "."))
    )
    gaps.append(F.when(level == "weak", _text("Category is outside our usual scope — ", reason, ".")))
    verify.append(
        F.when(level == "unknown", "Whether we can supply this category (company profile does not cover it).")
    )
    # Location.
    support.append(F.when(located, _text(
        "Work location is in our operating area (", F.when(where != "", where).otherwise(state), ")."
    )))
    verify.append(
        F.when(located & ~F.col("_serves"), _text(
            "Service coverage in ", where, " — outside the districts listed in our profile."
        )).when(F.col("geo.in_region") & ~located, _text("Actual work location — ", F.col("geo.reason"), "."))
    )
    # Manufacturer authorisation.
    needs_oem = F.array_contains("_asked", "oem_authorization")
    held, obtainable = _listed(p, "oem_held"), _listed(p, "oem_obtainable")
    names, sources = F.array_join(held, ", "), F.array_join(obtainable, ", ")
    has, may = F.size(held) > 0, F.size(obtainable) > 0
    verify.append(F.when(needs_oem & has, _text(
        "OEM Authorization (MAF) for the exact make/model this bid asks for — we hold authorisations for ", names, "."
    )).when(needs_oem & may, _text("OEM Authorization (MAF) must be arranged before bidding — obtainable from ", sources, ".")))
    gaps.append(F.when(needs_oem & ~has & ~may, "OEM Authorization Letter is required and no OEM authorisation is recorded in our profile."))
    # Turnover.
    ours = p["annual_turnover_inr"]
    verify.append(F.when(ours.isNull(), _text(
        "Turnover requirement of about ", rupees(turnover), " — our turnover is not recorded in the company profile."
    )))
    support.append(F.when(turnover <= ours, _text("Stated turnover requirement (", rupees(turnover), ") appears met.")))
    gaps.append(F.when(turnover > ours, _text(
        "Turnover requirement of ", rupees(turnover), " exceeds our recorded turnover (", rupees(ours), ")."
    )))
    # Experience.
    age = p["years_in_business"]
    verify.append(F.when(age.isNull(), _text("Requirement of ", years, " years' experience.")))
    support.append(F.when(F.col("_years") <= age, _text(years, "-year experience requirement appears met.")))
    gaps.append(F.when(F.col("_years") > age, _text(years, " years' experience required; profile records ", age.cast("string"), ".")))
    past = F.arrays_overlap(F.col("_asked"), strings(["work_order", "completion_certificate", "experience"]))
    supplied = p["government_supply_experience"]
    verify.append(F.when(past & supplied.isNull(), (
        "Past government supply experience (work orders / completion certificates) — not recorded in our profile."
    )))
    support.append(F.when(past & supplied, "We have prior government supply experience on record."))
    gaps.append(F.when(past & ~supplied, (
        "Past work orders / completion certificates are required and we have no recorded government supply experience."
    )))
    # Deposit.
    cap = p["can_arrange_emd_upto_inr"]
    no_emd = F.col("emd.status") == NOT_REQUIRED
    relief = F.coalesce(p["msme_registered"], F.lit(False)) & (F.col("emd.msme_exemption") == REQUIRED)
    verify.append(
        F.when(emd_known & cap.isNull(), _text("Ability to fund EMD of ", rupees(emd), "."))
        .when(~emd_known & ~no_emd, "EMD requirement is not stated clearly in the source.")
    )
    gaps.append(F.when(emd_known & (emd > cap), _text(
        "EMD of ", rupees(emd), " exceeds the ", rupees(cap), " we have recorded as arrangeable."
    )))
    support.append(
        F.when(emd_known & (emd <= cap) & relief, "MSME EMD exemption appears available to us.").when(no_emd, "No EMD is required.")
    )
    # Performance security.
    head = security.headline()
    verify.append(
        F.when((head == security.HEAD_REQUIRED) & F.col("security.percentage").isNotNull(), _text(
            "Performance security of ", short_number("security.percentage"), "% must be arranged if we win."))
        .when(head == security.HEAD_UNKNOWN, "Performance security / ePBG terms are not stated clearly.")
    )
    # Work to stay away from.
    blob = F.lower(F.concat_ws(" ", "title", "item_description"))
    avoided = F.transform(
        F.filter(_listed(p, "avoid_keywords"), lambda k: F.contains(blob, F.lower(k))),
        lambda k: _text("Matches an avoid-list keyword: '", k, "'."),
    )

    df = df.withColumns({"_support": present(*support), "_gaps": F.concat(present(*gaps), avoided), "_verify": present(*verify)})
    n_gaps, n_support = F.size("_gaps"), F.size("_support")
    likely = (level == "strong") & (n_support >= 3) & (F.size("_verify") <= 2)
    grade = (
        F.when(~configured(p), F.lit("UNKNOWN"))
        .when((n_gaps >= 2) | ((n_gaps > 0) & (level == "weak")), "LOW")
        .when(n_gaps > 0, "MEDIUM")
        .when(likely, "HIGH")
        .when(level.isin("strong", "moderate") & (n_support > 0), "MEDIUM")
        .otherwise("UNKNOWN")
    )
    df = df.withColumn("_grade", grade)
    verdict = (
        F.when(F.col("_grade") == "LOW", GAP)
        .when(F.col("_grade") == "HIGH", LIKELY)
        .when((F.col("_grade") == "MEDIUM") & (n_gaps == 0), POTENTIAL)
        .otherwise(VERIFY)
    )
    return df.withColumn(
        "eligibility",
        F.struct(
            F.col("_grade").alias("match_level"),
            verdict.alias("verdict"),
            F.col("_support").alias("supporting_points"),
            F.col("_gaps").alias("gaps"),
            F.col("_verify").alias("verification_points"),
        ),
    ).drop("_cap", "_serves", "_turnover", "_years", "_asked", "_support", "_gaps", "_verify", "_grade")
