"""The daily analysis: screen, analyse, judge. Lazy DataFrames throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.operators.classify import classify
from bidlens.operators.corrections import NARRATIVE, apply_corrections, fallback_summary
from bidlens.operators.eligibility import assess_eligibility
from bidlens.operators.emd import analyze_emd, cleaned_document
from bidlens.operators.gate import dated_out, deadline, listing_reason, screen_reason, verdict
from bidlens.operators.geo import assess
from bidlens.operators.requirements import extract_requirements
from bidlens.operators.scoring import score
from bidlens.operators.security import analyze_security
from bidlens.rules import Rules
from bidlens.schema import FLAGS, OTHER, TEXT, conform
from bidlens.session import keep, spread, stable

#: What changes from day to day and no text rule reads.
DATED = ("published_at", "bid_start_at", "bid_end_at", "bid_open_at", "estimated_value")
#: What the text rules find; it depends on ``text_print`` alone.
FOUND = (
    "classification", "geo", "emd", "security", "required_documents", "requirements", "flags", *NARRATIVE, "risks",
    "eligibility",
)
#: What the clause rules read of a bid besides its address, and what they find.
CLAUSE_INPUT = (
    "doc_text", "portal_emd_amount", "portal_emd_text", "portal_epbg_pct", "portal_epbg_text", "msme_portal_flag", "startup_portal_flag", "flags",
)
CLAUSES = ("emd", "security", "required_documents", "requirements")
#: Texts recur if there are so many times more bids than different inputs.
RECURS = 4
#: Bids that one task of ``run_again`` analyses.
NEWS_PER_TASK = 10_000


def screen(bids: DataFrame, rules: Rules, now: str) -> DataFrame:
    """Cheap first pass on listing data; adds screen_reason (null = shortlisted).

    The day test comes first: the text of a bid that its closing date rules out is not read.
    """
    df = deadline(conform(bids), rules, now).withColumn("_dated_out", dated_out(rules))
    open_ = F.col("_dated_out").isNull()
    df = assess(classify(df, rules, where=open_), rules, where=open_)
    return df.withColumn("screen_reason", screen_reason(rules)).drop("_dated_out")


def screen_reasons(bids: DataFrame, rules: Rules, now: str) -> DataFrame:
    """The bids with screen_reason as ``screen`` gives it, without what it found: each test reads only bids that passed the one before."""
    df = deadline(conform(bids), rules, now).withColumn("_dated_out", dated_out(rules))
    open_ = F.col("_dated_out").isNull()
    df = classify(df, rules, where=open_)
    df = assess(df, rules, where=open_ & F.col("classification.is_it_related"))
    return df.withColumn("screen_reason", screen_reason(rules)).drop("_dated_out", "classification", "geo")


def screen_once(bids: DataFrame, rules: Rules, now: str) -> DataFrame:
    """Every bid with screen_reason, written once for all who ask for it; ``text_print`` of those still open.

    Of a bid that is screened out no more is kept than its key and these (the rest is null).
    """
    df = screen_reasons(bids, rules, now).withColumn("text_print", F.when(dated_out(rules).isNull(), text_print()))
    always = ("identity_key", "screen_reason", "text_print")
    fits = F.col("screen_reason").isNull()
    return stable(df.select(*[F.col(c) if c in always else F.when(fits, F.col(c)).alias(c) for c in df.columns]))


def shortlist(bids: DataFrame, rules: Rules, now: str) -> DataFrame:
    """The bids that ``screen`` lets through, without its column.

    The day test is a plain filter below all text work: bids that their closing date rules out
    (most of a listing) are dropped before their texts are made, moved, cleaned or matched.
    """
    return _fitting(_open(bids, rules, now), rules)


def _open(bids: DataFrame, rules: Rules, now: str) -> DataFrame:
    return deadline(conform(bids), rules, now).filter(dated_out(rules).isNull())


def _fitting(open_: DataFrame, rules: Rules) -> DataFrame:
    # The tests of screen_reason in their order: where a bid lies is asked of those in the taxonomy only.
    related = keep(classify(open_, rules), F.col("classification.is_it_related"))
    return keep(assess(related, rules), F.col("geo.in_region"))


def looked_at(bids: DataFrame, rules: Rules, now: str) -> DataFrame:
    """Every bid with its class and region by the listing, whatever its closing date."""
    return assess(classify(deadline(conform(bids), rules, now), rules), rules)


def analyse(
    shortlist: DataFrame, rules: Rules, now: str, corrections: DataFrame | None = None, once: bool = False
) -> DataFrame:
    """Full analysis of conformed bids with their document text; ``once`` for a written table (see ``clauses_once``)."""
    return score(read_texts(deadline(shortlist, rules, now), rules, corrections, once), rules)


def judge_listed(shortlist: DataFrame, rules: Rules, now: str) -> DataFrame:
    """A written shortlist judged; the texts of bids that the gate rejects by their listing are not read (what they say is null)."""
    df = shortlist.withColumn("_reason", listing_reason(rules))
    gone = df.filter("_reason IS NOT NULL").withColumns({"verdict": F.lit("rejected"), "rejected_reason": F.col("_reason")})
    read = judge(analyse(df.filter("_reason IS NULL").drop("_reason"), rules, now, once=True), rules)
    return read.unionByName(deadline(gone.drop("_reason"), rules, now), allowMissingColumns=True)


def read_texts(shortlist: DataFrame, rules: Rules, corrections: DataFrame | None = None, once: bool = False) -> DataFrame:
    """Adds the columns of ``FOUND``. ``once`` is for a written table: see ``clauses_once``."""
    text = F.col("doc_text")
    if once:
        df = assess(classify(clauses_once(shortlist, rules), rules, text), rules, text)
        df = df.select(*dict.fromkeys([*shortlist.columns, "classification", "geo", *CLAUSES]))
    else:
        df = clauses(assess(classify(shortlist, rules, text), rules, text), rules)
    df = apply_corrections(df, corrections, rules)
    return assess_eligibility(fallback_summary(df), rules)


def clauses(df: DataFrame, rules: Rules) -> DataFrame:
    return extract_requirements(analyze_security(analyze_emd(cleaned_document(df))), rules).drop("_doc")


def clauses_once(written: DataFrame, rules: Rules) -> DataFrame:
    """``clauses`` of a written table: texts that recur, as boilerplate does, are read once and joined to their bids.

    Whether they do is counted first; a table of different texts is read bid by bid. Only the
    address in the evidence is each bid's own.
    """
    different, rows = written.select(F.approx_count_distinct(F.xxhash64(*CLAUSE_INPUT)), F.count("*")).first()
    if different * RECURS > rows:
        return clauses(written, rules)
    df = written.withColumn("_print", F.sha2(F.to_json(F.struct(*CLAUSE_INPUT)), 256))
    asked = df.select("_print", *CLAUSE_INPUT).dropDuplicates(["_print"]).withColumn("source_url", F.lit(""))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-different // NEWS_PER_TASK))
    read = stable(clauses(asked.repartition(tasks), rules).select("_print", "flags", *CLAUSES))
    url = F.coalesce("source_url", F.lit(""))

    def here(evidence: Column) -> Column:
        return F.transform(evidence, lambda e: e.withField("source_url", url))

    df = df.drop("flags", *CLAUSES).join(read, "_print")
    for name, lists in (("emd", ("amount_evidence", "evidence")), ("security", ("percentage_evidence", "amount_evidence", "evidence"))):
        told = F.col(name)
        for part in lists:
            told = told.withField(part, here(F.col(name)[part]))
        df = df.withColumn(name, told)
    df = df.withColumn("required_documents", F.transform("required_documents", lambda d: d.withField("evidence", here(d["evidence"]))))
    return df.select(*written.columns, *[c for c in CLAUSES if c not in written.columns])


def text_print() -> Column:
    """Digest of all that the text rules read of a conformed bid with its deadline."""
    read = [c for c in (*TEXT, *OTHER, *FLAGS) if c not in DATED]
    return F.sha2(F.to_json(F.struct(*read)), 256)


def run_again(bids: DataFrame, known: DataFrame, rules: Rules, now: str, out: DataFrame | None = None) -> DataFrame:
    """The judged shortlist of a later day; texts that an earlier day has read are not read again.

    ``known`` is that day's judged shortlist with ``text_print``, by the same rules and without corrections.
    A bid of the same print passed the screen then and has the same ``FOUND`` columns now; its dates,
    value, score and verdict are today's. ``out`` holds the ``text_print`` of open bids that the screen
    ruled out by their texts then, as it would now. All other bids are screened and analysed whole.
    """
    today = _open(bids, rules, now).withColumn("text_print", text_print())
    if out is not None:
        today = today.join(out.select("text_print").filter("text_print IS NOT NULL").distinct(), "text_print", "left_anti")
    seen = known.select("text_print", F.struct(*FOUND).alias("_found")).dropDuplicates(["text_print"])
    both = stable(today.join(seen, "text_print", "left"))
    old = both.filter("_found IS NOT NULL").drop("doc_text", *FOUND).select("*", "_found.*").drop("_found")
    fresh = both.filter("_found IS NULL").drop("_found")
    fresh = read_texts(_fitting(spread(fresh, fresh.count(), NEWS_PER_TASK), rules), rules).drop("doc_text")
    return judge(score(fresh.unionByName(old).drop("text_print"), rules), rules)


def judge(analysed: DataFrame, rules: Rules) -> DataFrame:
    return verdict(analysed, rules)


def run(
    bids: DataFrame, rules: Rules, now: str, corrections: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(judged shortlist, bids screened out on the listing)."""
    analysed = analyse(shortlist(bids, rules, now), rules, now, corrections)
    return judge(analysed, rules), screened_out(screen(bids, rules, now))


def shortlisted(screened: DataFrame) -> DataFrame:
    return keep(screened, F.col("screen_reason").isNull()).drop("screen_reason")


def screened_out(screened: DataFrame) -> DataFrame:
    return keep(screened, F.col("screen_reason").isNotNull())


def with_verdict(judged: DataFrame, *verdicts: str) -> DataFrame:
    return keep(judged, F.col("verdict").isin(*verdicts))


#: Profiles up to this number are sent to every executor; more are met without a broadcast.
FEW_PROFILES = 10_000


def judge_for(analysed: DataFrame, profiles: DataFrame, rules: Rules) -> DataFrame:
    """Every analysed bid judged for every supplier of a parameter table ``profile, settings`` (a PROFILE struct each).

    Profiles are data: the plan does not change with them, and what does not depend on
    a profile (texts, clauses, region) is analysed once. Columns that start with the
    name of the profile, ``eligibility``, ``score`` and the verdict are each profile's own.
    """
    few = profiles.limit(FEW_PROFILES + 1).count() <= FEW_PROFILES
    asked = profiles.select("profile", F.col("settings").alias("_settings"))
    each = analysed.drop("eligibility", "score", "verdict", "rejected_reason").crossJoin(F.broadcast(asked) if few else asked)
    own = F.col("_settings")
    return judge(score(assess_eligibility(each, rules, own), rules, own).drop("_settings"), rules)
