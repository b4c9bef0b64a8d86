"""Report tables. Each section is a DataFrame ``section, seq, kind, text``.

``seq`` orders the lines of a section; it is an array so that lines of one bid
stay together under the bid's rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import literal
from bidlens.functions.lists import present
from bidlens.functions.text import blank_to
from bidlens.functions.values import rupees, short_number
from bidlens.operators import emd, ranking, security
from bidlens.operators.scoring import component_lines
from bidlens.operators.snapshot import change_sentence
from bidlens.rules import Rules
from bidlens.schema import CONFIRMED, NOT_REQUIRED, NOT_STATED, REQUIRED, UNCLEAR
from bidlens.session import keep

# Symbols, labels and line wording of the report.
URGENCY_SIGN = {"URGENT": "🔴", "HIGH PRIORITY": "🟠", "ACTION REQUIRED": "🟡", "WATCHLIST": "🔭", "EXPIRED": "⛔", "UNKNOWN": "⚪"}
MATCH_SIGN = {"HIGH": "🟢", "MEDIUM": "🟡", "LOW": "🔴", "UNKNOWN": "⚪"}
BAND_SIGN = {"STRONG OPPORTUNITY": "🟢", "GOOD OPPORTUNITY": "🟡", "REVIEW REQUIRED": "🟠", "LOW PRIORITY": "🔴"}
KIND_LABEL = {"product_supply": "Product supply", "service": "Service contract", "supply_and_service": "Supply + service", "unknown": "Type not clear"}
BUCKETS = ("🥇 TOP PRIORITY", "🥈 GOOD OPPORTUNITY", "🥉 REVIEW REQUIRED", "❌ LOW PRIORITY")
UNKNOWN = "⚠ Verification Required"
NO_DOCUMENTS = "⚠ Not stated in the source we could read — check the bid on GeM"


def _c(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _look_up(table: dict[str, str], key: Column) -> Column:
    return F.coalesce(F.element_at(literal(table, "map<string,string>"), key), F.lit(""))


def _points() -> Column:
    return F.format_number("score.total", 0)


def _days(unknown: str = "?") -> Column:
    return F.coalesce(F.col("days_remaining").cast("string"), F.lit(unknown))


def bucket() -> Column:
    s = F.col("score.total")
    return F.when(s >= 80, BUCKETS[0]).when(s >= 60, BUCKETS[1]).when(s >= 40, BUCKETS[2]).otherwise(BUCKETS[3])


# -- one-line renderings ---------------------------------------------------
def default_action() -> Column:
    s = F.col("score.total")
    return (
        F.when(s >= 80, "Open the bid on GeM today, confirm the technical specification and start assembling documents.")
        .when(s >= 60, "Review the bid document on GeM and decide whether to bid.")
        .when(F.size("eligibility.gaps") > 0, "Check the eligibility gaps listed above before spending any time on this bid.")
        .otherwise("Skim the bid on GeM; low priority unless the buyer relationship matters.")
    )


def next_action() -> Column:
    return F.when(F.col("next_action") != "", F.col("next_action")).otherwise(default_action())


def one_liner() -> Column:
    return _c(
        _points(), "/100 · ", _look_up(URGENCY_SIGN, F.col("urgency")), " ", _days(), " days · ", F.col("bid_number"),
        " · ", F.col("title"), " · ", F.regexp_extract(emd.headline(), "^[^ ]+ (.*)$", 1),
    )


def deadline_line() -> Column:
    return _c(
        F.col("bid_number"), " — closes ", F.coalesce(F.date_format("bid_end_at", "dd MMM yyyy HH:mm"), F.lit("?")),
        " (", _days("None"), " days) — ", F.col("title"), " — score ", _points(), "/100",
    )


def buyer_line() -> Column:
    parts = F.array(F.trim("buyer_organization"), F.trim("department"), F.trim("ministry"))
    return blank_to(F.array_join(F.array_distinct(F.filter(parts, lambda p: p != "")), " · "), F.lit("⚠ Not available"))


def location_line() -> Column:
    place = blank_to("delivery_location", "service_location", "buyer_address")
    districts = F.array_join("geo.districts", ", ")
    missing = (districts != "") & ~F.contains(F.lower(place), F.lower(districts))
    shown = F.when(missing & (place != ""), _c(place, " (", districts, ")")).when(missing, districts).otherwise(place)
    doubt = F.when(F.col("geo.confidence") != CONFIRMED, _c("  ⚠ ", F.col("geo.reason"))).otherwise("")
    return _c(blank_to(shown, F.lit("⚠ Not stated")), doubt)


def quantity_line() -> Column:
    return (
        F.when(F.col("quantity") != 0, _c(short_number("quantity"), " ", blank_to("quantity_unit", F.lit("units"))))
        .when(F.col("classification.kind") == "service", "Service contract — see scope of work")
        .otherwise("⚠ Not stated")
    )


def closing_line() -> Column:
    return F.coalesce(F.date_format("bid_end_at", "dd MMMM yyyy 'at' HH:mm '(IST)'"), F.lit(UNKNOWN))


def issue_line() -> Column:
    return _c(
        "⚠ GeM ACCESS ISSUE — ", F.date_format("occurred_at", "dd MMM yyyy HH:mm"), " IST — ", F.col("error_type"), " at ",
        F.col("stage"), " (", F.col("target"), ")",
    )


def value_line() -> Column:
    return F.coalesce(rupees("estimated_value"), F.lit("Not published on GeM"))


# -- counters --------------------------------------------------------------
def counters(accepted: DataFrame) -> DataFrame:
    s = F.col("score.total")
    return accepted.agg(
        F.count("*").alias("total"),
        F.count_if(s >= 80).alias("strong"),
        F.count_if((s >= 60) & (s < 80)).alias("good"),
        F.count_if(F.col("urgency") == "URGENT").alias("urgent"),
        F.count_if(F.col("emd.status") == REQUIRED).alias("with_emd"),
        F.count_if(F.col("emd.status") == NOT_REQUIRED).alias("without_emd"),
        F.count_if(F.col("emd.status") == NOT_STATED).alias("emd_unclear"),
    )


def rejections(judged: DataFrame, screened_out: DataFrame) -> DataFrame:
    """Both passes together, counted by reason."""
    gated = judged.groupBy(F.col("rejected_reason").alias("reason")).agg(F.count("*").alias("n"))
    both = gated.filter("reason IS NOT NULL").unionByName(
        screened_out.groupBy(F.col("screen_reason").alias("reason")).agg(F.count("*").alias("n"))
    )
    return both.groupBy("reason").agg(F.sum("n").alias("n"))


def label_reasons(counts: DataFrame, rules: Rules) -> DataFrame:
    labels = literal(rules.decision["rejection_labels"], "map<string,string>")
    return counts.withColumn(
        "label", F.coalesce(F.element_at(labels, F.col("reason")), F.replace("reason", F.lit("_"), F.lit(" ")))
    )


def document_demand(accepted: DataFrame) -> DataFrame:
    """``name, n, total``: bids that ask for each document, out of how many."""
    asked = accepted.select(F.explode("required_documents").alias("d")).groupBy(F.col("d.name").alias("name")).agg(
        F.count("*").alias("n")
    )
    return asked.crossJoin(F.broadcast(accepted.agg(F.count("*").alias("total"))))


def emd_totals(accepted: DataFrame) -> DataFrame:
    known = F.when(F.col("emd.status") == REQUIRED, F.col("emd.amount"))
    return accepted.groupBy(F.col("emd.status").alias("emd_status")).agg(
        F.count("*").alias("n"), F.sum(known).alias("known_amount")
    )


def manifest(
    judged: DataFrame, screened_out: DataFrame, merged: DataFrame, issues: DataFrame, degraded: DataFrame,
    queries: DataFrame, details: DataFrame, documents: DataFrame, run_id: str, started: str, finished: str | None,
) -> DataFrame:
    """One row about the run: ``queries`` asked, ``details`` pages and ``documents`` read are counted.

    Issues are counted by stage and error type; their lines are rows of ``access_issues``.
    """
    rejected = rejections(judged, screened_out).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("rejected")
    )
    verdicts = judged.agg(
        F.count("*").alias("_judged"),
        F.count_if(F.col("verdict") == "accepted").alias("accepted"),
        F.count_if(F.col("verdict") == "watchlist").alias("watchlist"),
    )
    out = screened_out.agg(F.count("*").alias("_out"))
    stored = merged.agg(
        F.count_if(F.col("action") == "new").alias("new_tenders"),
        F.count_if(F.col("action") == "updated").alias("updated_tenders"),
    )
    kinds = issues.groupBy("stage", "error_type").agg(F.count("*").alias("n"))
    trouble = kinds.agg(F.array_sort(F.collect_list(F.struct("stage", "error_type", "n"))).alias("issues"))
    modes = degraded.agg(F.array_sort(F.collect_set("mode")).alias("degraded_modes"))
    row = verdicts.crossJoin(out).crossJoin(rejected).crossJoin(stored).crossJoin(trouble).crossJoin(modes)
    for name, df in (("queries", queries), ("details_fetched", details), ("documents_downloaded", documents)):
        row = row.crossJoin(df.agg(F.count("*").alias(name)))
    return row.select(
        F.lit(run_id).alias("run_id"), F.lit(started).alias("started_at"), F.lit(finished).cast("string").alias("finished_at"),
        "queries", (F.col("_judged") + F.col("_out")).alias("listings_seen"), (F.col("_judged") + F.col("_out")).alias("candidates"),
        "details_fetched", "documents_downloaded", "accepted", "watchlist", "rejected", "new_tenders",
        "updated_tenders", "issues", "degraded_modes",
    )


def access_issues(issues: DataFrame, run_id: str) -> DataFrame:
    """``run_id, line``: one row per access issue of the run, in the order of the lines."""
    return issues.select(F.lit(run_id).alias("run_id"), issue_line().alias("line")).orderBy("line")


def reachable(issues: DataFrame) -> DataFrame:
    """False if any issue arose while listing."""
    return issues.agg((F.count_if(F.col("stage") == "listing") == 0).alias("source_reachable"))


# -- sections --------------------------------------------------------------
def _section(df: DataFrame, name: str, seq: Column, kind: Column | str, text: Column) -> DataFrame:
    k = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(F.lit(name).alias("section"), seq.cast("array<bigint>").alias("seq"), k.alias("kind"), text.alias("text"))


def executive_summary(accepted: DataFrame, watchlist: DataFrame, changes: DataFrame, issues: DataFrame) -> DataFrame:
    row = (
        counters(accepted).crossJoin(watchlist.agg(F.count("*").alias("watch")))
        .crossJoin(changes.agg(F.count("*").alias("amended"))).crossJoin(reachable(issues))
    )
    n = {c: F.col(c).cast("string") for c in ("total", "strong", "good", "urgent", "with_emd", "without_emd", "emd_unclear", "watch", "amended")}
    lines = F.array_compact(F.array(
        _c("Tenders in today's report: ", n["total"]),
        _c("Strong opportunities (80–100): ", n["strong"]),
        _c("Good opportunities (60–79): ", n["good"]),
        _c("Urgent deadlines (closing in 0–2 days): ", n["urgent"]),
        _c("Tenders requiring EMD: ", n["with_emd"]),
        _c("Tenders with no EMD: ", n["without_emd"]),
        F.when(F.col("emd_unclear") > 0, _c("Tenders where EMD is unclear: ", n["emd_unclear"], " ⚠")),
        F.when(F.col("watch") > 0, _c("On the future watchlist: ", n["watch"])),
        F.when(F.col("amended") > 0, _c("Amendments detected since the last run: ", n["amended"])),
        F.when((F.col("total") == 0) & F.col("source_reachable"), "No tender met all checks today; see Run & Data Quality for what was filtered out."),
        F.when((F.col("total") == 0) & ~F.col("source_reachable"), "⚠ The portal could not be searched; an empty report does NOT mean there were no tenders."),
    ))
    return _section(row.select(F.posexplode(lines).alias("i", "line")), "executive_summary", F.array("i"), "keyvalue", F.col("line"))


def run_line() -> Column:
    n = {c: F.col(c).cast("string") for c in ("queries", "listings_seen", "details_fetched", "documents_downloaded")}
    return _c(
        "Run ", F.col("run_id"), " · ", n["queries"], " search terms · ", n["listings_seen"], " bids seen · ", n["details_fetched"],
        " detail pages read · ", n["documents_downloaded"], " documents analysed.",
    )


def data_quality(counts: DataFrame, issues: DataFrame, degraded: DataFrame, rules: Rules, manifest: DataFrame) -> DataFrame:
    """The run's line (from its ``manifest`` row), what was filtered out, access issues and degraded modes."""
    head = _section(manifest, "data_quality", F.array(F.lit(-1), F.lit(0)), "paragraph", run_line())
    filtered = label_reasons(counts, rules)
    a = _section(filtered, "data_quality", F.array(F.lit(0), -F.col("n")), "bullet", _c(F.col("n").cast("string"), " — ", F.col("label")))
    b = _section(issues, "data_quality", F.array(F.lit(1), F.lit(0)), "bullet", issue_line())
    c = _section(degraded.distinct(), "data_quality", F.array(F.lit(2), F.lit(0)), "bullet", F.col("mode"))
    return head.unionByName(a).unionByName(b).unionByName(c)


def priority(ranked: DataFrame) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(b) for b in BUCKETS]), bucket())
    heads = ranked.groupBy(bucket().alias("b"), place.alias("p")).agg(F.count("*").alias("n"))
    a = _section(heads, "priority", F.array(F.col("p"), F.lit(0)), "heading", _c(F.col("b"), " (", F.col("n").cast("string"), ")"))
    return a.unionByName(_section(ranked, "priority", F.array(place, F.col("rank")), "bullet", one_liner()))


def urgent(ranked: DataFrame) -> DataFrame:
    near = keep(ranked, F.col("urgency").isin("URGENT", "HIGH PRIORITY"))
    return _section(near, "urgent", F.array(F.when(F.col("urgency") == "URGENT", 0).otherwise(1), F.col("rank")), "bullet", deadline_line())


def detail_lines() -> Column:
    """ARRAY<STRUCT<kind, text>>: everything the report says about one bid."""

    def kv(key: str, value: Column) -> Column:
        return F.array(F.struct(F.lit("keyvalue").alias("kind"), _c(key + ": ", value).alias("text")))

    def bullets(head: str, items: Column) -> Column:
        block = F.concat(
            F.array(F.struct(F.lit("paragraph").alias("kind"), F.lit(head).alias("text"))),
            F.transform(items, lambda i: F.struct(F.lit("bullet").alias("kind"), i.alias("text"))),
        )
        return F.when(F.size(items) > 0, block)

    def warned(items: Column) -> Column:
        return F.transform(items, lambda i: _c("⚠ ", i))

    r, e = F.col("requirements"), F.col("eligibility")
    deposit = present(
        _c("Amount: ", F.coalesce(rupees("emd.amount"), F.lit(UNKNOWN))),
        _c("Payment: ", F.col("emd.payment_mode")),
        _c("Last date: ", F.col("emd.last_date")),
        F.when(F.col("emd.msme_exemption") == REQUIRED, "MSME exemption appears available"),
        F.when(F.col("emd.startup_exemption") == REQUIRED, "Startup exemption appears available"),
        F.when(F.size("emd.exemption_proof_required") > 0, _c("Exemption proof: ", F.array_join("emd.exemption_proof_required", ", "))),
    )
    documents = F.when(
        F.size("required_documents") > 0,
        F.transform("required_documents", lambda d: F.when(d["confidence"] == UNCLEAR, _c(d["name"], " ", UNKNOWN)).otherwise(d["name"])),
    ).otherwise(F.array(F.lit(NO_DOCUMENTS)))
    blocks = [
        kv("Bid Number", blank_to("bid_number", F.lit("⚠ Not available"))),
        F.when(F.col("gem_tender_id") != "", kv("GeM Tender ID", F.col("gem_tender_id"))),
        kv("Buyer", buyer_line()),
        kv("Location", location_line()),
        kv("Product / Service Required", blank_to("plain_summary", F.lit("⚠ Summary unavailable"))),
        kv("Type", _look_up(KIND_LABEL, F.col("classification.kind"))),
        kv("Quantity / Scope", quantity_line()),
        kv("Closing Date", closing_line()),
        kv("Days Remaining", F.coalesce(_c(F.col("days_remaining").cast("string"), " days"), F.lit(UNKNOWN))),
        kv("Priority", _c(_look_up(URGENCY_SIGN, F.col("urgency")), " ", F.col("urgency"))),
        kv("Estimated Value", value_line()),
        kv("EMD", emd.headline()),
        F.when(F.col("emd.status") == REQUIRED, F.transform(deposit, lambda i: F.struct(F.lit("bullet").alias("kind"), i.alias("text")))),
        kv("Performance Security / ePBG", security.security_line()),
        bullets("Required Documents", documents),
        bullets("Important Eligibility Requirements", r["eligibility"]),
        bullets("Key Technical Requirements", r["technical"]),
        bullets("Delivery / Warranty / AMC Requirements", F.concat(r["delivery"], r["warranty"], r["amc"])),
        F.when(r["payment_terms"].isNotNull(), kv("Payment Terms", r["payment_terms"])),
        bullets("Special Conditions", r["special"]),
        kv("AI Opportunity Score", _c(_points(), " / 100  ", _look_up(BAND_SIGN, F.col("score.band")), " ", F.col("score.band"))),
        F.transform(component_lines(), lambda i: F.struct(F.lit("bullet").alias("kind"), i.alias("text"))),
        kv("Match Assessment", _c(_look_up(MATCH_SIGN, e["match_level"]), " ", e["match_level"], " — ", e["verdict"])),
        bullets("Why this could suit us", e["supporting_points"]),
        bullets("Requirement gaps", e["gaps"]),
        bullets("To verify before bidding", warned(e["verification_points"])),
        F.when(F.col("why_it_matters") != "", kv("Why This Tender Matters", F.col("why_it_matters"))),
        bullets("Important Risks", warned(F.col("risks"))),
        bullets("Verification Points", warned(F.col("flags"))),
        kv("Recommended Next Action", next_action()),
        kv("Official GeM Source", blank_to("source_url", F.lit("⚠ Not available"))),
    ]
    kind = "array<struct<kind:string,text:string>>"
    return F.flatten(F.array_compact(F.array(*[b.cast(kind) for b in blocks])))


def detailed(ranked: DataFrame) -> DataFrame:
    head = _section(ranked, "detailed", F.array(F.col("rank"), F.lit(0)), "heading", _c(
        "TENDER #", F.col("rank").cast("string"), " — ", blank_to("title", "bid_number")
    ))
    lines = ranked.select("rank", F.posexplode(detail_lines()).alias("i", "l"))
    return head.unionByName(_section(lines, "detailed", F.array(F.col("rank"), F.col("i") + 1), F.col("l.kind"), F.col("l.text")))


def emd_summary(ranked: DataFrame) -> DataFrame:
    status = F.col("emd.status")
    place = F.when(status == NOT_REQUIRED, 0).when(status == REQUIRED, 1).otherwise(2)
    line = F.when(status == REQUIRED, _c(
        F.col("bid_number"), " — ", F.coalesce(rupees("emd.amount"), F.lit(UNKNOWN)), " — ", F.col("title")
    )).otherwise(_c(F.col("bid_number"), " — ", F.col("title")))
    totals = emd_totals(ranked).withColumn(
        "p", F.when(F.col("emd_status") == NOT_REQUIRED, 0).when(F.col("emd_status") == REQUIRED, 1).otherwise(2)
    )
    n = F.col("n").cast("string")
    head = F.when(F.col("p") == 0, _c("✅ No EMD required (", n, ")")).when(F.col("p") == 1, _c("💰 EMD required (", n, ")")).otherwise(
        _c("⚠ EMD not clearly stated (", n, ") — verify manually")
    )
    total = totals.filter("p = 1 AND known_amount > 0")
    return (
        _section(totals, "emd_summary", F.array(F.col("p"), F.lit(0)), "paragraph", head)
        .unionByName(_section(ranked, "emd_summary", F.array(place, F.col("rank")), "bullet", line))
        .unionByName(_section(total, "emd_summary", F.array(F.lit(1), F.lit(9223372036854775807)), "paragraph", _c(
            "Total EMD across these tenders: ", rupees("known_amount"), " (before any MSME/Startup exemption)."
        )))
    )


def documents_summary(accepted: DataFrame) -> DataFrame:
    return _section(document_demand(accepted), "documents_summary", F.array(-F.col("n")), "bullet", _c(
        F.col("name"), " — needed by ", F.col("n").cast("string"), " of ", F.col("total").cast("string"), " tenders"
    ))


def risks(ranked: DataFrame) -> DataFrame:
    risky = keep(ranked, F.size("eligibility.gaps") > 0)
    head = _section(risky, "risks", F.array(F.col("rank"), F.lit(0)), "paragraph", _c(F.col("bid_number"), " — ", F.col("title")))
    gaps = risky.select("rank", F.posexplode("eligibility.gaps").alias("i", "gap"))
    return head.unionByName(_section(gaps, "risks", F.array(F.col("rank"), F.col("i") + 1), "bullet", F.col("gap")))


def actions(ranked: DataFrame) -> DataFrame:
    """Soonest first, then best score; the rank settles the rest."""
    return _section(ranked, "actions", F.array(F.coalesce("days_remaining", F.lit(99)), F.col("rank")), "bullet", _c(
        _look_up(URGENCY_SIGN, F.col("urgency")), " ", F.col("bid_number"), " (", _days(), " days) — ", next_action()
    ))


def watchlist(ranked_watchlist: DataFrame) -> DataFrame:
    return _section(ranked_watchlist, "watchlist", F.array("rank"), "bullet", _c(
        _points(), "/100 · ", F.col("bid_number"), " · closes in ", _days("None"), " days · ", F.col("title")
    ))


def change_log(changes: DataFrame, reported: DataFrame) -> DataFrame:
    """``label, lines`` per changed bid; the key stands in for an unreported bid."""
    names = reported.select("identity_key", _c(F.col("bid_number"), " — ", F.col("title")).alias("_label"))
    # At most one line per tracked field and bid.
    grouped = changes.groupBy("identity_key").agg(F.array_sort(F.collect_list(change_sentence())).alias("lines"))
    return grouped.join(names, "identity_key", "left").select(
        "identity_key", F.coalesce("_label", "identity_key").alias("label"), "lines"
    )


def change_section(changes: DataFrame, reported: DataFrame) -> DataFrame:
    """The changed bids in the order of their keys, each with its lines."""
    log = ranking.number_rows(change_log(changes, reported), [F.col("identity_key")], name="n")
    lines = log.select("n", F.posexplode(F.concat(F.array("label"), F.col("lines"))).alias("i", "text"))
    return _section(lines, "change_log", F.array(F.col("n"), F.col("i")), F.when(F.col("i") == 0, "paragraph").otherwise("bullet"), F.col("text"))


def references(ranked: DataFrame, ranked_watchlist: DataFrame) -> DataFrame:
    a = ranked.select(F.lit(0).alias("p"), "rank", "bid_number", "source_url")
    both = a.unionByName(ranked_watchlist.select(F.lit(1).alias("p"), "rank", "bid_number", "source_url")).filter("source_url <> ''")
    return _section(both, "references", F.array("p", "rank"), "bullet", _c(F.col("bid_number"), " — ", F.col("source_url")))


def report_lines(
    ranked: DataFrame, ranked_watchlist: DataFrame, changes: DataFrame, reported: DataFrame, counts: DataFrame,
    issues: DataFrame, degraded: DataFrame, rules: Rules, manifest: DataFrame,
) -> DataFrame:
    """``line, section, kind, text``: the whole report as one table, numbered from 1 in its own order.

    Lines are dealt by ranges of (section, seq, text), so a long section is spread
    over many partitions; the numbers come from the partitions' sizes.
    """
    sections = (
        executive_summary(ranked, ranked_watchlist, changes, issues),
        data_quality(counts, issues, degraded, rules, manifest),
        priority(ranked), urgent(ranked), detailed(ranked), emd_summary(ranked), documents_summary(ranked),
        risks(ranked), actions(ranked), watchlist(ranked_watchlist),
        change_section(changes, reported), references(ranked, ranked_watchlist),
    )
    out = None
    for i, s in enumerate(sections, start=1):
        s = s.withColumn("section_no", F.lit(i))
        out = s if out is None else out.unionByName(s)
    order = [F.col(c) for c in ("section_no", "seq", "text", "kind")]
    return ranking.number_lines(out, order, "line").select("line", "section", "kind", "text")
