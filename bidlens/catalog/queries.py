"""One query per operator of the survey, as (spark, folder) -> DataFrame.

Results are flat so that another engine can be compared with them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.functions import identity, lists, text, values
from bidlens.functions.terms import TermTable
from bidlens.operators import (
    classify, corrections, dims, discovery, eligibility, emd, gate, geo, ranking, requirements, scoring,
    security, snapshot,
)
from bidlens.plans import daily, report, run, views
from bidlens.rules import load_rules
from bidlens.schema import conform
from bidlens.session import new_folder, spread, stable
from bidlens.sources import documents, exports, hits, pages, snapshots
from bidlens.streaming import amendments, listings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RULES = load_rules()
NOW, TODAY = views.NOW, views.TODAY
NOW_2, TODAY_2 = "2026-09-07 08:30:00", "2026-09-07"
#: The budgets of the two queries that show them; the rules themselves set none.
MAX_DETAILS, MAX_DOCUMENTS = 250, 400


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def day(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def joined(col: Column | str, sep: str = "; ") -> Column:
    return F.array_join(col, sep)


# -- shared plans, built once per session and folder -----------------------
@lru_cache(maxsize=8)
def bids(spark: SparkSession, sf: str) -> DataFrame:
    return views.view(spark, sf, "bids")


@lru_cache(maxsize=8)
def screened(spark: SparkSession, sf: str) -> DataFrame:
    return daily.screen_reasons(bids(spark, sf), RULES, NOW)


@lru_cache(maxsize=8)
def listed(spark: SparkSession, sf: str) -> DataFrame:
    return daily.looked_at(bids(spark, sf), RULES, NOW)


@lru_cache(maxsize=8)
def analysed(spark: SparkSession, sf: str) -> DataFrame:
    return daily.analyse(daily.shortlist(bids(spark, sf), RULES, NOW), RULES, NOW)


@lru_cache(maxsize=8)
def judged(spark: SparkSession, sf: str) -> DataFrame:
    return daily.judge(analysed(spark, sf), RULES)


@lru_cache(maxsize=8)
def clauses_only(spark: SparkSession, sf: str) -> DataFrame:
    """Clause rules on every bid, screened or not."""
    df = emd.cleaned_document(conform(bids(spark, sf)))
    df = security.analyze_security(emd.analyze_emd(df))
    return requirements.extract_requirements(df, RULES)


@lru_cache(maxsize=8)
def listing(spark: SparkSession, sf: str) -> DataFrame:
    return daily.screen_once(bids(spark, sf), RULES, NOW)


def screened_out(spark: SparkSession, sf: str) -> DataFrame:
    return listing(spark, sf).filter("screen_reason IS NOT NULL")


# The analysed bids feed the gate, the snapshot and every report section, so
# they are stored once (shared checkpoint folder) and read from there. No one
# asks what the texts of a bid say that its listing rejects: they are not read.
@lru_cache(maxsize=8)
def stored_with_print(spark: SparkSession, sf: str) -> DataFrame:
    open_ = listing(spark, sf).filter("screen_reason IS NULL").drop("screen_reason")
    return stable(daily.judge_listed(open_, RULES, NOW).drop("doc_text"))


def stored(spark: SparkSession, sf: str) -> DataFrame:
    return stored_with_print(spark, sf).drop("text_print")


@lru_cache(maxsize=8)
def stored_next(spark: SparkSession, sf: str) -> DataFrame:
    """The second day; what the first day has read of a bid stays as long as its texts do."""
    known, out = stored_with_print(spark, sf), screened_out(spark, sf)
    return stable(daily.run_again(views.view(spark, sf, "next_day"), known, RULES, NOW_2, out))


def reported(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf).filter("verdict <> 'rejected'")


def second_day(spark: SparkSession, sf: str) -> DataFrame:
    return stored_next(spark, sf).filter("verdict <> 'rejected'")


def accepted(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf).filter("verdict = 'accepted'")


def watch(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf).filter("verdict = 'watchlist'")


# The rank tables (key, rank) are made once; every section joins its bids to them.
@lru_cache(maxsize=8)
def ranks(spark: SparkSession, sf: str, verdict: str) -> DataFrame:
    return ranking.ranks(stored(spark, sf).filter(F.col("verdict") == verdict), ranking.report_order())


def ranked(spark: SparkSession, sf: str, verdict: str = "accepted") -> DataFrame:
    return stored(spark, sf).filter(F.col("verdict") == verdict).join(ranks(spark, sf, verdict), "identity_key")


@lru_cache(maxsize=8)
def two_days(spark: SparkSession, sf: str) -> DataFrame:
    """Both days' stored rows side by side; the payload stays out of the join.

    The first day is stored in buckets of the key, so only the second day's rows move.
    """
    first = snapshots.write_bucketed(snapshot.flat_rows(reported(spark, sf), TODAY).drop("payload"))
    return snapshot.joined(first, snapshot.flat_rows(second_day(spark, sf), TODAY_2).drop("payload"))


FLAT = [c for c in snapshot.ROW if c != "payload"]


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.merge(two_days(spark, sf), FLAT)


def changed(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.changes(two_days(spark, sf), TODAY_2)


def issues(spark: SparkSession, sf: str) -> DataFrame:
    """Access issues derived from the events table."""
    e = views.table(spark, sf, "events").filter("event_type = 'error'")
    return e.select(
        F.col("ts").alias("occurred_at"),
        F.when(F.col("event_id") % 100 == 0, "listing").otherwise("detail").alias("stage"),
        F.concat(F.lit("https://bidplus.gem.gov.in/"), F.col("user_id")).alias("target"),
        F.concat(F.lit("HTTP_"), F.col("event_id") % 7 + 500).alias("error_type"),
    )


def degraded(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "events").filter("event_type = 'error'").select(
        F.concat(F.lit("mode "), F.col("event_id") % 3).alias("mode")
    )


def doc_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as attachments, three to a bid."""
    d = spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    name = F.concat(F.lit("File "), F.col("doc_id") % 3)
    return d.select(
        F.concat(F.lit("doc:"), F.floor(F.col("doc_id") / 3)).alias("identity_key"),
        F.col("doc_id").alias("pos"), name.alias("name"), pages.document_kind(name).alias("kind"), "text",
        F.length("text").alias("text_chars"),
    )


# -- A: sources and sinks --------------------------------------------------
@query
def A1_listing_cards(spark, sf):
    out = pages.listing_cards(views.listing_pages(spark, sf), RULES)
    return out.select(
        "page_url", "pos", "bid_number", "source_url", "title", "item_description", "category", "buyer_address",
        "quantity", "quantity_unit", day("bid_start_at").alias("bid_start_at"), day("bid_end_at").alias("bid_end_at"),
        F.length("listing_text").alias("listing_chars"),
    )


def detail_pages(spark, sf):
    return views.view(spark, sf, "details").withColumnRenamed("source_url", "url")


@query
def A2_detail_fields(spark, sf):
    return pages.detail_rows(detail_pages(spark, sf), RULES)


@query
def A3_detail_merge(spark, sf):
    listing = bids(spark, sf).drop("portal_emd_amount", "portal_epbg_pct", "ra_enabled")
    out = pages.merge_details(listing, detail_pages(spark, sf), RULES)
    return out.select(
        "bid_number", "ministry", "buyer_organization", "buyer_address", "quantity", "quantity_unit", "estimated_value",
        "portal_emd_amount", "portal_emd_text", "portal_epbg_pct", "msme_portal_flag", "ra_enabled",
        day("bid_end_at").alias("bid_end_at"),
    )


@query
def A4_attachments(spark, sf):
    web = views.table(spark, sf, "pages").select("url", "html")
    return pages.attachments(detail_pages(spark, sf).select("url", "html").unionByName(web), RULES).drop("pos")


@query
def A5_document_kinds(spark, sf):
    named = views.view(spark, sf, "names")
    return named.groupBy("name", pages.document_kind("name").alias("kind")).agg(F.count("*").alias("n"))


def watched_pages(spark, sf):
    """Listing pages, every fifth with changed markup, and ordinary web pages."""
    listing = views.listing_pages(spark, sf)
    broken = F.replace("html", F.lit('class="card"'), F.lit('class="newcard"'))
    listing = listing.select("url", F.when(F.col("page_no") % 5 == 0, broken).otherwise(F.col("html")).alias("html"))
    return listing.unionByName(spread(views.table(spark, sf, "pages").select("url", "html")))


@query
def A6_drift(spark, sf):
    return pages.drift(watched_pages(spark, sf), RULES)


@query
def A6_drift_issues(spark, sf):
    out = pages.drift_issues(watched_pages(spark, sf), RULES, NOW)
    return out.select("stage", "target", "error_type", "detail")


@query
def A7_challenge_pages(spark, sf):
    p = spread(views.table(spark, sf, "pages").select("page_id", "html"))
    html = F.when(F.col("page_id") % 10 == 0, F.concat(F.lit('<div class="G-reCaptcha">'), F.col("html"))).when(
        F.col("page_id") % 10 == 1, F.concat("html", F.repeat(F.lit("x"), 20000), F.lit("hcaptcha"))
    ).otherwise(F.col("html"))
    return p.select("page_id", pages.is_challenge(html, RULES).alias("challenge"))


@query
def A8_search_hits(spark, sf):
    out = hits.candidates(views.view(spark, sf, "hits"), RULES)
    return out.select("k", "query", "bid_number", "source_url", "title", "item_description", "listing_text")


@query
def A9_zero_results(spark, sf):
    found = hits.candidates(views.view(spark, sf, "hits"), RULES)
    asked = views.view(spark, sf, "hits").select("query").distinct()
    cases = {"all": found, "none": found.filter("source_url LIKE '%/nowhere/%'")}
    out = None
    for name, df in cases.items():
        issue = discovery.zero_results(df, asked, NOW, "https://bidplus.gem.gov.in/all-bids")
        issue = issue.select(F.lit(name).alias("case"), "stage", "target", "error_type", "detail")
        out = issue if out is None else out.unionByName(issue)
    return out


@query
def A10_document_text(spark, sf):
    out = documents.assemble(doc_files(spark, sf))
    return out.select("identity_key", F.length("doc_text").alias("chars"), F.md5("doc_text").alias("digest"))


@query
def A11_document_admission(spark, sf):
    d = spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    types = ("application/pdf", "text/plain", "image/png")
    kind = F.element_at(F.array(*[F.lit(t) for t in types]), (F.col("doc_id") % 3 + 1).cast("int"))
    size = F.when(F.col("doc_id") % 20 == 0, 26214401).otherwise(F.octet_length("text"))
    out = documents.admit(d.select("doc_id", F.col("text").alias("content"), size.alias("bytes"), kind.alias("content_type")), RULES)
    return out.select("doc_id", "sha256", "extraction_method", "error")


@query
def A12_detail_budget(spark, sf):
    out = documents.within_budget(conform(bids(spark, sf)), [F.col("k")], MAX_DETAILS)
    return out.select("k", "in_budget", F.when(~F.col("in_budget"), documents.FLAG_NO_DETAIL).alias("flag"))


@query
def A12_document_budget(spark, sf):
    order = [F.col("pos")]
    out = documents.document_budget(doc_files(spark, sf), order, MAX_DOCUMENTS)
    return out.select("identity_key", "documents", "documents_read", "budget_flag", "no_text_flag")


@query
def A13_rule_tables(spark, sf):
    asked = dims.search_queries(spark, RULES)
    book = TermTable(tuple(dict.fromkeys(q.lower() for g in RULES.groups for q in g["queries"])))
    found = bids(spark, sf).select(F.explode(book.names(book.numbers(F.lower(text.clean("title"))))).alias("q"))
    n = found.groupBy("q").agg(F.count("*").alias("bids"))
    return asked.join(n, F.lower(asked.query) == n.q, "left").select("query", F.coalesce("bids", F.lit(0)).alias("bids"))


@query
def A13_signal_table(spark, sf):
    book = classify.table(list(dict.fromkeys(t for g in RULES.groups for t in g["signals"] + g["negatives"])))
    found = bids(spark, sf).select(F.explode(book.names(book.numbers(F.lower(text.clean("title"))))).alias("t"))
    n = found.groupBy("t").agg(F.count("*").alias("bids"))
    table = dims.signals(spark, RULES)
    return table.join(n, table.term == n.t, "left").select(
        "group_key", "polarity", "term", F.coalesce("bids", F.lit(0)).alias("bids")
    )


@query
def A14_snapshot_sink(spark, sf):
    root = new_folder(spark, "snapshots")
    rows = snapshot.flat_rows(reported(spark, sf), TODAY).drop("payload")
    snapshots.write_partition(rows, root, "snapshot_date", TODAY)
    snapshots.write_partition(rows.filter("days_remaining > 3"), root, "snapshot_date", TODAY_2)
    snapshots.write_partition(rows.filter("days_remaining > 5"), root, "snapshot_date", TODAY_2)
    stored = spark.read.parquet(root)
    return stored.groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date"), "status").agg(
        F.count("*").alias("bids"), F.max("days_remaining").alias("max_days")
    )


@query
def A14_all_sinks(spark, sf):
    """Bids, changes and run figures of two committed days; a third day that broke off before its commit is not seen."""
    root = new_folder(spark, "sinks")
    days = ((reported(spark, sf), TODAY), (second_day(spark, sf), TODAY_2))
    for i, (df, today) in enumerate(days):
        rows = snapshot.flat_rows(df, today).withColumn("as_of", F.lit(today))
        amendments.merge_batch(rows, i, root)
    kept = amendments.store(spark, root, rows.schema)
    for name in ("changes", "actions", "runs", "state"):  # what a broken third day leaves
        kept.log(name, amendments.CHANGES).limit(0).write.parquet(f"{root}/store/{name}/batch=2")
    rows.select(*kept.schema.names).write.mode("overwrite").parquet(f"{root}/store/state/batch=2")
    state = kept.state()
    bids = state.groupBy(F.lit("bids").alias("sink"), F.col("last_seen_on").alias("day"), F.get_json_object("payload", "$.urgency").alias("what")).agg(F.count("*").alias("n"))
    changes = kept.log("changes", amendments.CHANGES).groupBy(F.lit("changes"), "detected_on", "field_name").agg(F.count("*"))
    runs = kept.log("runs", amendments.RUNS).select(F.lit("runs"), F.col("days")[0], F.explode(F.create_map(*[x for c in ("bids", "new", "updated", "changes") for x in (F.lit(c), F.col(c))])))
    first = kept.state(version=0).groupBy(F.lit("bids of the first version"), F.col("last_seen_on"), F.lit("all")).agg(F.count("*"))
    return bids.union(changes).union(runs).union(first)


@query
def A15_flat_rows(spark, sf):
    """All 28 columns; of the payload, which is JSON of the whole bid, what reads the same in any engine."""
    read = F.from_json("payload", "identity_key string, bid_number string, verdict string, score struct<total double>, required_documents array<struct<canonical string>>")
    told = F.concat_ws("|", "p.identity_key", "p.bid_number", "p.verdict", F.col("p.score.total").cast("string"), F.array_join("p.required_documents.canonical", ","))
    return snapshot.flat_rows(reported(spark, sf), TODAY).withColumn("p", read).withColumn("payload", told).drop("p")


@query
def A16_bid_tab(spark, sf):
    old = exports.bid_rows(reported(spark, sf).withColumn("first_seen_on", F.lit("2026-09-01")), TODAY, "https://docs/1")
    new = exports.bid_rows(second_day(spark, sf).withColumn("first_seen_on", F.lit(None).cast("string")), TODAY_2, "https://docs/2")
    return exports.upsert(old, new)


@query
def A16_change_tab(spark, sf):
    return exports.change_rows(changed(spark, sf), second_day(spark, sf))


@query
def A16_run_tab(spark, sf):
    return exports.run_rows(run_manifest(spark, sf), "https://docs/1")


# -- B: predicates ---------------------------------------------------------
@query
def B1_host_filter(spark, sf):
    links = views.view(spark, sf, "links")
    return links.select("k", "link", identity.is_allowed_host("link", RULES.portal["allowed_hosts"]).alias("official"))


@query
def B2_active(spark, sf):
    df = conform(bids(spark, sf).withColumn(
        "listing_text", F.when(F.col("k") % 6 == 0, F.concat(F.repeat(F.lit("x "), 150), F.lit("Closed circuit TV ")))
        .when(F.col("k") % 6 == 1, F.concat(F.repeat(F.lit("x "), 250), F.lit("withdrawn"))).otherwise(F.col("title"))
    ))
    return df.groupBy("portal_status", (F.col("k") % 6).alias("slot")).agg(F.count_if(gate.is_active(RULES)).alias("active"))


@query
def B3_screen(spark, sf):
    return screened(spark, sf).select("k", "screen_reason")


@query
def B4_gate(spark, sf):
    return listed(spark, sf).select("k", gate.gate_reason(RULES).alias("reason"))


@query
def B5_watchlist(spark, sf):
    return judged(spark, sf).select("k", "verdict", "rejected_reason", "urgency", F.col("score.total").alias("score"))


@query
def B6_windows(spark, sf):
    df = gate.deadline(conform(bids(spark, sf)), RULES, NOW)
    return df.select("k", gate.in_main_window(RULES).alias("main"), gate.in_watch_window(RULES).alias("watch"))


@query
def B7_haystack(spark, sf):
    return conform(bids(spark, sf)).select("k", classify.haystack(F.col("doc_text")).alias("haystack"))


@query
def B8_geo_fields(spark, sf):
    df = conform(bids(spark, sf)).select("k", F.explode(geo.fields(F.col("doc_text"))).alias("f"))
    return df.select("k", F.col("f.name").alias("name"), F.col("f.text").alias("text")).filter("text <> ''")


@query
def B9_open_bids(spark, sf):
    stored = snapshot.expire(merged(spark, sf), TODAY_2)
    return snapshot.open_bids(stored).select("identity_key", "bid_end_at", "score", "title")


@query
def B10_buckets(spark, sf):
    return accepted(spark, sf).groupBy(
        report.bucket().alias("bucket"), "urgency", F.col("emd.status").alias("emd_status"),
        (F.size("eligibility.gaps") > 0).alias("risky"),
    ).agg(F.count("*").alias("n"))


@query
def B11_source_reachable(spark, sf):
    e = issues(spark, sf)
    return report.reachable(e).withColumn("case", F.lit("all")).unionByName(
        report.reachable(e.filter("stage <> 'listing'")).withColumn("case", F.lit("detail only"))
    )


# -- C: joins and merges ---------------------------------------------------
@lru_cache(maxsize=8)
def doc_groups(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", classify.match_groups(F.lower(text.clean("text")), RULES).alias("groups"))


@query
def C1_signal_match(spark, sf):
    hit = doc_groups(spark, sf).select("doc_id", F.explode("groups").alias("g")).filter("g.kind <> 'veto'")
    return hit.select("doc_id", F.col("g.label").alias("label"), joined("g.hits").alias("hits"))


@lru_cache(maxsize=8)
def bid_groups(spark: SparkSession, sf: str) -> DataFrame:
    df = conform(bids(spark, sf))
    return df.select("k", F.explode(classify.match_groups(classify.haystack(F.col("doc_text")), RULES)).alias("g"))


@query
def C2_negative_veto(spark, sf):
    return bid_groups(spark, sf).filter("g.kind <> 'veto'").select(
        "k", F.col("g.label").alias("label"), joined("g.hits").alias("hits"), joined("g.negatives").alias("negatives"),
        classify.outweighed(F.col("g")).alias("vetoed"),
    )


@query
def C3_hard_vetoes(spark, sf):
    return bid_groups(spark, sf).filter("g.kind = 'veto'").select("k", joined("g.hits").alias("vetoes"))


@query
def C4_capability(spark, sf):
    cap = eligibility.capability(F.col("classification.categories"), eligibility.profile_of(RULES))
    return listed(spark, sf).withColumn("c", cap).select("k", F.col("c.level").alias("level"), F.col("c.reason").alias("reason"))


@query
def C5_geo_matches(spark, sf):
    df = conform(bids(spark, sf)).select("k", F.explode(geo.match_fields(geo.fields(F.col("doc_text")), RULES)).alias("m"))
    return df.select("k", F.col("m.name").alias("field"), joined("m.hits").alias("hits"), joined("m.districts").alias("districts"))


@query
def C6_snapshot_merge(spark, sf):
    return merged(spark, sf).select(
        "identity_key", "action", "bid_end_at", "estimated_value", "first_seen_on", "last_seen_on", "score", "status"
    )


@query
def C7_change_detection(spark, sf):
    return changed(spark, sf).select("identity_key", "field_name", "old_value", "new_value", "note", "detected_on")


def portal_candidates(spark, sf):
    """Each bid is found by every query its key divides into."""
    b = bids(spark, sf)
    return b.select("*", F.explode(F.array(F.lit(2), F.lit(3), F.lit(5), F.lit(1))).alias("q")).filter("k % q = 0").select(
        *b.columns, F.concat(F.lit("p"), F.col("q")).alias("query"), F.col("q").alias("query_pos"), F.col("k").alias("pos")
    )


def hit_candidates(spark, sf):
    return hits.candidates(views.view(spark, sf, "hits"), RULES).withColumnRenamed("hit_pos", "pos")


@lru_cache(maxsize=8)
def discovered(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.merge_sources({"portal": portal_candidates(spark, sf), "search": hit_candidates(spark, sf)})


@query
def C8_discovery_merge(spark, sf):
    return discovered(spark, sf).select(
        "identity_key", "adapter", "title", joined("discovered_via", ",").alias("discovered_via"),
        joined(F.transform("matched_queries", lambda q: q["query"]), ",").alias("queries"), "sightings",
    )


def reviewed(spark, sf):
    payload = views.view(spark, sf, "payloads").select(
        identity.identity_key(tender_id=F.lit(""), title=F.lit(""), buyer=F.lit(""), closing=F.lit(None).cast("timestamp_ntz")).alias("identity_key"),
        "payload",
    )
    return daily.analyse(daily.shortlist(bids(spark, sf), RULES, NOW), RULES, NOW, payload)


@query
def C9_corrections(spark, sf):
    out = reviewed(spark, sf)
    return out.select(
        "k", "plain_summary", "next_action", joined("risks").alias("risks"),
        F.col("classification.is_it_related").alias("related"), F.col("classification.kind").alias("kind"),
        F.col("classification.confidence").alias("confidence"), F.col("geo.in_region").alias("in_region"),
        F.col("geo.confidence").alias("geo_confidence"),
        joined(F.transform("required_documents", lambda d: d["canonical"])).alias("documents"),
        joined("requirements.eligibility", " | ").alias("eligibility"), joined("requirements.technical", " | ").alias("technical"),
        joined("flags", " | ").alias("flags"),
    )


@query
def C10_district_coverage(spark, sf):
    serves = eligibility.serves_district(F.col("geo.districts"), eligibility.profile_of(RULES))
    return listed(spark, sf).select("k", F.coalesce(serves.cast("string"), F.lit("not known")).alias("serves"))


@query
def C11_change_labels(spark, sf):
    out = report.change_log(changed(spark, sf), second_day(spark, sf))
    return out.select("identity_key", "label", joined("lines", "\n").alias("lines"))


@query
def C12_rejection_labels(spark, sf):
    return report.label_reasons(report.rejections(stored(spark, sf), screened_out(spark, sf)), RULES)


# -- D: aggregates ---------------------------------------------------------
@query
def D1_rejections(spark, sf):
    return report.rejections(stored(spark, sf), screened_out(spark, sf)).orderBy(F.col("n").desc(), "reason")


@query
def D2_counters(spark, sf):
    return report.counters(accepted(spark, sf))


@query
def D3_emd_totals(spark, sf):
    return report.emd_totals(accepted(spark, sf))


@query
def D4_document_demand(spark, sf):
    return report.document_demand(accepted(spark, sf))


def run_manifest(spark, sf):
    pages_read = detail_pages(spark, sf).filter("bid_number <> ''").join(stored(spark, sf).select("bid_number"), "bid_number", "left_semi")
    return report.manifest(
        stored(spark, sf), screened_out(spark, sf), merged(spark, sf), issues(spark, sf), degraded(spark, sf),
        dims.search_queries(spark, RULES), pages_read, views.table(spark, sf, "documents"), "run-1", "2026-09-06T08:30:00+05:30", "2026-09-06T09:00:00+05:30",
    )


@query
def D5_run_manifest(spark, sf):
    m = run_manifest(spark, sf)
    counts = F.transform(F.array_sort(F.map_entries("rejected")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select(
        "run_id", "queries", "details_fetched", "documents_downloaded", "listings_seen", "candidates", "accepted", "watchlist", joined(counts, ",").alias("rejected"),
        "new_tenders", "updated_tenders", F.aggregate("issues", F.lit(0).cast("long"), lambda n, e: n + e["n"]).alias("issues"), joined("degraded_modes", ",").alias("degraded"),
    )


@query
def D6_new_and_updated(spark, sf):
    return merged(spark, sf).groupBy("action").agg(F.count("*").alias("n"))


@query
def D7_matched_queries(spark, sf):
    found = discovery.found_by(discovery.tagged(portal_candidates(spark, sf), "portal", 0))
    told = F.transform("matched_queries", lambda q: F.concat(q["query"], F.lit("x"), q["sightings"].cast("string")))
    return found.select("identity_key", joined(told, ",").alias("queries"), "sightings")


@query
def D8_expire(spark, sf):
    stored = snapshot.expire(merged(spark, sf), "2026-09-12")
    return stored.groupBy("status").agg(F.count("*").alias("n"), F.count_if("just_closed").alias("just_closed"))


@query
def D9_has_text(spark, sf):
    files = doc_files(spark, sf).withColumn("text_chars", F.when(F.col("pos") % 2 == 0, F.col("text_chars")).otherwise(0))
    return documents.has_text(files)


@query
def D10_changes_on_day(spark, sf):
    """The changes of one bid, read from the day's folder of the change log."""
    root = new_folder(spark, "change-log")
    snapshots.write_partition(changed(spark, sf).drop("detected_on"), root, "detected_on", TODAY_2)
    bid = spark.read.parquet(root).agg(F.min("identity_key").alias("key")).first()["key"]
    return snapshots.changes_for(spark, root, bid, TODAY_2).select("field_name", "old_value", "new_value", "note")


@query
def D11_score_total(spark, sf):
    return analysed(spark, sf).select("k", F.col("score.total").alias("total"))


# -- E: order --------------------------------------------------------------
@query
def E1_identity_dedupe(spark, sf):
    everything = discovery.tagged(portal_candidates(spark, sf), "portal", 0)
    return discovery.first_seen(everything).select("identity_key", "query", "pos", "title")


@query
def E2_ranking(spark, sf):
    return ranked(spark, sf).select("rank", "identity_key", F.col("score.total").alias("score"), "urgency", "days_remaining")


@query
def E3_action_order(spark, sf):
    top = ranking.first_rows(accepted(spark, sf), ranking.action_order())
    return top.select("identity_key", "days_remaining", F.col("score.total").alias("score"))


@query
def E4_matching_sentences(spark, sf):
    r = F.col("requirements")
    names = ("eligibility", "technical", "delivery", "warranty", "amc", "special")
    return clauses_only(spark, sf).select("k", *[joined(r[n], " | ").alias(n) for n in names], r["payment_terms"].alias("payment_terms"))


@query
def E5_best_evidence(spark, sf):
    d = clauses_only(spark, sf).select("k", F.posexplode("required_documents").alias("pos", "d"))
    return d.select(
        "k", "pos", F.col("d.canonical").alias("canonical"), F.col("d.confidence").alias("confidence"),
        joined(F.transform("d.evidence", lambda e: e["quote"]), " | ").alias("quotes"),
    )


@query
def E6_first_last_seen(spark, sf):
    return merged(spark, sf).groupBy("first_seen_on", "last_seen_on").agg(F.count("*").alias("n"))


@query
def E7_slices(spark, sf):
    return analysed(spark, sf).select(
        "k", joined(lists.take("classification.matched_signals", 6), ",").alias("signals"),
        joined(lists.take("geo.matched_terms", 5), ",").alias("terms"), joined(lists.take("eligibility.verification_points", 8)).alias("points"),
    )


# -- F: sets ---------------------------------------------------------------
@query
def F1_union_counters(spark, sf):
    parts = {"portal": portal_candidates(spark, sf), "search": hit_candidates(spark, sf)}
    out = None
    for i, (name, df) in enumerate(parts.items()):
        t = discovery.tagged(df, name, i).select("adapter", "query", "identity_key")
        out = t if out is None else out.unionByName(t)
    return out.groupBy("adapter").agg(F.count("*").alias("listings"), F.countDistinct("query").alias("queries"))


@query
def F2_distinct_ci(spark, sf):
    arr = F.array("title", F.upper("title"), F.concat(F.lit(" "), F.col("delivery_location")), "buyer_organization", F.lower("delivery_location"), F.lit(" "))
    return bids(spark, sf).select("k", joined(lists.distinct_ci(arr), "|").alias("values"))


@query
def F3_flag_sets(spark, sf):
    return judged(spark, sf).select("k", F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query
def F4_category_overlap(spark, sf):
    mine = lists.strings(RULES.profile["strong"] + RULES.profile["moderate"])
    return listed(spark, sf).select("k", joined(F.array_intersect("classification.categories", mine)).alias("shared"))


# -- G: scalars ------------------------------------------------------------
@query
def G1_clean(spark, sf):
    d = spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", text.clean("text").alias("c")).select("doc_id", F.length("c").alias("chars"), F.md5("c").alias("digest"))


@query
def G2_normalize_key(spark, sf):
    return bids(spark, sf).select("k", text.normalize_key(F.concat_ws(" / ", "title", "delivery_location", "bid_number")).alias("key"))


@query
def G3_strip_label(spark, sf):
    cell = F.concat(F.when(F.col("k") % 2 == 0, "Quantity : ").otherwise("quantity- "), F.col("title"))
    return bids(spark, sf).select("k", text.strip_label(cell, "Quantity").alias("value"))


def dated(spark, sf):
    at = F.col("bid_end_at")
    forms = {0: "dd-MM-yyyy HH:mm:ss", 1: "dd/MM/yyyy HH:mm", 2: "dd-MMM-yyyy", 3: "d MMMM yyyy", 4: "yyyy-MM-dd HH:mm:ss", 5: "'Bid closes on' dd-MM-yyyy HH:mm 'IST'", 6: "dd-MM-yyyy hh:mm a"}
    out = F.when(F.lit(False), "")
    for i, f in forms.items():
        out = out.when(F.col("k") % 8 == i, F.date_format(at, f))
    return bids(spark, sf).select("k", F.col("bid_end_at").alias("at"), F.coalesce(out, F.lit("as per schedule")).alias("raw"))


@query
def G4_parse_datetime(spark, sf):
    return dated(spark, sf).select("k", "raw", day(values.parse_datetime("raw")).alias("parsed"))


def priced(spark, sf):
    n = (F.col("k") % 90 + 10).cast("string")
    raw = (
        F.when(F.col("k") % 7 == 0, F.concat(F.lit("Rs. "), n, F.lit(",50,000.50")))
        .when(F.col("k") % 7 == 1, F.concat(n, F.lit(".5 Crore"))).when(F.col("k") % 7 == 2, F.concat(F.lit("₹"), n, F.lit("000")))
        .when(F.col("k") % 7 == 3, "NIL").when(F.col("k") % 7 == 4, "Not applicable").when(F.col("k") % 7 == 5, F.concat(n, F.lit(" lakhs approx")))
        .otherwise("to be intimated later")
    )
    return bids(spark, sf).select("k", raw.alias("raw"))


@query
def G5_parse_amount(spark, sf):
    return priced(spark, sf).select("k", "raw", values.parse_amount("raw").alias("amount"))


@query
def G6_parse_percentage(spark, sf):
    n = (F.col("k") % 12).cast("string")
    raw = F.when(F.col("k") % 3 == 0, F.concat(n, F.lit(".5 % of value"))).when(F.col("k") % 3 == 1, F.concat(n, F.lit(" per cent"))).otherwise(n)
    return bids(spark, sf).select("k", values.parse_percentage(raw).alias("pct"))


@query
def G7_parse_quantity(spark, sf):
    n = (F.col("k") % 60).cast("string")
    raw = F.when(F.col("k") % 3 == 0, F.concat(F.lit("1,"), F.lpad(n, 3, "0"), F.lit(" Units"))).when(F.col("k") % 3 == 1, n).otherwise("several")
    return bids(spark, sf).withColumn("q", values.parse_quantity(raw)).select("k", F.col("q.number").alias("number"), F.col("q.unit").alias("unit"))


@query
def G8_snippet(spark, sf):
    d = spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    mid = F.floor(F.length("text") / 2).cast("int")
    return d.select("doc_id", text.snippet("text", mid).alias("snippet"))


@query
def G9_truncate(spark, sf):
    return bids(spark, sf).select("k", text.truncate("title", 20).alias("short"))


@query
def G10_identity_key(spark, sf):
    df = bids(spark, sf).withColumn("source_url", F.when(F.col("k") % 100 == 99, "").otherwise(F.col("source_url")))
    return conform(df).select("k", "identity_key")


@query
def G11_bid_number(spark, sf):
    said = F.concat(F.lit("see "), F.lower("bid_number"), F.lit(", xGEM/2026/B/1 GEM/26/B/2"))
    return bids(spark, sf).select("k", identity.bid_number(said).alias("found"))


@query
def G12_days_remaining(spark, sf):
    at = F.when(F.col("k") % 30 == 5, F.lit("2026-09-06 07:00:00").cast("timestamp_ntz")).otherwise(F.col("bid_end_at"))
    return bids(spark, sf).select("k", values.days_remaining(at, NOW).cast("double").alias("days"))


@query
def G13_urgency(spark, sf):
    d = values.days_remaining("bid_end_at", NOW)
    return bids(spark, sf).select(values.urgency(d, RULES.deadline["bands"]).alias("urgency")).groupBy("urgency").agg(F.count("*").alias("n"))


def value_pairs(spark, sf):
    old, new = F.col("estimated_value"), F.when(F.col("k") % 6 == 0, F.col("estimated_value") + 0.005).when(F.col("k") % 6 == 3, F.lit(0.0)).otherwise(F.col("estimated_value") * 1.1)
    old = F.when(F.col("k") % 9 == 3, None).otherwise(old)
    return bids(spark, sf).select("k", old.alias("o"), new.alias("n"), F.nullif("portal_status", F.lit("")).alias("so"), F.col("ra_enabled").alias("sn"))


@query
def G14_same_value(spark, sf):
    return value_pairs(spark, sf).select(
        "k", snapshot.same_number(F.col("o"), F.col("n")).alias("same_number"), snapshot.same_text(F.col("so"), F.col("sn")).alias("same_text")
    )


@query
def G15_display(spark, sf):
    said = F.when(F.col("k") % 4 == 0, snapshot.iso("bid_end_at")).when(F.col("k") % 4 == 1, "not_stated").when(F.col("k") % 4 == 2, "").otherwise(F.col("title"))
    return bids(spark, sf).select("k", snapshot.display(said).alias("shown"), snapshot.display(F.col("quantity"), True).alias("number"))


@query
def G16_change_sentence(spark, sf):
    return changed(spark, sf).select("identity_key", snapshot.change_sentence().alias("line"))


@query
def G17_money(spark, sf):
    return bids(spark, sf).select("k", report.value_line().alias("value"))


@query
def G18_summary(spark, sf):
    return analysed(spark, sf).select("k", corrections.summary_text().alias("summary"))


@query
def G19_lines(spark, sf):
    return judged(spark, sf).select(
        "k", report.buyer_line().alias("buyer"), report.location_line().alias("location"), report.quantity_line().alias("quantity"),
        report.closing_line().alias("closing"), report.one_liner().alias("one_liner"), report.deadline_line().alias("deadline"),
    )


@query
def G20_default_action(spark, sf):
    return judged(spark, sf).groupBy(report.default_action().alias("action")).agg(F.count("*").alias("n"))


@query
def G21_headlines(spark, sf):
    return clauses_only(spark, sf).groupBy(
        emd.headline().alias("emd"), security.headline().alias("security"), security.fully_stated().alias("fully_stated")
    ).agg(F.count("*").alias("n"))


@query
def G22_security_line(spark, sf):
    return clauses_only(spark, sf).select("k", security.security_line().alias("line"))


@query
def G23_json(spark, sf):
    flat = snapshot.flat_rows(reported(spark, sf), TODAY)
    def at(path):
        return F.get_json_object("payload", path)
    return flat.select(
        "identity_key", at("$.bid_number").alias("bid_number"), at("$.urgency").alias("urgency"), at("$.geo.confidence").alias("geo_confidence"),
        at("$.emd.status").alias("emd_status"), at("$.classification.categories[0]").alias("first_category"),
    )


@query
def G24_issue_line(spark, sf):
    return issues(spark, sf).select(report.issue_line().alias("line"))


# -- H: clauses ------------------------------------------------------------
@query
def H1_emd_status(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("emd.status").alias("status"), joined("flags", " | ").alias("flags"))


@query
def H2_emd_amount(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("emd.amount").alias("amount"))


@query
def H3_emd_conflict(spark, sf):
    return clauses_only(spark, sf).select("k", F.explode("flags").alias("flag")).filter("flag LIKE 'EMD amount differs%'")


@query
def H4_payment_mode(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("emd.payment_mode").alias("payment_mode"))


@query
def H5_emd_last_date(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("emd.last_date").alias("last_date"))


@query
def H6_exemptions(spark, sf):
    e = F.col("emd")
    return clauses_only(spark, sf).select(
        "k", e["exemption_available"].alias("available"), e["msme_exemption"].alias("msme"), e["startup_exemption"].alias("startup")
    )


@query
def H7_exemption_proofs(spark, sf):
    return clauses_only(spark, sf).select("k", joined("emd.exemption_proof_required").alias("proofs"))


@query
def H8_instruments(spark, sf):
    s = F.col("security")
    return clauses_only(spark, sf).select("k", *[s[n].alias(n) for n in ("performance_security", "epbg", "security_deposit")])


@query
def H9_security_percentage(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("security.percentage").alias("percentage"))


@query
def H10_security_amount(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("security.amount").alias("amount"))


@query
def H11_validity_and_timeline(spark, sf):
    return clauses_only(spark, sf).select("k", F.col("security.validity").alias("validity"), F.col("security.submission_timeline").alias("timeline"))


@query
def H12_security_exemption(spark, sf):
    return clauses_only(spark, sf).select("k", joined("security.exemptions").alias("exemption"))


@query
def H13_sentences(spark, sf):
    d = spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    s = d.select("doc_id", F.posexplode(requirements.sentences(text.clean("text"))).alias("pos", "sentence"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("sentence")).alias("chars"), F.max("sentence").alias("last"))


@query
def H14_required_documents(spark, sf):
    d = clauses_only(spark, sf).select(F.explode("required_documents").alias("d"))
    return d.groupBy(F.col("d.canonical").alias("canonical"), F.col("d.name").alias("name"), F.col("d.confidence").alias("confidence")).agg(F.count("*").alias("n"))


@query
def H15_cue_counts(spark, sf):
    r = F.col("requirements")
    names = ("eligibility", "technical", "delivery", "warranty", "amc", "special")
    return clauses_only(spark, sf).agg(
        *[F.sum(F.size(r[n])).alias(n) for n in names], F.count(r["payment_terms"]).alias("payment")
    )


@query
def H16_requirement_flags(spark, sf):
    wanted = (requirements.FLAG_NO_TEXT, requirements.FLAG_NO_DOCUMENTS)
    return clauses_only(spark, sf).select("k", F.explode("flags").alias("flag")).filter(F.col("flag").isin(*wanted))


@query
def H17_turnover_and_years(spark, sf):
    lines = F.col("requirements.eligibility")
    return clauses_only(spark, sf).select(
        "k", eligibility.required_turnover(lines).alias("turnover"), eligibility.required_years(lines).cast("double").alias("years")
    )


# -- I: decisions ----------------------------------------------------------
@query
def I1_classification(spark, sf):
    df = classify.classify(conform(bids(spark, sf)), RULES, F.col("doc_text"))
    c = F.col("classification")
    return df.select(
        "k", c["is_it_related"].alias("related"), c["confidence"].alias("confidence"), joined(c["categories"]).alias("categories"),
        joined(c["matched_signals"]).alias("signals"), joined(c["vetoed_by"]).alias("vetoed_by"), c["reason"].alias("reason"),
    )


@query
def I2_kind(spark, sf):
    df = classify.classify(conform(bids(spark, sf)), RULES, F.col("doc_text"))
    return df.select("k", F.col("classification.kind").alias("kind"))


@lru_cache(maxsize=8)
def placed(spark: SparkSession, sf: str) -> DataFrame:
    return geo.assess(conform(bids(spark, sf)), RULES, F.col("doc_text"))


@query
def I3_region(spark, sf):
    g = F.col("geo")
    return placed(spark, sf).select(
        "k", g["in_region"].alias("in_region"), g["confidence"].alias("confidence"), joined(g["matched_fields"]).alias("fields"),
        joined(g["districts"]).alias("districts"), g["reason"].alias("reason"),
    )


@query
def I4_ambiguous_places(spark, sf):
    where = F.concat_ws(", ", F.when(F.col("k") % 3 == 0, "Mango").when(F.col("k") % 3 == 1, "JH, chas"), F.when(F.col("k") % 2 == 0, F.col("delivery_location")))
    df = geo.assess(conform(bids(spark, sf).drop("doc_text").withColumn("delivery_location", where)), RULES)
    return df.select("k", F.col("geo.in_region").alias("in_region"), joined("geo.matched_terms").alias("terms"))


@query
def I5_substring_places(spark, sf):
    g = F.col("geo")
    return placed(spark, sf).groupBy(g["nationwide"].alias("nationwide"), g["in_region"].alias("in_region")).agg(
        F.count("*").alias("n"), F.count_if(g["reason"].contains("locations point to")).alias("elsewhere")
    )


# -- J: score components ---------------------------------------------------
def _component(i: int, name: str) -> None:
    def run(spark, sf):
        c = F.get("score.components", F.lit(i))
        return analysed(spark, sf).select("k", c["points"].alias("points"), c["max_points"].alias("max_points"), c["reason"].alias("reason"))

    run.__name__ = f"J{i + 1}_{name}"
    query(run)


for _i, _name in enumerate(scoring.COMPONENTS):
    _component(_i, _name)


@query
def J8_bands(spark, sf):
    return analysed(spark, sf).select("k", F.col("score.band").alias("band"), F.col("score.rank_label").alias("rank_label"), report.bucket().alias("bucket"))


@query
def J9_component_lines(spark, sf):
    return analysed(spark, sf).select("k", joined(scoring.component_lines(), "\n").alias("lines"))


# -- K: eligibility --------------------------------------------------------
def _points(name: str, field: str, *starts: str) -> None:
    """Eligibility points that begin with one of the given words."""

    def run(spark, sf):
        e = analysed(spark, sf).select("k", F.explode(F.concat(*[F.col(f"eligibility.{f}") for f in field.split("+")])).alias("point"))
        test = F.lit(False)
        for s in starts:
            test = test | F.col("point").like(s)
        return e.filter(test)

    run.__name__ = name
    query(run)


_points("K1_category", "supporting_points+gaps+verification_points", "Product/service category%", "Category is%", "Whether we can%")
_points("K2_location", "supporting_points+verification_points", "Work location is%", "Service coverage%", "Actual work location%")
_points("K3_oem", "gaps+verification_points", "OEM Authorization%")
_points("K4_turnover", "gaps+supporting_points+verification_points", "%urnover requirement%")
_points("K5_experience_years", "gaps+supporting_points+verification_points", "Requirement of % years%", "%-year experience%", "% years' experience required%")
_points("K6_past_supply", "gaps+supporting_points+verification_points", "Past %", "We have prior%")
_points("K7_emd_funding", "gaps+supporting_points+verification_points", "Ability to fund%", "EMD %", "No EMD%", "MSME EMD%")
_points("K8_security", "verification_points", "Performance security%")


@query
def K10_verdict(spark, sf):
    e = F.col("eligibility")
    return analysed(spark, sf).select(
        "k", e["match_level"].alias("match_level"), e["verdict"].alias("verdict"), F.size(e["supporting_points"]).alias("supporting"),
        F.size(e["gaps"]).alias("gaps"), F.size(e["verification_points"]).alias("verify"),
    )


FULL_PROFILE = dict(
    RULES.profile, annual_turnover_inr=2_000_000, years_in_business=6, can_arrange_emd_upto_inr=50_000, msme_registered=True,
    government_supply_experience=False, oem_held=["HP"], avoid_keywords=["all-in-one"],
)


@query
def K10_known_profile(spark, sf):
    """The same verdict for a supplier who has filled in every field."""
    df = eligibility.assess_eligibility(analysed(spark, sf).drop("eligibility"), RULES.with_profile(**FULL_PROFILE))
    e = F.col("eligibility")
    return df.select(
        "k", e["match_level"].alias("match_level"), e["verdict"].alias("verdict"), joined(e["supporting_points"], " | ").alias("supporting"),
        joined(e["gaps"], " | ").alias("gaps"), F.size(e["verification_points"]).alias("verify"),
    )


@query
def K9_avoid_list(spark, sf):
    """Points on the avoid list of a supplier whose keyword occurs."""
    df = eligibility.assess_eligibility(analysed(spark, sf).drop("eligibility"), RULES.with_profile(**FULL_PROFILE))
    return df.select("k", F.explode("eligibility.gaps").alias("point")).filter("point LIKE 'Matches an avoid-list%'")


# -- L: incremental --------------------------------------------------------
@query
def L1_amendment_feed(spark, sf):
    """Two days of listing files through the stream; actions and changes counted."""
    root = new_folder(spark, "feed")
    source = f"{root}/incoming"
    days = ((reported(spark, sf), TODAY), (second_day(spark, sf), TODAY_2))
    for df, today in days:
        rows = snapshot.flat_rows(df, today).drop("payload").withColumn("as_of", F.lit(today))
        rows.write.mode("append").parquet(source)
        amendments.run_available(spark, source, rows.schema, root)
    kept = amendments.store(spark, root, rows.schema)
    acted = kept.log("actions", amendments.ACTIONS).groupBy("batch", F.col("action").alias("what"))
    diffs = kept.log("changes", amendments.CHANGES).groupBy("batch", F.col("field_name").alias("what"))
    return acted.agg(F.count("*").alias("n")).unionByName(diffs.agg(F.count("*").alias("n")))


@query
def L1_listing_stream(spark, sf):
    """Two days of saved listing pages through the stateful stream: each bid's last verdict and how often it was judged."""
    root = new_folder(spark, "listings")
    for name, at in (("listing_cards", NOW), ("next_cards", NOW_2)):
        saved = views.listing_pages(spark, sf, name).select("url", "html", F.lit(at).cast("timestamp").alias("seen_at"))
        saved.write.mode("append").parquet(f"{root}/pages")
        listings.run_available(spark, f"{root}/pages", root, RULES, NOW_2)
    last = F.struct("batch", "action", "verdict", "reason", "urgency", "score")
    out = listings.read_verdicts(spark, root).groupBy("identity_key").agg(F.max_by(last, "batch").alias("l"), F.count("*").alias("judged"))
    return out.select("identity_key", "l.action", "l.verdict", "l.reason", "l.urgency", "l.score", "judged")


# -- M: report -------------------------------------------------------------
def lines(df: DataFrame) -> DataFrame:
    return df.select("section", joined(F.transform("seq", lambda x: x.cast("string")), ".").alias("seq"), "kind", "text")


@query
def M1_executive_summary(spark, sf):
    return lines(report.executive_summary(accepted(spark, sf), watch(spark, sf), changed(spark, sf), issues(spark, sf)))


@query
def M2_data_quality(spark, sf):
    counts = report.rejections(stored(spark, sf), screened_out(spark, sf))
    return lines(report.data_quality(counts, issues(spark, sf), degraded(spark, sf), RULES, run_manifest(spark, sf)))


@query
def M3_priority(spark, sf):
    return lines(report.priority(ranked(spark, sf)))


@query
def M4_urgent(spark, sf):
    return lines(report.urgent(ranked(spark, sf)))


@query
def M5_detailed(spark, sf):
    return lines(report.detailed(ranked(spark, sf)))


@query
def M6_emd_summary(spark, sf):
    return lines(report.emd_summary(ranked(spark, sf)))


@query
def M7_documents_summary(spark, sf):
    return lines(report.documents_summary(accepted(spark, sf)))


@query
def M8_risks(spark, sf):
    return lines(report.risks(ranked(spark, sf)))


@query
def M9_actions(spark, sf):
    return lines(report.actions(ranked(spark, sf)))


@query
def M10_watchlist(spark, sf):
    return lines(report.watchlist(ranked(spark, sf, "watchlist")))


@query
def M11_change_log(spark, sf):
    out = report.change_section(changed(spark, sf), second_day(spark, sf))
    return out.groupBy("section", "kind", "text").agg(F.count("*").alias("n"))


@query
def M12_references(spark, sf):
    return lines(report.references(ranked(spark, sf), ranked(spark, sf, "watchlist")))


@query
def M_report_lines(spark, sf):
    """The whole report as one table of numbered lines."""
    counts = report.rejections(stored(spark, sf), screened_out(spark, sf))
    return report.report_lines(
        ranked(spark, sf), ranked(spark, sf, "watchlist"), changed(spark, sf), second_day(spark, sf), counts, issues(spark, sf), degraded(spark, sf), RULES,
        run_manifest(spark, sf),
    )


# -- the whole run ---------------------------------------------------------
@lru_cache(maxsize=8)
def whole_run(spark: SparkSession, sf: str) -> run.Run:
    """From saved listing pages, notices, detail pages and files."""
    details = detail_pages(spark, sf).select("url", "html")
    notices = views.view(spark, sf, "notices").withColumnRenamed("hit_pos", "pos").drop("k")
    return run.run_report(views.listing_pages(spark, sf).select("url", "html"), notices, details, views.view(spark, sf, "files"), RULES, NOW)


@query
def run_report(spark, sf):
    """Verdicts of the whole run; a bid that two sources name differently is one row."""
    return whole_run(spark, sf).judged.select(
        "identity_key", "first_key", joined("discovered_via", ",").alias("discovered_via"), "sightings", "bid_number", "title", "category", "buyer_address",
        "quantity", "quantity_unit", "estimated_value", day("bid_end_at").alias("bid_end_at"), F.col("geo.reason").alias("region"), F.col("emd.status").alias("emd_status"),
        "verdict", "rejected_reason", "urgency", F.col("score.total").alias("score"), F.size("required_documents").alias("documents"),
    )


@query
def run_report_counts(spark, sf):
    """The same run's figures: candidates, what was screened out and why, verdicts, pages and documents read."""
    r = whole_run(spark, sf)
    parts = (
        r.candidates.select(F.lit("candidate").alias("what"), F.array_join("discovered_via", ",").alias("which")),
        r.screened_out.select(F.lit("screened out"), "screen_reason"),
        r.judged.select(F.lit("verdict"), "verdict"),
        r.details_read.select(F.lit("detail page"), F.lit("read")),
        r.documents_read.select(F.lit("document"), F.lit("read")),
    )
    out = None
    for part in parts:
        out = part if out is None else out.union(part)
    return out.groupBy("what", "which").agg(F.count("*").alias("n"))


# -- N: extension ----------------------------------------------------------
@query
def N1_own_source(spark, sf):
    """A source is any DataFrame of candidates: here saved listing pages join the search hits."""
    own = pages.listing_cards(views.listing_pages(spark, sf), RULES).withColumn("query", F.lit("saved page")).drop("page_url")
    both = discovery.merge_sources({"pages": own, "search": hit_candidates(spark, sf)})
    return both.groupBy(joined("discovered_via", ",").alias("discovered_via")).agg(F.count("*").alias("bids"), F.sum("sightings").alias("sightings"))


@query
def N2_own_rules(spark, sf):
    """Another region as rules: the same operators, other tables."""
    from dataclasses import replace

    kerala = dict(RULES.geography, state="Kerala", state_aliases=["kerala"], districts=["Thiruvananthapuram", "Kochi"], localities=["Kovalam"], ambiguous_localities=[], local_organisations=["Cochin Shipyard"])
    df = geo.assess(conform(bids(spark, sf)), replace(RULES, geography=kerala), F.col("doc_text"))
    g = F.col("geo")
    return df.groupBy(g["in_region"].alias("in_region"), g["confidence"].alias("confidence"), joined(g["districts"]).alias("districts")).agg(F.count("*").alias("n"))


@query
def N3_parameters(spark, sf):
    """Two suppliers, given as a table of parameters, judged in one query."""
    told = [(name, json.dumps(dict(p))) for name, p in (("default", RULES.profile), ("known", FULL_PROFILE))]
    profiles = spark.createDataFrame(told, "profile string, settings string").withColumn("settings", F.from_json("settings", eligibility.PROFILE))
    df = daily.judge_for(analysed(spark, sf), profiles, RULES)
    e = F.col("eligibility")
    return df.select(
        "k", "profile", e["match_level"].alias("match_level"), e["verdict"].alias("fit"), joined(e["gaps"], " | ").alias("gaps"),
        joined(e["supporting_points"], " | ").alias("supporting"), F.col("score.total").alias("score"), "verdict", "rejected_reason",
    )


@query
def verdict_summary(spark, sf):
    """Flagship: the whole daily analysis, counted by verdict and reason.

    Scores have one decimal; their mean is taken on whole tenths, so that it does not depend on the order of the sum.
    """
    out = judged(spark, sf).groupBy("verdict", F.coalesce("rejected_reason", F.lit("")).alias("reason"), "urgency").agg(
        F.count("*").alias("bids"), F.sum(F.round(F.col("score.total") * 10).cast("bigint")).alias("tenths"),
        F.sum(F.when(F.col("emd.status") == "required", F.col("emd.amount"))).alias("emd_total"),
    )
    return out.withColumn("mean_score", F.expr("CAST((20 * tenths + bids) DIV (2 * bids) AS DOUBLE) / 100")).drop("tenths")
