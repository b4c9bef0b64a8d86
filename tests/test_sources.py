from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bidlens.functions import values
from bidlens.operators import corrections, discovery, snapshot
from bidlens.plans import daily, report, views
from bidlens.plans.views import SITE, number
from bidlens.schema import conform
from bidlens.sources import documents, hits, pages, snapshots



def card(n, items, department, end, category="Goods", kind="card"):
    return (
        f'<div class="{kind}"><div class="col-block"><a class="bid_no_hover" href="/showbidDocument/{n}">{number(n)}</a></div>'
        f'<div class="col-block">Items: {items}</div><div class="col-block">Quantity: {n} Nos</div><div class="col-block">Category: {category}</div>'
        f'<div class="col-block">Department Name And Address: {department}</div>'
        f'<div class="col-block">Start Date: <span class="start_date">02-09-2026 10:00:00</span></div>'
        f'<div class="col-block">End Date: <span class="end_date">{end} 17:30:00</span></div></div>'
    )


# One or more cards for every way out of the screen and the gate.
DAY = [
    card(11, "Barcode Scanner with\n  stand", "District Library, Deoghar, Jharkhand", "09-09-2026"),
    card(12, "Cotton blankets", "Hostel, Chatra", "09-09-2026"),
    card(13, "Tea and snacks (catering) at meetings", "Circuit House, Hazaribagh", "06-09-2026"),
    card(14, "Interactive Panel for the training hall", "Law College, Nagpur, Maharashtra", "15-09-2026"),
    card(15, "Antivirus renewal", "Mint Street, Chennai", "08-09-2026"),
    card(16, "Structured Cabling and Patch Panel", "Treasury, Jamshedpur, Jharkhand", "05-09-2026"),
    card(17, "Help desk and system administrator for the registry", "Collectorate, Dumka, Jharkhand", "06-09-2026"),
    card(18, "Thin Client terminals", "Museum, Pakur, Jharkhand", "09-11-2026"),
    card(19, "Video Wall", "Stadium, Palamu, Jharkhand", "20-10-2026"),
]


def page(spark, *bodies):
    return spark.createDataFrame([(f"{SITE}/all-bids?page={i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)], "url string, html string")


def row(label, value):
    return f"<tr><td>{label}</td><td>{value}</td></tr>"


DETAILS = {
    11: [row("EMD Amount", "Rs. 12,500"), row("Estimated Bid Value", "Rs. 6,10,000"), row("Unknown", "x"), row("EMD", "ignored"), row("MSE Exemption", "No")],
    17: [row("ePBG Percentage(%)", "5.00"), row("EMD Amount", "0"), row("Ministry/State Name", "Ministry of Tourism")],
    19: [row("Bid End Date/Time", "to be told"), row("Estimated Bid Value", "Rs. 44,00,000")],
}


def test_whole_day_from_saved_pages(spark, rules, now):
    """Nine cards in; each leaves by the verdict or reason that it was made for, and a rerun changes nothing."""
    found = pages.listing_cards(page(spark, "".join(DAY)), rules)
    assert found.count() == len(DAY)
    details = spark.createDataFrame([(number(n), f"{SITE}/d/{n}", f"<table class='table'>{''.join(r)}</table>") for n, r in DETAILS.items()], "bid_number string, url string, html string")
    judged, out = daily.run(pages.merge_details(found, details, rules), rules, now)
    got = {int(r.bid_number[-2:]): r for r in judged.collect()}
    assert {n: (r.verdict, r.urgency) for n, r in got.items()} == {11: ("accepted", "HIGH PRIORITY"), 17: ("accepted", "URGENT"), 19: ("watchlist", "WATCHLIST")}
    assert (got[11].emd.amount, got[11].estimated_value, got[11].emd.msme_exemption) == (12_500.0, 610_000.0, "not_required")
    assert (got[17].emd.status, got[17].security.percentage, got[17].quantity_unit, got[17].estimated_value) == ("not_required", 5.0, "Nos", None)
    reasons = {r.reason: r.n for r in report.rejections(judged, out).collect()}
    assert reasons == {"not_it_related": 2, "not_jharkhand": 2, "expired": 1, "outside_10_day_window": 1}
    rows = snapshot.flat_rows(judged, "2026-09-06").persist()
    again = snapshot.joined(rows, rows)
    assert {r.action for r in snapshot.merge(snapshot.joined(rows.limit(0), rows), rows.columns).collect()} == {"new"}
    assert {r.action for r in snapshot.merge(again, rows.columns).collect()} == {"updated"} and snapshot.changes(again, "2026-09-06").count() == 0


def test_drift_is_loud_and_emptiness_is_not(spark, rules):
    gone = f"<div class='newcard'>Bid Number: {number(1234567)} Bid End Date: 10-09-2026</div>"
    nameless = '<div class="card"><div class="col-block">Items: laptops</div></div>'
    got = {r.url[-1]: r.state for r in pages.drift(page(spark, gone, "<p>No results found.</p>", DAY[0], nameless), rules).collect()}
    assert got == {"0": "PARSER_DRIFT", "1": "empty", "2": "ok", "3": "PARSER_DRIFT"}


@pytest.mark.parametrize("name,kind", [("Buyer Added Bid Specific ATC", "atc"), ("Corrigendum 1", "corrigendum"), ("Technical Specification", "technical_spec"),
                                       ("Scope of Work", "scope_of_work"), ("Bid Document", "bid_document"), ("random.bin", "unknown")])
def test_document_kinds(spark, name, kind):
    assert spark.range(1).select(pages.document_kind(F.lit(name)).alias("k")).first().k == kind


def test_attachments_are_the_union_of_link_shapes(spark, rules):
    body = '<a href="/showbidDocument/1">Bid Document</a><a href="/showradocumentPdf/1-atc">ATC</a><a href="x/y.pdf"></a><a href="/showbidDocument/1">again</a><a href="/about">About</a>'
    got = {(r.url, r.name) for r in pages.attachments(page(spark, body), rules).collect()}
    assert got == {(f"{SITE}/showbidDocument/1", "Bid Document"), (f"{SITE}/showradocumentPdf/1-atc", "ATC"), (f"{SITE}/x/y.pdf", "y.pdf")}


def test_search_hits_need_an_official_host(spark, rules):
    df = spark.createDataFrame([("q", f"Scanners {number(77).lower()}", "s", f"{SITE}/x"), ("q", "t", "s", f"https://evil.com/{number(1)}"), ("q", "", "", f"{SITE}/y")], "query string, title string, snippet string, link string")
    got = {r.source_url: (r.bid_number, r.title) for r in hits.candidates(df, rules).collect()}
    assert got == {f"{SITE}/x": (number(77), f"Scanners {number(77).lower()}"), f"{SITE}/y": ("", f"{SITE}/y")}


def test_merge_records_every_finder_even_for_a_hot_bid(spark):
    """One bid holds a third of all sightings."""
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, number(1)).otherwise(F.concat(F.lit(number("")), F.col("id"))).alias("bid_number"),
                                   F.concat(F.lit("t"), F.col("id")).alias("title"), F.concat(F.lit("q"), F.col("id") % 2).alias("query"), F.col("id").alias("pos"))
    other = spark.createDataFrame([(number(1), "late", "s", 0)], "bid_number string, title string, query string, pos long")
    got = {r.bid_number: r for r in discovery.merge_sources({"portal": hot, "search": other}).collect()}
    one = got[number(1)]
    assert len(got) == 2000 and one.title == "t0" and one.discovered_via == ["portal", "search"] and one.sightings == 1002
    assert [(q.query, q.sightings) for q in one.matched_queries] == [("q0", 500), ("q1", 501), ("s", 1)]


def test_budget_keeps_rows_and_flags_them(spark):
    docs = spark.createDataFrame([("a", 0, 5), ("a", 1, 0), ("b", 2, 7), ("b", 3, 1), ("c", 4, 1)], "identity_key string, pos int, text_chars int")
    got = {r.identity_key: (r.documents_read, bool(r.budget_flag)) for r in documents.document_budget(docs, [F.col("pos")], 3).collect()}
    assert got == {"a": (2, False), "b": (1, True), "c": (0, False)}


def test_assembled_text_keeps_order(spark):
    docs = spark.createDataFrame([("a", 1, "B", "atc", "two"), ("a", 0, "A", "unknown", "one"), ("a", 2, "C", "x", "")], "identity_key string, pos int, name string, kind string, text string")
    assert documents.assemble(docs).first().doc_text == "\n===== A (unknown) =====\none\n\n===== B (atc) =====\ntwo"


def test_changes_note_first_disclosure_and_tolerate_noise(spark):
    schema = "identity_key string, bid_end_at string, emd_status string, emd_amount double, epbg_status string, epbg_percentage double, estimated_value double, title string, status string"
    old = spark.createDataFrame([("k", "2026-09-10T15:00:00+05:30", "not_stated", None, "Required", 3.0, 100.0, "t", "open")], schema)
    new = spark.createDataFrame([("k", "2026-09-14T15:00:00+05:30", "required", 0.0, "Required", 3.0, 100.004, "t", "open")], schema)
    got = {r.field_name: r for r in snapshot.changes(snapshot.joined(old, new), "2026-09-07").collect()}
    assert set(got) == {"Closing date", "EMD requirement"}
    assert (got["Closing date"].old_value, got["Closing date"].new_value, got["Closing date"].note) == ("10 September 2026", "14 September 2026", "")
    assert got["EMD requirement"].note == snapshot.FIRST_TIME


def test_expiry_closes_from_the_next_day(spark):
    df = spark.createDataFrame([("a", "2026-09-06T10:00:00", "open"), ("b", "2026-09-05T23:00:00", "open"), ("c", None, "open")], "identity_key string, bid_end_at string, status string")
    assert {r.identity_key: r.status for r in snapshot.expire(df, "2026-09-06").collect()} == {"a": "open", "b": "closed", "c": "open"}


def test_partition_rewrite_is_idempotent(spark, tmp_path):
    for _ in range(2):
        snapshots.write_partition(spark.range(5), str(tmp_path / "s"), "day", "2026-09-06")
    snapshots.write_partition(spark.range(3), str(tmp_path / "s"), "day", "2026-09-07")
    assert snapshots.read_partition(spark, str(tmp_path / "s"), "day", "2026-09-06").count() == 5
    assert spark.read.parquet(str(tmp_path / "s")).count() == 8


def test_corrections_need_a_quote(make, rows, rules, now):
    import json

    base = {"plain_summary": " New  text ", "is_it_related": False, "tender_kind": "service", "jharkhand_relevance": "no"}
    payloads = [base, {**base, "classification_evidence": "furniture", "jharkhand_evidence": "Kochi"},
                {"jharkhand_relevance": "unclear", "additional_required_documents": [{"name": "Test Report", "evidence": ""}, {"name": "Visit Slip", "evidence": "attach slip"}]}]
    df = make(*[{"bid_number": number(i)} for i in range(3)])
    told = df.sparkSession.createDataFrame([(f"bid:{number(i)}", json.dumps(p)) for i, p in enumerate(payloads)], "identity_key string, payload string")
    got = rows(daily.analyse(df, rules, now, told))
    assert (got[0].classification.is_it_related, got[0].geo.in_region, got[0].plain_summary) == (True, True, "New text")
    assert (got[1].classification.is_it_related, got[1].classification.kind, got[1].geo.in_region) == (False, "service", False)
    assert got[2].geo.confidence == "unclear" and [d.canonical for d in got[2].required_documents] == ["llm:visit slip"]
    assert got[2].plain_summary.startswith("Department of Higher Education") and corrections.KINDS


def test_missing_stays_missing(spark):
    r = conform(spark.createDataFrame([("x",)], "title string")).first()
    assert r.quantity is None and r.estimated_value is None and r.msme_portal_flag == "not_stated" and r.identity_key.startswith("fp:")


def test_an_empty_result_replaces_a_partition(spark, tmp_path):
    for n in (3, 0):
        snapshots.write_partition(spark.range(n), str(tmp_path / "s"), "day", "2026-09-06")
    assert snapshots.read_partition(spark, str(tmp_path / "s"), "day", "2026-09-06").count() == 0


def test_details_never_repeat_a_bid(spark, rules):
    bids = spark.createDataFrame([("",)] * 5 + [(number(1),)], "bid_number string")
    details = [("", f"{SITE}/d/{i}", "<table class='table'></table>") for i in range(7)] + [(number(1), f"{SITE}/d/{x}", f"<table class='table'>{row('Ministry/State Name', f'Ministry {x}')}</table>") for x in "ab"]
    got = pages.merge_details(bids, spark.createDataFrame(details, "bid_number string, url string, html string"), rules).collect()
    assert len(got) == 6 and {r.ministry for r in got if r.bid_number} == {"Ministry b"}


SNAP = "identity_key string, bid_end_at string, emd_status string, emd_amount double, epbg_status string, epbg_percentage double, estimated_value double, title string, status string, report_doc_url string, first_seen_on string, as_of string"


def feed(spark, root, batches):
    from bidlens.streaming import amendments

    for i, rows in enumerate(batches):
        flat = [(k, end, "not_stated", None, "x", None, value, k, "open", link, day, day) for k, end, value, link, day in rows]
        amendments.merge_batch(spark.createDataFrame(flat, SNAP), i, root)
    schema = spark.createDataFrame([], SNAP).schema
    store = amendments.store(spark, root, schema)
    tables = [store.log("actions", amendments.ACTIONS).drop("batch"), store.log("changes", amendments.CHANGES).drop("batch")]
    return [sorted(map(tuple, t.select(sorted(t.columns)).collect()), key=str) for t in (store.state(), *tables)]


def test_days_in_one_batch_count_as_days_in_several(spark, tmp_path):
    days = [
        [("a", "2026-09-10", 100.0, "l", "2026-09-06"), ("b", "2026-09-10", 5.0, "", "2026-09-06")],
        [("a", "2026-09-12", 100.0, "", "2026-09-07")],
        [("a", "2026-09-14", 120.0, "", "2026-09-08"), ("c", "2026-09-10", 1.0, "", "2026-09-08")],
    ]
    apart = feed(spark, str(tmp_path / "apart"), days)
    together = feed(spark, str(tmp_path / "together"), [days[0] + days[1] + days[2]])
    assert apart == together and len(apart[0]) == 3 and len(apart[1]) == 5 and len(apart[2]) == 3
    replay = feed(spark, str(tmp_path / "apart"), days[:0])
    assert replay == apart


def test_a_title_may_follow_the_bid_link(spark, rules):
    link = f'<a class="bid_no_hover" href="/showbidDocument/5">{number(5)}</a>'
    bodies = [
        f"<div>{link}<br><div>Rack <b>Server</b><div>with rails</div></div><div>later</div></div>",  # the first div after the link
        f"<div>{link}</div><div>not a sibling</div>",
        f'<div>{link}<div>sibling</div></div><div class="col-block">Items: from the block</div>',
        f'<div>{link}<div>sibling</div></div><div class="col-block">Items: </div>',
        f"<p>before</p>{link}<span>x</span><div><p>far</p></div>",
    ]
    got = {r.page_url[-1]: (r.title, r.item_description) for r in pages.listing_cards(page(spark, *[f'<div class="card">{b}</div>' for b in bodies]), rules).collect()}
    assert got == {"0": ("Rack Server with rails", "Rack Server with rails"), "1": (number(5), ""), "2": ("from the block", "from the block"), "3": (number(5), ""), "4": ("far", "far")}


def test_detail_rows_stand_in_tables_of_their_class(spark, rules):
    div = '<div class="row bid-detail"><div class="key">Ministry Name</div><div class="value">{}</div></div>'
    bodies = [
        f"<table>{row('Ministry Name', 'layout')}</table><table class='x table'>{row('Ministry Name', 'right')}</table>{div.format('div')}",
        f"<table class='table'><tr><td><table>{row('Ministry Name', 'nested')}</table></td></tr></table>",
        f"<table class='tablet'>{row('Ministry Name', 'other')}</table>{div.format('div')}",
        f"<table class=\"table\">{row('Unknown', 'x')}</table>{div.format('div')}",
    ]
    got = {r.page_url[-1]: r.value for r in pages.detail_rows(page(spark, *bodies), rules).collect()}
    assert {k: got.get(k) for k in "023"} == {"0": "right", "2": "div", "3": None}


def test_tasks_stay_short_however_many_orders(spark, tmp_path):
    spark.range(600_000).selectExpr("id AS o_orderkey", "id % 10 AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(10).selectExpr("id AS c_custkey", "'c' AS c_name").write.parquet(f"{tmp_path}/customer.parquet")
    dealt = views.ordered(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in dealt) == 600_000 and max(r["count"] for r in dealt) <= 21_000


def test_short_ways_of_page_parsing_read_what_the_long_ways_read(spark):
    """Flat cards, pages of one table and plain stamps are read by one pattern; all else, and odd forms of these, as before."""
    fragments = [
        "", "a</div>b", "<div>a</div>b</div>c</div>", "<div><div>x</div></div>y</div>", "<div><div><div>z</div></div></div>t</div>u",
        "<diva>x</div>y</div>", "<DIV class='q'>x</Div >y</DIV>z", "<div>open", "</div></div>", "<b>i</b><!-- <div> -->k</div>l",
        "<table class=\"table\"><tr><td>A</td></tr></table>", "<table><tr></tr></table>t", "x<table class='x table'>1<table>2</table>3</table>4",
        "<tablex class=\"table\">q</table>", "<table class=\"table\">open", "</table><table class=\"table\">1</table>", "no table",
        "01-09-2026 09:00:00", "31-02-2026 09:00:00", "01-09-2026 25:00:00", "01-09-2026 09:00:00\n", " 01-09-2026 09:00:00", "01-09-2026 09:00:60",
    ]
    df = spark.createDataFrame([(t,) for t in fragments], "t string")
    c = F.col("t")
    for r in df.select(
        c, pages.inside(c).alias("a"), pages._inside(c).alias("b"), pages.in_tables(c).alias("d"), pages._in_tables(c).alias("e"),
        values.parse_datetime(c).alias("f"), values._any_datetime(c).alias("g"),
    ).collect():
        assert (r["a"], r["d"], r["f"]) == (r["b"], r["e"], r["g"]), r["t"]
