from __future__ import annotations

from bidlens.operators import discovery
from bidlens.plans import run
from bidlens.plans.views import SITE, number
from bidlens.streaming import listings
from test_sources import card, page, row


def notice(n, title):
    return ("q", 0, n, title, f"{title} at Ranchi, Jharkhand", f"{SITE}/showbidDocument/{n}")


def inputs(spark):
    cards = page(spark, card(1, "Blade Server", "Archive, Ranchi, Jharkhand", "12-09-2026") + card(2, "Garden hose", "Park, Ranchi", "12-09-2026")
                 + card(3, "Router", "Archive, Ranchi, Jharkhand", "12-09-2026"))
    hits = spark.createDataFrame([notice(1, "Blade Server"), notice(4, "Photocopier"), notice(5, "Plotter")], "query string, query_pos int, pos int, title string, snippet string, link string")
    details = [(n, "".join([row("Bid Number", number(n)), row("Bid End Date/Time", "11-09-2026 12:00:00")]) + extra) for n, extra in ((1, row("EMD Amount", "900")), (2, ""), (4, ""))]
    pages = spark.createDataFrame([(f"{SITE}/showbidDocument/{n}", f"<table class='table'>{body}</table><a href='/files/{n}.pdf'>Scope of Work</a><a href='/files/{n}.pdf'>again</a>") for n, body in details], "url string, html string")
    files = spark.createDataFrame([(f"{SITE}/files/{n}.pdf", f"The bidder shall upload the PAN Card. Text {n}.") for n in (1, 2, 4)], "url string, text string")
    return cards, hits, pages, files


def test_a_bid_under_two_keys_ends_as_one(spark, rules, now):
    got = run.run_report(*inputs(spark), rules, now)
    found = {r.identity_key: r for r in got.candidates.collect()}
    assert len(found) == 6 and sum(k.startswith("url:") for k in found) == 3
    judged = {r.title: r for r in got.judged.collect()}
    assert set(judged) == {"Blade Server", "Router", "Photocopier", "Plotter"}
    one = judged["Blade Server"]
    assert (one.identity_key, one.first_key, one.discovered_via, one.sightings) == (f"bid:{number(1)}", f"bid:{number(1)}", ["portal", "search"], 2)
    assert [q.query for q in one.matched_queries] == ["", "q"] and one.emd.amount == 900.0 and str(one.bid_end_at) == "2026-09-11 12:00:00"
    assert [d.canonical for d in one.required_documents] == ["pan"]
    other = judged["Photocopier"]  # found without a number, which its page tells
    assert other.identity_key == f"bid:{number(4)}" and other.first_key.startswith("url:") and other.verdict == "accepted"
    assert judged["Plotter"].identity_key.startswith("url:") and judged["Plotter"].rejected_reason == "no_closing_date"
    assert judged["Router"].required_documents == [] and judged["Router"].verdict == "accepted"
    assert {r.title for r in got.screened_out.collect()} == {"Garden hose"}
    assert got.details_read.count() == 2 and got.documents_read.count() == 2
    # Where a bid lies is asked of those in the taxonomy only, and what was found on the way is not kept.
    assert not {"geo", "classification"} & set(got.screened_out.columns)


def test_a_run_without_anything(spark, rules):
    cards, hits, pages, files = (df.limit(0) for df in inputs(spark))
    found = run.find(cards, hits, rules)
    bids, read = run.attach(run.complete(found, pages, rules), pages, files, rules)
    assert found.count() == bids.count() == read.count() == 0


def test_dedupe_puts_many_finders_together(spark):
    rows = spark.range(600).selectExpr("concat('u', id) AS source_url", "concat('q', id % 3) AS query", "id AS pos", "CAST(id % 2 AS STRING) AS side")
    parts = {f"s{i}": rows.filter(f"side = '{i}'") for i in (0, 1)}
    merged = discovery.merge_sources(parts)
    assert merged.count() == 600
    same = merged.withColumnRenamed("identity_key", "first_key").selectExpr("*", "'bid:1' AS identity_key")
    one = discovery.dedupe(same, "first_key").collect()
    assert len(one) == 1 and one[0].source_url == "u0" and one[0].sightings == 600 and one[0].discovered_via == ["s0", "s1"]
    assert sorted({(q.query, q.sightings) for q in one[0].matched_queries}) == [("q0", 100), ("q1", 100), ("q2", 100)]


DAYS = [
    ("2026-09-04 08:00:00", [card(1, "Blade Server", "Archive, Ranchi, Jharkhand", "12-09-2026"), card(2, "Garden hose", "Park, Ranchi", "12-09-2026")]),
    ("2026-09-05 08:00:00", [card(1, "Blade Server", "Archive, Ranchi, Jharkhand", "12-09-2026"), card(3, "Router", "Archive, Ranchi, Jharkhand", "12-09-2026")]),
    ("2026-09-06 08:00:00", [card(1, "Blade Server", "Archive, Ranchi, Jharkhand", "25-12-2026")]),
    ("2026-09-05 20:00:00", [card(3, "Router", "Archive, Ranchi, Jharkhand", "12-09-2026"), card(1, "Old", "Archive, Ranchi", "12-09-2026")]),
]


def saved(spark, *days):
    out = None
    for at, cards in days:
        one = page(spark, "".join(cards)).selectExpr("url", "html", f"CAST('{at}' AS TIMESTAMP) AS seen_at")
        out = one if out is None else out.union(one)
    return out


def test_what_the_stream_lets_through(spark, rules, tmp_path):
    """Four deliveries: new bids, one of them again, one changed, one older than what is known."""
    got = []
    for day in DAYS:
        saved(spark, day).write.mode("append").parquet(f"{tmp_path}/pages")
        pages = spark.readStream.schema(listings.PAGES).parquet(f"{tmp_path}/pages")
        query = listings.versions(listings.seen(pages, rules)).writeStream.foreachBatch(
            lambda df, i: got.append([(r.action, r.title, str(r.first_seen_at)[:10]) for r in df.orderBy("title").collect()])
        ).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
    assert [x for x in got if x] == [[("new", "Blade Server", "2026-09-04"), ("new", "Garden hose", "2026-09-04")], [("new", "Router", "2026-09-05")], [("updated", "Blade Server", "2026-09-04")]]


def test_listing_stream_equals_a_batch_run(spark, rules, now, tmp_path):
    root = str(tmp_path)
    for days in (DAYS[:1], DAYS[1:3]):
        saved(spark, *days).write.mode("append").parquet(f"{root}/pages")
        listings.run_available(spark, f"{root}/pages", root, rules, now)
    out = listings.read_verdicts(spark, root).orderBy("batch").collect()
    by_bid = {}
    for r in out:
        by_bid.setdefault(r.identity_key, []).append((r.action, r.verdict, r.reason))
    assert by_bid[f"bid:{number(1)}"] == [("new", "accepted", None), ("updated", "screened out", "outside_10_day_window")]
    assert by_bid[f"bid:{number(2)}"] == [("new", "screened out", "not_it_related")] and by_bid[f"bid:{number(3)}"] == [("new", "accepted", None)]
    batch = listings.verdicts(listings.latest(listings.seen(saved(spark, *DAYS[:3]), rules)).selectExpr("*", "'' AS action"), rules, now).collect()
    last = {r.identity_key: (r.verdict, r.reason, r.urgency, r.score) for r in out}
    assert last == {r.identity_key: (r.verdict, r.reason, r.urgency, r.score) for r in batch}


def test_a_batch_without_news_plans_no_analysis(spark, rules, now, tmp_path, monkeypatch):
    """A batch that only moves the watermark writes an empty folder of verdicts and analyses nothing."""
    analysed = []
    real = listings.verdicts
    monkeypatch.setattr(listings, "verdicts", lambda rows, *rest: analysed.append(rows.count()) or real(rows, *rest))
    saved(spark, DAYS[0]).write.parquet(f"{tmp_path}/pages")
    listings.run_available(spark, f"{tmp_path}/pages", str(tmp_path), rules, now)
    assert analysed == [2] and listings.read_verdicts(spark, str(tmp_path)).count() == 2


def told(spark, root):
    rows = listings.read_verdicts(spark, root).collect()
    return sorted((r.batch, r.action, r.identity_key[-1], str(r.first_seen_at)[:10]) for r in rows)


def test_what_the_store_lets_through(spark, rules, now, tmp_path, monkeypatch):
    """The deliveries of ``versions``, without state in Python; then one that is late, and one of a bid that was forgotten by then."""
    monkeypatch.setattr(listings, "verdicts", lambda rows, *_: rows.selectExpr("identity_key", "action", "first_seen_at", "seen_at", "'' AS verdict", "'' AS reason", "'' AS urgency", "0D AS score"))
    root = str(tmp_path)

    def deliver(*days):
        saved(spark, *days).write.mode("append").parquet(f"{root}/pages")
        query = listings.run_available(spark, f"{root}/pages", root, rules, now)
        assert not any(p["stateOperators"] for p in query.recentProgress)

    for day in DAYS:
        deliver(day)
    want = [(0, "new", "1", "2026-09-04"), (0, "new", "2", "2026-09-04"), (1, "new", "3", "2026-09-05"), (2, "updated", "1", "2026-09-04")]
    assert told(spark, root) == want and listings.store(spark, root).state().count() == 3
    deliver(("2026-09-04 07:00:00", [card(4, "Late", "Park, Ranchi", "12-09-2026")]))
    deliver(("2027-03-01 08:00:00", [card(5, "Much later", "Park, Ranchi", "12-03-2027")]))
    assert told(spark, root) == [*want, (5, "new", "5", "2027-03-01")]
    deliver(("2027-03-02 08:00:00", [card(1, "Blade Server", "Archive, Ranchi, Jharkhand", "25-12-2026")]))
    assert told(spark, root) == [*want, (5, "new", "5", "2027-03-01"), (6, "new", "1", "2027-03-02")]


def test_a_replayed_batch_of_listings_changes_nothing(spark, rules, now, tmp_path):
    for day in (DAYS[0], DAYS[2]):  # the second time with other pages
        listings.merge_batch(listings.seen(saved(spark, day), rules), 0, str(tmp_path), rules, now)
    assert told(spark, str(tmp_path)) == [(0, "new", "1", "2026-09-04"), (0, "new", "2", "2026-09-04")]
