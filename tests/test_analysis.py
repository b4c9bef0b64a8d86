from __future__ import annotations

from pyspark.sql import functions as F

from bidlens.operators import classify, eligibility, emd, gate, geo, ranking, requirements, scoring, security
from bidlens.plans import daily, report
from bidlens.session import stable
from bidlens.sources import exports


def clauses(df, rules):
    df = emd.cleaned_document(df)
    return requirements.extract_requirements(security.analyze_security(emd.analyze_emd(df)), rules)


def titled(*titles):
    return [{"title": t, "category": "", "buyer_organization": ""} for t in titles]


def test_what_is_in_the_taxonomy(make, rows, rules):
    yes = ["Procurement of Desktop Computer with Monitor", "Supply of Multifunction Printer (MFP)", "Repair and maintenance of computer hardware",
           "Networking and LAN installation work", "Hiring of IT support services", "Supply of laptop, notebook computer and computer table"]
    no = ["AMC of Lift and Elevator", "AMC of Air Conditioner units", "Printing of books and binding work", "Supply of Office Furniture including Computer Table",
          "Hiring of security guard services", "Bedside patient monitor for the recovery ward"]
    got = rows(classify.classify(make(*titled(*yes, *no)), rules))
    assert [r.classification.is_it_related for r in got] == [True] * len(yes) + [False] * len(no)
    assert all(r.classification.reason for r in got)
    assert got[len(yes)].classification.confidence == "confirmed"


def test_kind(make, rows, rules):
    got = rows(classify.classify(make(*titled(
        "Supply of Laptop", "Annual Maintenance Contract of Computers, laptop", "Supply, Installation and Commissioning of CCTV", "Laptop", "AMC laptop"
    )), rules))
    assert [r.classification.kind for r in got] == ["product_supply", "service", "supply_and_service", "product_supply", "service"]


def test_text_only_hit_is_inferred(make, rows, rules):
    df = make({"title": "Supply of equipment", "category": "", "doc_text": "The lot has 40 desktop units."})
    r = rows(classify.classify(df, rules, F.col("doc_text")))[0].classification
    assert r.is_it_related and r.confidence == "inferred" and "tender documents" in r.reason


def test_region(make, rows, rules):
    nowhere = {"delivery_location": "", "buyer_address": "", "buyer_organization": "Central Cell", "title": "Laptops"}
    cases = [
        ({"delivery_location": "Stores Block, Bank More, Dhanbad", "buyer_address": "New Delhi", "buyer_organization": "Ministry"}, True, "confirmed"),
        ({**nowhere, "delivery_location": "Kochi, Kerala"}, False, "confirmed"),
        ({**nowhere, "delivery_location": "Multiple states across India"}, True, "unclear"),
        ({**nowhere, "delivery_location": "Mango Traders Arcade"}, False, "confirmed"),
        ({**nowhere, "delivery_location": "Mango, East Singhbhum"}, True, "confirmed"),
        ({**nowhere, "delivery_location": "JH"}, False, "confirmed"),
        ({**nowhere, "buyer_organization": "Bharat Coking Coal Limited"}, True, "unclear"),
        ({**nowhere, "doc_text": "Delivery at Hazaribagh."}, True, "inferred"),
    ]
    got = rows(geo.assess(make(*[c for c, _, _ in cases]), rules, F.col("doc_text")))
    assert [(r.geo.in_region, r.geo.confidence) for r in got] == [(a, b) for _, a, b in cases]
    assert got[1].geo.reason.endswith("kerala") and got[4].geo.matched_terms == ["East Singhbhum", "Mango"]


def test_emd(make, rows, rules):
    texts = [
        "The bidder shall deposit EMD of Rs. 75,000 by demand draft.", "EMD: NIL. No earnest money is required.", "Bidders must submit a datasheet.",
        "EMD shall be as per the terms.", "Pay Rs. 20,000 as EMD.", "EMD of Rs. 20,000 shall be paid online through NEFT on or before 12-09-2026.", "",
    ]
    got = rows(clauses(make(*[{"doc_text": t} for t in texts]), rules))
    assert [r.emd.status for r in got] == ["required", "not_required", "not_stated", "not_stated", "required", "required", "not_stated"]
    assert [r.emd.amount for r in got] == [75000.0, None, None, None, 20000.0, 20000.0, None]
    assert got[0].emd.amount_evidence[0].quote and got[0].emd.payment_mode == "demand draft"
    assert got[5].emd.last_date == "12-09-2026" and got[5].emd.payment_mode == "online"
    assert emd.FLAG_UNREAD in got[3].flags and emd.FLAG_NO_TEXT in got[6].flags


def test_portal_figure_wins_and_conflict_is_flagged(make, rows, rules):
    r = rows(clauses(make({"portal_emd_amount": 75000.0, "doc_text": "EMD of Rs. 50,000 shall be paid."}), rules))[0]
    assert r.emd.amount == 75000.0 and any("differs" in f for f in r.flags)


def test_exemptions(make, rows, rules):
    said = "EMD of Rs. 1,00,000 is payable. MSME bidders are exempted on a valid Udyam Registration Certificate. DPIIT startups are also exempted."
    e = rows(clauses(make({"doc_text": said}), rules))[0].emd
    assert (e.msme_exemption, e.startup_exemption, e.exemption_available) == ("required",) * 3
    assert "Udyam Registration Certificate" in e.exemption_proof_required


def test_security(make, rows, rules):
    texts = [
        "The bidder shall submit ePBG of 3% of the contract value, valid for 60 days beyond completion.", "Delivery within 30 days.",
        "Performance Security: Not applicable.", "ePBG of 3.0% applies.", "ePBG: 0% for this bid.", "A security deposit within 15 days of Rs. 2,000 is due.",
    ]
    got = rows(clauses(make(*[{"doc_text": t} for t in texts], {"portal_epbg_pct": 0.0}), rules).withColumn("line", security.security_line()).withColumn("head", security.headline()))
    assert [r.head for r in got] == ["Required", "⚠ Verification Required", "Not Required", "Required", "Not Required", "Required", "Not Required"]
    assert "3%" in got[0].line and got[0].security.validity == "60 days beyond completion"
    assert got[5].security.amount == 2000.0 and got[6].line.startswith("ePBG: Not Required") and "confirm" in got[6].line


def test_required_documents(make, rows, rules):
    texts = [
        "The bidder shall upload the PAN Card, GST Certificate and Udyam Registration. An OEM Authorization Letter must be submitted.",
        "Payments are released against a valid GST invoice of the vendor.", "Bidders shall submit an ISO Certificate, if applicable.",
        "Bidders shall submit an ISO Certificate, if applicable. The ISO 9001 certificate must be uploaded now.", "",
    ]
    got = rows(clauses(make(*[{"doc_text": t} for t in texts]), rules))
    keys = [{d.canonical for d in r.required_documents} for r in got]
    assert {"pan", "gst", "msme", "oem_authorization"} <= keys[0] and keys[1] == set() and keys[4] == set()
    assert got[2].required_documents[0].confidence == "unclear"
    iso = got[3].required_documents[0]
    assert iso.confidence == "confirmed" and len(iso.evidence) == 2 and "9001" in iso.evidence[0].quote
    assert requirements.FLAG_NO_DOCUMENTS in got[1].flags and requirements.FLAG_NO_TEXT in got[4].flags


def test_cue_lines_are_all_kept_distinct_and_in_order(make, rows, rules):
    many = " ".join(f"Penalty number {i} applies to this lot." for i in range(20)) + " Penalty number 0 applies to this lot."
    r = rows(clauses(make({"doc_text": many}), rules))[0].requirements
    assert r.special == [f"Penalty number {i} applies to this lot." for i in range(20)]


def test_score_bounds_and_reasons(make, rows, rules, now):
    df = make({}, {"estimated_value": 3_150_000.0}, {"delivery_location": "Kochi, Kerala", "buyer_address": "Kochi", "buyer_organization": "Government of Kerala"}, {"bid_end_at": "2026-09-07 15:00:00"})
    got = rows(daily.analyse(df, rules, now))
    for r in got:
        assert 0 <= r.score.total <= 100 and len(r.score.components) == 7
        assert all(c.reason and 0 <= c.points <= c.max_points for c in r.score.components)
    assert got[1].score.components[5].points == 15.0 and 0 < got[0].score.components[5].points < 15.0
    assert got[2].score.total < got[0].score.total and got[3].score.components[4].points < got[0].score.components[4].points


def test_half_even_and_band_gap(spark, rules):
    df = spark.createDataFrame([(79.5,), (80.0,), (79.0,), (39.0,)], "t double")
    assert [r.b for r in df.select(scoring.band(F.col("t"), rules, "label").alias("b")).collect()] == ["", "STRONG OPPORTUNITY", "GOOD OPPORTUNITY", "LOW PRIORITY"]
    assert spark.range(1).select(F.bround(F.lit(11.25), 1).alias("x")).first().x == 11.2


def test_unknown_profile_promises_nothing(make, rows, rules, now):
    r = rows(daily.analyse(make({}), rules.with_profile(), now))[0].eligibility
    assert (r.match_level, r.verdict) == ("UNKNOWN", eligibility.VERIFY) and "unverified" in r.verification_points[0]


def test_gaps(make, rows, rules, now):
    said = "The bidder should have a minimum average annual turnover of 5 Crore. An OEM Authorization Letter must be submitted."
    small = rules.with_profile(strong=["Computer Hardware"], annual_turnover_inr=2_000_000)
    r = rows(daily.analyse(make({"doc_text": said}), small, now))[0].eligibility
    assert any("Turnover requirement" in g for g in r.gaps) and any("OEM" in g for g in r.gaps) and r.verdict == eligibility.GAP


def test_gate_reasons(make, rows, rules, now):
    kerala = {"delivery_location": "Kochi, Kerala", "buyer_address": "Kochi", "buyer_organization": "Government of Kerala"}
    cases = [
        ({}, None), ({"source_url": "https://bidplus.gem.gov.in.evil.com/1"}, "not_official_gem_source"), ({"source_url": ""}, "not_official_gem_source"),
        ({"portal_status": "Bid Cancelled"}, "not_active"), ({"title": "Office chairs", "category": "Furniture"}, "not_it_related"), (kerala, "not_jharkhand"),
        ({"bid_end_at": None}, "no_closing_date"), ({"bid_end_at": "2026-09-04 10:00:00"}, "expired"), ({"bid_end_at": "2026-12-20 10:00:00"}, "outside_10_day_window"),
    ]
    df = daily.judge(daily.analyse(make(*[c for c, _ in cases]), rules, now), rules)
    got = rows(df)
    assert [r.rejected_reason for r in got] == [reason for _, reason in cases]
    watch = rows(daily.judge(daily.analyse(make({"bid_end_at": "2026-10-01 10:00:00", "estimated_value": 500000.0}), rules, now), rules))[0]
    assert (watch.verdict, watch.urgency, watch.rejected_reason) == ("watchlist", "WATCHLIST", None)


def test_screen_lets_unknown_deadline_pass(make, rows, rules, now):
    got = rows(daily.screen(make({"bid_end_at": None}, {"bid_end_at": "2026-12-20 10:00:00"}), rules, now))
    assert [r.screen_reason for r in got] == [None, "outside_10_day_window"] and gate.FLAG_NO_DEADLINE in got[0].flags


def test_ranking_breaks_ties_and_numbers_without_gaps(spark):
    n = 1000
    df = spark.range(n).select(
        F.concat(F.lit("bid:"), F.lpad("id", 5, "0")).alias("identity_key"), F.lit("same title").alias("title"),
        F.struct(F.when(F.col("id") < 700, 88.0).otherwise(F.col("id") % 50).cast("double").alias("total")).alias("score"),
        F.when(F.col("id") % 2 == 0, "URGENT").otherwise("ACTION REQUIRED").alias("urgency"), (F.col("id") % 7).cast("int").alias("days_remaining"),
    )
    got = ranking.number_rows(df, ranking.report_order()).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, n + 1))
    key = lambda r: (-r.score.total, r.urgency != "URGENT", r.days_remaining, r.identity_key)
    assert [r.identity_key for r in got] == [r.identity_key for r in sorted(got, key=key)]


def test_texts_are_read_to_the_end(make, rows, rules):
    """A marker, a demand and a place far into a text count like any other."""
    marker = rules.decision["cancelled_markers"][0]
    got = rows(make({"listing_text": "x " * 400 + marker}, {"listing_text": "x " * 400}).withColumn("ok", gate.is_active(rules)))
    assert [r.ok for r in got] == [False, True]
    long = "The bidder shall upload " + "one more thing that is described at length, " * 30 + "and a copy of the PAN Card."
    got = rows(clauses(make({"doc_text": long}), rules))
    assert len(got[0].required_documents) == 1 and got[0].required_documents[0].evidence[0].quote == long


def test_issues_are_rows_and_the_manifest_counts_them(spark):
    judged = spark.createDataFrame([("accepted", None)], "verdict string, rejected_reason string")
    screened = spark.createDataFrame([("closed",)], "screen_reason string")
    stored, modes = spark.createDataFrame([("new",)], "action string"), spark.createDataFrame([("m",)], "mode string")
    rows = [(f"2026-09-06 08:{i % 60:02d}:00", "listing" if i % 4 == 0 else "detail", f"t{i}", "HTTP_500") for i in range(200)]
    issues = spark.createDataFrame(rows + rows[:1], "occurred_at string, stage string, target string, error_type string").withColumn("occurred_at", F.col("occurred_at").cast("timestamp"))

    def row(some):
        return report.manifest(judged, screened, stored, some, modes, spark.range(1), spark.range(2), spark.range(0), "r", "a", "b")

    assert [tuple(x) for x in row(issues).first()["issues"]] == [("detail", "HTTP_500", 150), ("listing", "HTTP_500", 51)]
    assert row(issues.limit(0)).first()["issues"] == []
    out = report.access_issues(issues, "r").collect()
    assert len(out) == 201 and {r["run_id"] for r in out} == {"r"} and [r["line"] for r in out] == sorted(r["line"] for r in out)
    tab = exports.run_rows(row(issues)).first()
    assert tab["Access Issues"] == "HTTP_500 at detail (150) | HTTP_500 at listing (51)"
    assert (tab["Queries"], tab["Details Fetched"], tab["Documents"]) == (1, 2, 0)
    assert exports.run_rows(row(issues.limit(0))).first()["Access Issues"] == ""


def test_places_and_markers_in_one_pass(spark, rules):
    """A text without any place is told by one pass; one with some gives its hits as before. Markers are plain text."""
    said = ["", "Garden tools", "Adityapur Phase 2, Saraikela", "Mango orchard", "Mango, Ranchi, JHARKHAND", "jh", "Ranchipur"]
    df = spark.createDataFrame(list(enumerate(said)), "i int, t string")
    fields = F.array(F.struct(F.lit("title").alias("name"), F.col("t").alias("text")))
    got = df.select("i", F.transform(geo.match_fields(fields, rules), lambda m: m["hits"]).alias("h")).orderBy("i").collect()
    assert [r.h for r in got] == [[], [], [["Adityapur", "Saraikela"]], [], [["JHARKHAND", "Ranchi", "Mango"]], [], []]
    told = spark.createDataFrame([("pan-india (all)",), ("pan india",), ("goa",)], "t string")
    tests = [geo.contains_any(F.col("t"), m).alias(n) for n, m in (("a", ["a-i", "(all)"]), ("b", ["n.i"]), ("c", []))]
    assert [tuple(r) for r in told.select(*tests).collect()] == [("a-i" in t or "(all)" in t, False, False) for t in ("pan-india (all)", "pan india", "goa")]


def test_a_later_day_reads_new_texts_only(make, rules, now):
    """Same result as a whole run; what the earlier day read of an unchanged text is taken from it."""
    later = "2026-09-07 08:30:00"
    paid = {"doc_text": "The bidder shall deposit EMD of Rs. 20,000."}
    day_1 = make(paid, paid, {"doc_text": "EMD: NIL."}, {"bid_end_at": "2026-12-20 10:00:00"}, {"bid_end_at": None}, {"title": "Supply of garden tools", "category": ""})
    day_2 = make(
        {**paid, "bid_end_at": "2026-09-14 15:00:00", "estimated_value": 90000.0}, paid, {"doc_text": "EMD of Rs. 30,000 is payable."}, {"bid_end_at": "2026-09-12 10:00:00"},
        {"bid_end_at": "2026-09-12 10:00:00"}, {"title": "Supply of garden tools", "category": ""},
    )

    def whole(df):
        return sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())

    listed = daily.shortlist(day_1, rules, now).withColumn("text_print", daily.text_print())
    known = daily.judge(daily.analyse(listed, rules, now), rules).drop("doc_text")
    assert whole(known.drop("text_print")) == whole(daily.run(day_1, rules, now)[0].drop("doc_text"))
    assert whole(daily.run_again(day_2, known, rules, later)) == whole(daily.run(day_2, rules, later)[0].drop("doc_text"))
    marked = known.withColumn("plain_summary", F.lit("read before"))
    got = daily.run_again(day_2, marked, rules, later).select("id", "plain_summary").collect()
    assert sorted(r.id for r in got) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in got if r.plain_summary == "read before") == [0, 1]


def test_staged_screen_gives_the_reasons_and_the_shortlist_of_the_whole_one(make, rules, now):
    bids = make(
        {}, {"bid_end_at": None}, {"bid_end_at": "2026-12-20 10:00:00"}, {"bid_end_at": "2026-09-01 10:00:00"},
        {"title": "Supply of garden tools", "category": ""},
        {"title": "Supply of garden tools", "category": "", "buyer_organization": "", "buyer_address": "", "delivery_location": "Nashik"},
        {"buyer_organization": "", "buyer_address": "", "delivery_location": "Nashik, Maharashtra"},
        {"buyer_organization": "Heavy Engineering Corporation", "buyer_address": "", "delivery_location": ""},
        {"buyer_organization": "", "buyer_address": "", "delivery_location": "Various locations across the country"},
    )
    whole = {r["id"]: r["screen_reason"] for r in daily.screen(bids, rules, now).select("id", "screen_reason").collect()}
    staged = {r["id"]: r["screen_reason"] for r in daily.screen_reasons(bids, rules, now).select("id", "screen_reason").collect()}
    assert staged == whole and set(whole.values()) > {None, "not_it_related", "not_jharkhand"}
    assert {r["id"] for r in daily.shortlist(bids, rules, now).select("id").collect()} == {i for i, w in whole.items() if w is None}


def test_recurring_texts_are_read_once(make, rules, now, monkeypatch):
    """The analysis is that of every bid by itself; each different input of the clause rules is read once."""
    said = ["The bidder shall deposit EMD of Rs. 20,000. Bidders shall submit the PAN Card.", "ePBG of 3% is valid for 60 days.", "Garden"]
    bids = stable(make(*[
        {"doc_text": said[i % 3], "source_url": f"https://bidplus.gem.gov.in/showbidDocument/{i}" if i % 5 else None,
         "portal_emd_amount": [None, 0.0, -0.0][i // 3 % 3], "bid_end_at": "2026-09-10 15:00:00" if i % 6 else None}
        for i in range(72)
    ]))
    read = []
    real = daily.cleaned_document
    monkeypatch.setattr(daily, "cleaned_document", lambda df: read.append(df.count()) or real(df))
    whole = daily.analyse(bids, rules, now)
    once = daily.analyse(bids, rules, now, once=True)
    assert read == [72, 12] and once.columns == whole.columns and once.schema.simpleString() == whole.schema.simpleString()
    assert {r.id: str(r) for r in once.collect()} == {r.id: str(r) for r in whole.collect()}
    daily.analyse(stable(bids.limit(3)), rules, now, once=True)
    assert read[2] == 3  # nothing recurs: bid by bid


def test_texts_are_not_read_for_bids_that_the_listing_rejects(make, rules, now):
    bids = make({}, {"source_url": "https://tenders.example.com/1"}, {"portal_status": "Bid Cancelled"}, {"bid_end_at": None}, {"title": "Supply of garden tools", "category": ""},
                {"bid_end_at": "2026-12-20 10:00:00"})
    listed = daily.screen_once(bids, rules, now)
    out = listed.filter("screen_reason IS NOT NULL")
    assert sorted((r.screen_reason, r.title, r.text_print is None) for r in out.collect()) == [("not_it_related", None, False), ("outside_10_day_window", None, True)]
    got = daily.judge_listed(listed.filter("screen_reason IS NULL").drop("screen_reason"), rules, now)
    want = daily.judge(daily.analyse(daily.shortlist(bids, rules, now), rules, now), rules)

    def told(df):
        return sorted((r.id, r.verdict, r.rejected_reason, r.urgency) for r in df.collect())

    assert told(got) == told(want) and {r.id for r in got.filter("emd IS NULL").collect()} == {1, 2}
    # The day after: texts that the screen ruled out are not read again, and the verdicts are those of a whole run.
    later = "2026-09-07 08:30:00"
    again = daily.run_again(bids, got, rules, later, out)
    assert told(again) == told(daily.judge(daily.analyse(daily.shortlist(bids, rules, later), rules, later), rules))
