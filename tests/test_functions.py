from __future__ import annotations

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bidlens.functions import identity, lists, terms, text, values
from bidlens.functions.terms import TermTable
from bidlens.operators import geo


def apply(spark, fn, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


def test_clean(spark):
    got = apply(spark, text.clean, ["Ranchi,   Jhar​khand \n", "ﬁne Ａ x", None, "a\x1cb  c", "café", "plain text"])
    assert got == ["Ranchi, Jharkhand", "fine A x", "", "a b c", "café", "plain text"]


def test_normalize_key_and_labels(spark):
    assert apply(spark, text.normalize_key, ["Bid End Date/Time", "ePBG Percentage(%)", "  "]) == ["bid end date time", "epbg percentage", ""]
    assert apply(spark, lambda c: text.strip_label(c, "Quantity"), ["Quantity: 45 Nos", "Quantity - 45", "Total quantity: 1"]) == ["45 Nos", "45", "Total quantity: 1"]
    assert apply(spark, lambda c: text.truncate(c, 5), ["abcdefghij", "abc"]) == ["abcd…", "abc"]


def test_snippet(spark):
    long = "x" * 200 + " here " + "y" * 200
    got = apply(spark, lambda c: text.snippet(c, F.lit(202)), [long, "short"])
    assert got[0].startswith("…") and got[0].endswith("…") and "here" in got[0] and len(got[0]) <= 242
    assert apply(spark, lambda c: text.snippet(c, F.lit(0)), ["short"]) == ["short"]


DATES = {
    "15-09-2026 15:00:00": (2026, 9, 15, 15, 0), "15/09/2026 15:00": (2026, 9, 15, 15, 0), "15-Sep-2026": (2026, 9, 15, 0, 0),
    "06 September 2026": (2026, 9, 6, 0, 0), "2026-09-15T15:00:00": (2026, 9, 15, 15, 0), "closes on 15-09-2026 15:00 IST": (2026, 9, 15, 15, 0),
    "15-09-2026 03:00 pm": (2026, 9, 15, 15, 0), "15-09-2026 12:05 AM": (2026, 9, 15, 0, 5), "1 May 2026 10:00": (2026, 5, 1, 10, 0),
    "": None, "TBD": None, "31-02-2026": None, "15-September-2026": None, "15/Sep/2026": None, "15-09-2026 13:00 pm": (2026, 9, 15, 13, 0),
}


def test_dates(spark):
    got = apply(spark, values.parse_datetime, list(DATES))
    assert got == [datetime(*v) if v else None for v in DATES.values()]


AMOUNTS = {
    "Rs. 1,20,000": 120000.0, "₹75,000": 75000.0, "INR 2,50,000.50": 250000.5, "2.5 Crore": 2.5e7, "10 Lakh": 1e6, "0": 0.0, "NIL": 0.0,
    "to be intimated later": None, "": None, "not applicable": None, "75000": 75000.0, "12000 lakh": 1.2e9, "१२": 12.0,
}


def test_amounts(spark):
    assert apply(spark, values.parse_amount, list(AMOUNTS)) == list(AMOUNTS.values())


def test_percentages_and_quantities(spark):
    assert apply(spark, values.parse_percentage, ["3% of value", "5 percent", "3.00", None]) == [3.0, 5.0, None, None]
    got = apply(spark, values.parse_quantity, ["45 Nos", "1,200 Units", "", "12"])
    assert [tuple(g) for g in got] == [(45.0, "Nos"), (1200.0, "Units"), (None, ""), (12.0, "")]


def test_short_number_is_like_printf(spark):
    xs = [3.0, 2.5, 0.5, 12.345678, 1e6, 1234567.0, 1e-5, 0.0, 123456.0, 99.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r.y for r in df.select(values.short_number("x").alias("y")).collect()] == ["%g" % x for x in xs]


def test_days_and_urgency(spark, rules):
    at = ["2026-09-06 07:00:00", "2026-09-06 15:00:00", "2026-09-05 23:00:00", "2026-09-16 00:00:00", None]
    days = apply(spark, lambda c: values.days_remaining(F.col(c).cast("timestamp_ntz"), "2026-09-06 08:30:00"), at)
    assert days == [-1, 0, -1, 10, None]
    df = spark.createDataFrame([(d,) for d in (None, -1, 0, 2, 3, 5, 6, 10, 11)], "d int")
    words = [r.u for r in df.select(values.urgency("d", rules.deadline["bands"]).alias("u")).collect()]
    assert words == ["UNKNOWN", "EXPIRED", "URGENT", "URGENT", "HIGH PRIORITY", "HIGH PRIORITY", "ACTION REQUIRED", "ACTION REQUIRED", "WATCHLIST"]


HOSTS = {
    "https://bidplus.gem.gov.in/x": True, "https://gem.gov.in/x": True, "https://a.b.gem.gov.in:8443/x": True, "HTTPS://MKP.GEM.GOV.IN": True,
    "https://tenders.example.com/": False, "https://bidplus.gem.gov.in.evil.com/": False, "https://gem.gov.in@evil.com/": False,
    "https://notgem.gov.in/": False, "gem.gov.in/x": False, "": False,
}


def test_hosts(spark, rules):
    assert apply(spark, lambda c: identity.is_allowed_host(c, rules.portal["allowed_hosts"]), list(HOSTS)) == list(HOSTS.values())


def test_distinct_keeps_first_spelling(spark):
    row = spark.range(1).select(lists.distinct_ci(lists.strings(["A", "a ", " ", "b", "B"])).alias("y")).first()
    assert row.y == ["A", "b"]


def test_term_table_equals_one_regex_per_term(spark, rules):
    """The one-pass matcher against brute force, on texts built to overlap."""
    terms = [t for g in rules.groups for t in g["signals"] + g["negatives"]] + rules.taxonomy["hard_vetoes"]
    terms = list(dict.fromkeys(terms))
    rng = random.Random(7)
    words = sorted({w for t in terms for w in re.split(r"[ -]", t)}) + ["xlan", "ups2", "-", "é", "o&m", "s"]
    texts = [" ".join(rng.choice(words + terms) for _ in range(12)) for _ in range(400)]
    texts += [re.sub("-", rng.choice(["", " ", "-", "--"]), t) for t in terms]
    pattern = {t: re.compile(r"(?<![a-z0-9])" + re.escape(t).replace(r"\-", r"[\s\-]?").replace(r"\ ", r"\s+") + r"(?![a-z0-9])") for t in terms}
    want = [[i for i, t in enumerate(terms) if pattern[t].search(x)] for x in texts]
    assert apply(spark, TermTable(tuple(terms)).numbers, texts) == want


@pytest.mark.parametrize("term,said,hit", [("amc", "dynamics", False), ("wi-fi", "wifi zone", True), ("wifi", "wi-fi zone", False), ("lan", "lan.", True)])
def test_term_boundaries(spark, term, said, hit):
    assert apply(spark, TermTable((term,)).occurs, [said]) == [hit]


def test_clean_works_in_grouping_keys(spark):
    df = spark.createDataFrame([("A  b",), ("a b",), ("Ａ b",)], "x string")
    assert [(r.k, r["count"]) for r in df.groupBy(text.normalize_key("x").alias("k")).count().collect()] == [("a b", 3)]


def test_clean_is_the_same_for_plain_and_other_text(spark):
    """Text of one-byte characters takes the short way; a single other character the long one."""
    said = [(None, ""), ("", ""), ("a", "a"), (" a  b\tc\n", "a b c"), ("a\x1cb\x7f", "a b\x7f"), ("① a ​ b", "1 a b"), ("ﬁn  é", "fin é"), ("Café", "Café")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(said)], "i int, a string, b string")
    got = df.select("i", text.clean("a").alias("c"), "b").orderBy("i").collect()
    assert [r.c for r in got] == [r.b for r in got]
    assert sum(r["count"] for r in df.groupBy(text.clean("a").alias("c")).count().collect()) == len(said)


def test_alternation_is_longest_first_and_tries_few_branches():
    """What literals begin with is written once, and no choice has more than a few branches at its start."""
    words = ["ab", "abc", "abd", "b", "c c", "c.c", "d", "e", "f", "g", "ab-c", "gh"]
    tree = terms.alternation(words)
    assert "(?=[" in tree and "(?:ab(?:" in tree
    for text in [*words, *(w + x for w in words for x in "abc-. ")]:
        want = max((w for w in words if text.startswith(w)), key=len)
        assert re.match(tree, text).group() == want
    assert terms.alternation([]) == "" and terms.alternation(["a"]) == "a"


def test_places_whose_ends_are_no_letters(spark):
    """One may stand right behind the other."""
    df = spark.createDataFrame([("(A)(b) x(a)",)], "t string")
    for places, want in ((["(a)", "(b)"], ["(A)", "(b)"]), (["a", "b"], ["A", "b", "a"])):
        got = df.select(F.regexp_extract_all(terms.spaced("t"), F.lit(geo.place_pattern(places)), F.lit(1))).first()[0]
        assert got == want
