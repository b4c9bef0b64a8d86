"""Bids, pages and payloads derived from the test tables.

One SQL text per view serves Spark and the checking engine alike; only the few
functions whose names differ are filled in per dialect. Keys modulo small
numbers reach every branch of the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.rules import load_rules
from bidlens.session import spread

#: The portal that the sample pages come from, and its numbers.
SITE = load_rules().portal["base_url"]


def number(n: int | str) -> str:
    return f"GEM/2026/B/{n}"


NOW = "2026-09-06 08:30:00"
TODAY = "2026-09-06"

SPARK = {
    "END": "timestampadd(DAY, CAST(o.o_orderkey % 75 AS INT) - 5, TIMESTAMP_NTZ'2026-09-06 15:00:00')",
    "PLUS4": "timestampadd(DAY, 4, bid_end_at)",
    "TS": "date_format({0}, 'dd-MM-yyyy HH:mm:ss')",
}
DUCK = {
    "END": "TIMESTAMP '2026-09-06 15:00:00' + to_days(CAST(o.o_orderkey % 75 AS INT) - 5)",
    "PLUS4": "bid_end_at + to_days(4)",
    "TS": "strftime({0}, '%d-%m-%Y %H:%M:%S')",
}

BIDS = """
SELECT
  o.o_orderkey AS k,
  CASE WHEN o.o_orderkey % 50 = 49 THEN '' ELSE 'GEM/2026/B/' || CAST(7000000 + o.o_orderkey AS STRING) END AS bid_number,
  CASE WHEN o.o_orderkey % 20 = 19 THEN 'https://tenders.example.com/bid/' ELSE 'https://bidplus.gem.gov.in/showbidDocument/' END
    || CAST(7000000 + o.o_orderkey AS STRING) AS source_url,
  CASE o.o_orderkey % 11
    WHEN 0 THEN 'Purchase of Document Scanner with feeder for the land registry'
    WHEN 1 THEN 'Servicing of Firewall and Managed Switch under comprehensive AMC'
    WHEN 2 THEN 'Supply, Installation and Commissioning of Dome Camera and Video Wall'
    WHEN 3 THEN 'Procurement of Tape Library with VRLA Battery'
    WHEN 4 THEN 'Supply of Canteen Furniture including Computer Chair'
    WHEN 5 THEN 'AMC of Fire and smoke alarms'
    WHEN 6 THEN 'Supply of 12 Desktops and desktop with Computer Paper'
    WHEN 7 THEN 'Vital signs monitor for the blood bank'
    WHEN 8 THEN 'Wi Fi router and All-in-One PC'
    WHEN 9 THEN 'Hiring of nursing and Ultrasound services'
    ELSE 'Supply of garden tools' END AS title,
  CASE o.o_custkey % 7
    WHEN 0 THEN 'Canal Road, Giridih, Jharkhand'
    WHEN 1 THEN 'Seed Farm, Dumka, Jharkhand'
    WHEN 2 THEN 'Adityapur Phase 2, Saraikela'
    WHEN 3 THEN 'Nashik, Maharashtra'
    WHEN 4 THEN 'Various locations across the country'
    WHEN 5 THEN 'Mango orchard depot'
    ELSE '' END AS delivery_location,
  CASE WHEN o.o_custkey % 13 = 6 THEN 'Heavy Engineering Corporation' ELSE c.c_name END AS buyer_organization,
  CASE WHEN o.o_custkey % 5 = 0 THEN 'Ministry of Textiles' ELSE '' END AS ministry,
  CASE o.o_orderstatus WHEN 'P' THEN 'Bid Cancelled' ELSE '' END AS portal_status,
  CAST(1 + o.o_orderkey % 60 AS DOUBLE) AS quantity,
  CASE WHEN o.o_orderkey % 4 = 1 THEN '' ELSE 'Nos' END AS quantity_unit,
  CASE WHEN o.o_orderkey % 3 = 0 THEN o.o_totalprice ELSE NULL END AS estimated_value,
  CASE WHEN o.o_orderkey % 61 = 60 THEN NULL ELSE {END} END AS bid_end_at,
  CASE o.o_orderkey % 10 WHEN 3 THEN 75000.0 WHEN 7 THEN 0.0 ELSE NULL END AS portal_emd_amount,
  CASE o.o_orderkey % 12 WHEN 5 THEN 3.0 WHEN 9 THEN 0.0 ELSE NULL END AS portal_epbg_pct,
  CASE WHEN o.o_orderkey % 9 = 4 THEN 'Yes' ELSE '' END AS ra_enabled,
  CASE o.o_orderkey % 16
    WHEN 0 THEN 'The bidder shall deposit EMD of Rs. ' || CAST(10 + o.o_orderkey % 90 AS STRING) || ',000 through online payment on or before 12-09-2026.'
    WHEN 1 THEN 'EMD: NIL. No earnest money is required.'
    WHEN 2 THEN 'EMD shall be as per the terms of the bid.'
    WHEN 3 THEN 'The successful bidder shall submit ePBG of 3% of the contract value, valid for 60 days beyond the contract completion date.'
    WHEN 4 THEN 'Performance Security: Not applicable for this bid.'
    WHEN 5 THEN 'The bidder shall upload copies of the GST Registration Certificate and the PAN Card. An OEM Authorization Letter must be submitted with the bid.'
    WHEN 6 THEN 'Bidders shall submit an ISO Certificate, if applicable. The equipment comprises 40 desktop computer units.'
    WHEN 7 THEN 'EMD of Rs. 1,00,000 is payable. MSME registered bidders are exempted from EMD on submission of a valid Udyam Registration Certificate. DPIIT recognised startups are also exempted.'
    WHEN 8 THEN 'The bidder should have 5 years of past experience in similar work. Minimum average annual turnover of 50 lakh is required. Bidders shall submit copy of work order and completion certificate.'
    WHEN 9 THEN 'Technical specification covers the processor and 16 GB ram. The equipment carries 3 years onsite warranty. Payment shall be made within 30 days. Liquidated damages apply to late delivery. Reverse auction will be conducted.'
    WHEN 10 THEN 'Security deposit of Rs. 2,50,000 shall be furnished. Performance Security of 5 percent is due within 30 days of award.'
    WHEN 11 THEN 'Delivery shall be made at Hazaribagh. Delivery period is 45 days. Post warranty support is part of the annual maintenance scope.'
    WHEN 12 THEN 'Bidders shall submit an ISO Certificate, if applicable. The ISO 9001 certificate must be uploaded with the technical bid.'
    WHEN 13 THEN 'Bid security of Rs. 0 applies. Performance security is exempted for registered units.'
    WHEN 14 THEN 'Interested parties pay Rs. 40,000 as EMD. Bidders must have local content and submit a make in india declaration.'
    ELSE '' END AS doc_text
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

# The same bids one day later: some gone, some moved, some re-priced.
NEXT_DAY = """
SELECT {COLUMNS},
  CASE WHEN k % 4 = 0 THEN {PLUS4} ELSE bid_end_at END AS bid_end_at,
  CASE WHEN k % 6 = 0 THEN estimated_value * 1.1 ELSE estimated_value END AS estimated_value
FROM ({BIDS}) WHERE k % 10 <> 9
"""

# Saved search-result pages: eight bids to a page.
CARD = """
'<div class="card"><div class="col-block"><a class="bid_no_hover" href="/showbidDocument/' || CAST(7000000 + k AS STRING) || '">' ||
  CASE WHEN k % 23 = 22 THEN '' WHEN k % 17 = 16 THEN 'View bid' ELSE 'GEM/2026/B/' || CAST(7000000 + k AS STRING) END || '</a></div>' ||
  CASE WHEN k % 17 = 16 THEN '<div class="col-block">Ref: gem/2026/b/' || CAST(7000000 + k AS STRING) || '</div>' ELSE '' END ||
  '<div class="col-block">Items: ' || title || '</div><div class="col-block">Quantity: ' || CAST(1 + k % 60 AS STRING) || ' Nos</div>' ||
  '<div class="col-block">Category: Lot ' || CAST(k % 5 AS STRING) || '</div>' ||
  '<div class="col-block">Department Name And Address: ' || buyer_organization || ', ' || delivery_location || '</div>' ||
  '<div class="col-block">Start Date: <span class="start_date">01-09-2026 09:00:00</span></div>' ||
  '<div class="col-block">End Date: <span class="end_date">' || coalesce({TS_END}, 'as per schedule') || '</span></div></div>'
"""

# Saved detail pages: one two-column table and the attachment links.
DETAIL = """
'<html><body><table class="table"><tr><td>Bid Number</td><td>' || bid_number || '</td></tr>' ||
  '<tr><td>Bid End Date/Time</td><td>' || coalesce({TS_END}, 'TBD') || '</td></tr>' ||
  '<tr><td>Ministry/State Name</td><td>' || ministry || '</td></tr><tr><td>Organisation Name</td><td>' || buyer_organization || '</td></tr>' ||
  '<tr><td>Department Name And Address</td><td>' || CASE WHEN k % 3 = 0 THEN 'Office ' || CAST(k % 7 AS STRING) ELSE '' END || '</td></tr>' ||
  '<tr><td>Internal Note</td><td>not mapped</td></tr><tr><td>Total Quantity</td><td>' || CAST(2 + k % 60 AS STRING) || CASE WHEN k % 2 = 0 THEN ' Sets' ELSE '' END || '</td></tr>' ||
  CASE k % 10 WHEN 3 THEN '<tr><td>EMD Amount</td><td>Rs. 75,000</td></tr>' WHEN 7 THEN '<tr><td>EMD Amount</td><td>0</td></tr>' ELSE '' END ||
  CASE k % 12 WHEN 5 THEN '<tr><td>ePBG Percentage(%)</td><td>3.00</td></tr>' WHEN 9 THEN '<tr><td>ePBG Percentage(%)</td><td>0.00</td></tr>' ELSE '' END ||
  '<tr><td>MSE Exemption</td><td>' || CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'n/a' END || '</td></tr>' ||
  CASE WHEN k % 9 = 4 THEN '<tr><td>RA Enabled</td><td>Yes</td></tr>' ELSE '' END ||
  '<tr><td>Estimated Bid Value</td><td>' || CASE WHEN k % 3 = 0 THEN 'Rs. ' || CAST(1 + k % 9 AS STRING) || ',50,000' ELSE 'not published' END || '</td></tr>' ||
  '<tr><td>Total Quantity</td><td>999</td></tr></table><a href="/showbidDocument/' || CAST(7000000 + k AS STRING) || '">Bid Document</a>' ||
  '<a href="files/spec.pdf?x">skip</a><a href="files/spec-' || CAST(k % 4 AS STRING) || '.pdf">Technical Specification</a>' ||
  '<a href="https://mkp.gem.gov.in/downloadDocument/' || CAST(k AS STRING) || '"></a><a href="">empty</a>' ||
  '<a href="/showbidDocument/' || CAST(7000000 + k AS STRING) || '">Bid again</a></body></html>'
"""

# Reviewers' correction payloads, as JSON text.
PAYLOAD = """
'{"plain_summary":"  Summary  ' || CAST(k % 5 AS STRING) || ' ","why_it_matters":"","next_action":"Call buyer","risks":["late  delivery",""],' ||
  '"is_it_related":' || CASE k % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'null' END || ',' ||
  '"tender_kind":' || CASE k % 3 WHEN 0 THEN '"service"' WHEN 1 THEN '"bogus"' ELSE 'null' END || ',' ||
  '"classification_evidence":' || CASE WHEN k % 5 = 0 THEN '"  "' ELSE '"quoted line"' END || ',' ||
  '"jharkhand_relevance":' || CASE k % 6 WHEN 0 THEN '"yes"' WHEN 1 THEN '"no"' WHEN 2 THEN '"unclear"' ELSE 'null' END || ',' ||
  '"jharkhand_evidence":' || CASE WHEN k % 7 = 0 THEN 'null' ELSE '"place line"' END || ',' ||
  '"additional_required_documents":[{"name":"Test Report","evidence":"' || CASE WHEN k % 2 = 0 THEN 'must attach' ELSE '' END || '"},{"name":"Test report","evidence":"again"}],' ||
  '"key_eligibility_points":["Ten  years"],"key_technical_points":["16 GB","16 GB"],"unclear_points":["Check site",""]}'
"""

# Saved search hits.
HITS = """
SELECT k,
  'q' || CAST(k % 4 AS STRING) AS query, CAST(k % 4 AS INT) AS query_pos, k AS hit_pos,
  CASE WHEN k % 5 = 0 THEN '' ELSE title END AS title,
  CASE WHEN k % 7 = 0 THEN '' ELSE 'Bid ' || CASE WHEN k % 3 = 0 THEN bid_number ELSE 'notice' END || ' for ' || title END AS snippet,
  CASE WHEN k % 31 = 30 THEN '' ELSE source_url END AS link
FROM ({BIDS})
"""


# Notices that a search engine found: they name the bid's page and place, not its number.
NOTICES = """
SELECT k, 'q' || CAST(k % 4 AS STRING) AS query, CAST(k % 4 AS INT) AS query_pos, k AS hit_pos, title,
  'Notice for ' || title || ' at ' || delivery_location AS snippet, source_url AS link
FROM ({BIDS})
"""
# Documents by their address.
FILES = "SELECT k, 'https://bidplus.gem.gov.in/showbidDocument/' || CAST(7000000 + k AS STRING) AS url, doc_text AS text FROM ({BIDS})"


# File names as buyers write them, and links with odd hosts.
NAMES = """
SELECT k, CASE k % 8 WHEN 0 THEN 'Buyer Added Bid Specific ATC' WHEN 1 THEN 'Corrigendum 1' WHEN 2 THEN 'Technical Specification'
  WHEN 3 THEN 'Scope of Work' WHEN 4 THEN 'Bid-Document' WHEN 5 THEN 'random.bin' WHEN 6 THEN 'Amended S.O.W' ELSE title END AS name
FROM ({BIDS})
"""
LINKS = """
SELECT k, CASE k % 9 WHEN 0 THEN 'https://bidplus.gem.gov.in.evil.com/x' WHEN 1 THEN 'https://sub.gem.gov.in:8443/a?b' WHEN 2 THEN ''
  WHEN 3 THEN 'gem.gov.in/no-scheme' WHEN 4 THEN 'HTTPS://MKP.GEM.GOV.IN' WHEN 5 THEN 'https://gem.gov.in@evil.com/' ELSE source_url END AS link
FROM ({BIDS})
"""


def _fill(text: str, dialect: dict[str, str]) -> str:
    stamp = dialect["TS"].format("bid_end_at")
    return (
        text.replace("{BIDS}", BIDS).replace("{END}", dialect["END"])
        .replace("{PLUS4}", dialect["PLUS4"]).replace("{TS_END}", stamp)
    )


COLUMNS = (
    "k", "bid_number", "source_url", "title", "delivery_location", "buyer_organization", "ministry",
    "portal_status", "quantity", "quantity_unit", "portal_emd_amount", "portal_epbg_pct", "ra_enabled",
    "doc_text",
)


def sql(name: str, dialect: dict[str, str]) -> str:
    """SQL of a derived view: bids, next_day, listing_cards, details, payloads, hits, names, links."""
    texts = {
        "bids": BIDS,
        "next_day": NEXT_DAY.replace("{COLUMNS}", ", ".join(COLUMNS)),
        "listing_cards": f"SELECT k, CAST(floor(k / 8) AS BIGINT) AS page_no, {CARD} AS card FROM ({{BIDS}})",
        "next_cards": f"SELECT k, CAST(floor(k / 8) AS BIGINT) AS page_no, {CARD} AS card FROM ({NEXT_DAY.replace('{COLUMNS}', ', '.join(COLUMNS))})",
        "details": f"SELECT k, bid_number, source_url, {DETAIL} AS html FROM ({{BIDS}})",
        "payloads": f"SELECT k, bid_number, source_url, CASE WHEN k % 8 < 6 THEN {PAYLOAD} END AS payload FROM ({{BIDS}})",
        "hits": HITS,
        "notices": NOTICES,
        "files": FILES,
        "names": NAMES,
        "links": LINKS,
    }
    return _fill(texts[name], dialect)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bids that one task derives and analyses: an order is a few bytes, the work on its texts is not.
BIDS_PER_TASK = 20_000


def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers as structs ``o`` and ``c``, dealt over tasks of bounded size.

    They are dealt after the join, so that neither its kind nor the size of the files decides how many bids a task gets.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    both = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return spread(both, orders.count(), BIDS_PER_TASK).select(F.struct(*orders.columns).alias("o"), F.struct(*customer.columns).alias("c"))


def view(spark: SparkSession, sf_dir: str, name: str = "bids") -> DataFrame:
    """A derived view, spread over the cluster's cores before any text work."""
    # Braces in the text are data, not parameters of spark.sql.
    query = sql(name, SPARK).replace("{", "{{").replace("}", "}}")
    return spark.sql(
        query.replace("FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey", "FROM {both}"),
        both=ordered(spark, sf_dir),
    )


def listing_pages(spark: SparkSession, sf_dir: str, name: str = "listing_cards") -> DataFrame:
    """Listing pages of eight cards each, as ``page_no, url, html``."""
    cards = view(spark, sf_dir, name)
    ordered = F.sort_array(F.collect_list(F.struct("k", "card")))
    return cards.groupBy("page_no").agg(
        F.array_join(F.transform(ordered, lambda c: c["card"]), "").alias("cards")
    ).select(
        "page_no",
        F.concat(F.lit("https://bidplus.gem.gov.in/all-bids?page="), F.col("page_no")).alias("url"),
        F.concat(F.lit("<html><body>"), F.col("cards"), F.lit("</body></html>")).alias("html"),
    )
