"""Checking SQL per query name."""

from __future__ import annotations

from bidlens.catalog.oracle import (
    B, BC, BD, BG, BS, FULL, KEY, LISTING_HEAD, LISTING_SAYS, NOW, NOW_2, ORACLES, R, SELECTS, add, analysed, classified, judged, arr, at, base, capability, clean, distinct_ci, full, g,
    gate, hits, located, official, q, rupees, score_text, screen, security_line, some, urgency, days, active,
)
from bidlens.plans import views

J = "array_to_string({0}, '; ')".format
DUCK = views.DUCK
V = {n: views.sql(n, DUCK) for n in ("bids", "details", "hits", "names", "links", "payloads", "notices", "files")}

# -- A ---------------------------------------------------------------------
PORTAL = "'https://bidplus.gem.gov.in"
add("A1_listing_cards", B, f"""
, c AS (SELECT *, CAST(floor(k / 8) AS BIGINT) AS page_no, row_number() OVER (PARTITION BY CAST(floor(k / 8) AS BIGINT) ORDER BY k) - 1 AS pos,
  CASE WHEN k % 17 = 16 THEN 'GEM/2026/B/' || (7000000 + k) WHEN k % 23 = 22 THEN '' ELSE 'GEM/2026/B/' || (7000000 + k) END AS bn,
  trim(buyer_organization || ', ' || delivery_location) AS addr FROM bids)
SELECT {PORTAL}/all-bids?page=' || page_no AS page_url, pos, bn AS bid_number, {PORTAL}/showbidDocument/' || (7000000 + k) AS source_url,
  title, title AS item_description, 'Lot ' || (k % 5) AS category, addr AS buyer_address, CAST(1 + k % 60 AS DOUBLE) AS quantity, 'Nos' AS quantity_unit,
  '2026-09-01 09:00:00' AS bid_start_at, {at('bid_end_at')} AS bid_end_at,
  length({clean("CASE WHEN k % 23 = 22 THEN '' WHEN k % 17 = 16 THEN 'View bid' ELSE 'GEM/2026/B/' || (7000000 + k) END || CASE WHEN k % 17 = 16 THEN ' Ref: gem/2026/b/' || (7000000 + k) ELSE '' END || ' Items: ' || title || ' Quantity: ' || (1 + k % 60) || ' Nos Category: Lot ' || (k % 5) || ' Department Name And Address: ' || addr || ' Start Date: 01-09-2026 09:00:00 End Date: ' || coalesce(strftime(bid_end_at, '%d-%m-%Y %H:%M:%S'), 'as per schedule')")}) AS listing_chars
FROM c WHERE bn <> ''""")

_labels = ", ".join(f"({q(' '.join(''.join(ch if ch.isalnum() else ' ' for ch in l.lower()).split()))}, {q(f)}, {i})" for i, (f, l) in enumerate((f, l) for f, ls in R.portal["labels"].items() for l in ls))
DETAIL_CTE = f"""d AS ({V['details']}),
lab0(label, field, i) AS (VALUES {_labels}), lab AS (SELECT label, arg_max(field, i) AS field FROM lab0 GROUP BY label),
raw AS (SELECT k, source_url, bid_number, unnest(regexp_extract_all(html, '<tr>(.*?)</tr>', 1)) AS row, generate_subscripts(regexp_extract_all(html, '<tr>(.*?)</tr>', 1), 1) AS i FROM d),
cells AS (SELECT k, source_url, bid_number, i, trim(regexp_replace(lower(regexp_extract(row, '<td>(.*?)</td>', 1)), '[^a-z0-9]+', ' ', 'g')) AS label, trim(regexp_extract(row, '<td>.*?</td><td>(.*?)</td>', 1)) AS value FROM raw),
f AS (SELECT k, source_url, bid_number, field, arg_min(value, i) AS value FROM cells JOIN lab USING (label) WHERE value <> '' GROUP BY ALL)"""
add("A2_detail_fields", DETAIL_CTE, "SELECT source_url AS page_url, field, value FROM f")
add("A3_detail_merge", B + "," + DETAIL_CTE, f"""
, p AS (SELECT k, {', '.join(f"max(value) FILTER (field = '{c}') AS {c}" for c in ('bid_end_at', 'ministry', 'buyer_organization', 'buyer_address', 'quantity', 'estimated_value', 'emd_amount', 'epbg_percentage', 'msme_exemption', 'ra_enabled'))} FROM f GROUP BY k)
SELECT b.bid_number, coalesce(p.ministry, b.ministry) AS ministry, coalesce(p.buyer_organization, b.buyer_organization) AS buyer_organization, coalesce(p.buyer_address, '') AS buyer_address,
  coalesce(CAST(regexp_extract(p.quantity, '\\d+') AS DOUBLE), b.quantity) AS quantity, coalesce(nullif(regexp_extract(p.quantity, '\\d+\\s*([A-Za-z./]+)', 1), ''), b.quantity_unit) AS quantity_unit,
  coalesce(TRY_CAST(replace(regexp_extract(p.estimated_value, '[\\d,]+'), ',', '') AS DOUBLE), b.estimated_value) AS estimated_value,
  TRY_CAST(replace(regexp_extract(p.emd_amount, '[\\d,]+'), ',', '') AS DOUBLE) AS portal_emd_amount, coalesce(p.emd_amount, '') AS portal_emd_text,
  TRY_CAST(p.epbg_percentage AS DOUBLE) AS portal_epbg_pct,
  CASE lower(p.msme_exemption) WHEN 'yes' THEN 'required' WHEN 'no' THEN 'not_required' ELSE 'not_stated' END AS msme_portal_flag,
  coalesce(p.ra_enabled, '') AS ra_enabled, coalesce(strftime(try_strptime(p.bid_end_at, '%d-%m-%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), {at('b.bid_end_at')}) AS bid_end_at
FROM bids b LEFT JOIN p ON p.k = b.k AND b.bid_number <> ''""")
add("A4_attachments", B, f"""
, a AS (SELECT *, regexp_extract(source_url, '^([a-z]+://[^/]+)', 1) AS root, regexp_replace(source_url, '[^/]*$', '') AS folder FROM bids)
SELECT source_url AS page_url, 0 AS "rank", 'Technical Specification' AS name, folder || 'files/spec-' || (k % 4) || '.pdf' AS url, 'technical_spec' AS kind FROM a
UNION ALL SELECT source_url, 1, 'Bid Document', root || '/showbidDocument/' || (7000000 + k), 'bid_document' FROM a
UNION ALL SELECT source_url, 2, CAST(k AS VARCHAR), 'https://mkp.gem.gov.in/downloadDocument/' || k, 'unknown' FROM a
UNION ALL SELECT url, NULL, NULL, NULL, NULL FROM pages WHERE regexp_matches(html, 'href="[^"]*(\\.pdf"|showbidDocument|downloadDocument|showradocumentPdf)')""")
add("A5_document_kinds", f"n AS ({V['names']}), z AS (SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9_]+', ' ', 'g')) AS x FROM n)", """
SELECT name, CASE WHEN regexp_matches(x, 'atc|additional terms') THEN 'atc' WHEN regexp_matches(x, 'corrigend|amend') THEN 'corrigendum' WHEN regexp_matches(x, 'spec|technical') THEN 'technical_spec'
  WHEN regexp_matches(x, 'scope|sow') THEN 'scope_of_work' WHEN regexp_matches(x, 'bid|tender|document') THEN 'bid_document' ELSE 'unknown' END AS kind, count(*) AS n FROM z GROUP BY ALL""")
DRIFT = B + f"""
, lp AS (SELECT {PORTAL}/all-bids?page=' || CAST(floor(k / 8) AS BIGINT) AS url, CAST(floor(k / 8) AS BIGINT) % 5 = 0 AS broken, count(*) AS n,
   count(*) FILTER (k % 17 = 16 OR k % 23 <> 22) AS nb, string_agg(lower(title || buyer_organization || delivery_location), ' ') AS t FROM bids GROUP BY ALL),
dr AS (SELECT url, CASE WHEN broken THEN 0 ELSE n END AS n_cards, CASE WHEN broken THEN 0 ELSE nb END AS n_bids, CAST(nb > 0 AS INT) + 1 AS canaries FROM lp
 UNION ALL SELECT url, 0, 0, {' + '.join(f"CAST(contains(lower(html), {q(c)}) AS INT)" for c in R.portal['canaries'])} FROM pages),
ds AS (SELECT *, CASE WHEN (n_cards = 0 AND canaries >= 2) OR (n_cards > 0 AND n_bids = 0) THEN 'PARSER_DRIFT' WHEN n_cards = 0 THEN 'empty' ELSE 'ok' END AS state FROM dr)"""
add("A6_drift", DRIFT, "SELECT * FROM ds")
add("A6_drift_issues", DRIFT, "SELECT 'listing' AS stage, url AS target, state AS error_type, CASE WHEN n_cards = 0 THEN 'bid-shaped content but no card matched' ELSE n_cards || ' cards found but none yielded a bid number' END AS detail FROM ds WHERE state = 'PARSER_DRIFT'")
ORACLES["A7_challenge_pages"] = f"SELECT page_id, {' OR '.join(f'contains(h, {q(m)})' for m in R.portal['challenge_markers'])} AS challenge FROM (SELECT page_id, lower(CASE page_id % 10 WHEN 0 THEN '<div class=\"G-reCaptcha\">' || html WHEN 1 THEN html || repeat('x', 20000) || 'hcaptcha' ELSE html END) AS h FROM pages)"
HITS = f"""h0 AS (SELECT * REPLACE ({clean('snippet')} AS snippet) FROM ({V['hits']})), hc AS (SELECT *, upper(regexp_extract(concat_ws(' ', title, snippet, link), '(?i)\\bGEM/\\d{{4}}/[A-Z]/\\d+\\b')) AS bn FROM h0 WHERE {official('link')})"""
add("A8_search_hits", HITS, "SELECT k, query, bn AS bid_number, link AS source_url, coalesce(nullif(title, ''), nullif(snippet, ''), link) AS title, snippet AS item_description, title || ' ' || snippet AS listing_text FROM hc")
add("A9_zero_results", HITS, f"SELECT 'none' AS \"case\", 'listing' AS stage, {PORTAL}/all-bids' AS target, 'ZERO_RESULTS_ALL_QUERIES' AS error_type, (SELECT count(DISTINCT query) FROM h0) || ' search terms returned no rows' AS detail WHERE (SELECT count(*) FROM hc WHERE link LIKE '%/nowhere/%') = 0 UNION ALL SELECT 'all', 'listing', {PORTAL}/all-bids', 'ZERO_RESULTS_ALL_QUERIES', '' WHERE (SELECT count(*) FROM hc) = 0")
DOCS = "df AS (SELECT 'doc:' || CAST(floor(doc_id / 3) AS BIGINT) AS identity_key, doc_id AS pos, 'File ' || (doc_id % 3) AS name, text, length(text) AS text_chars FROM documents)"
add("A10_document_text", DOCS, "SELECT identity_key, length(t) AS chars, md5(t) AS digest FROM (SELECT identity_key, string_agg(chr(10) || '===== ' || name || ' (unknown) =====' || chr(10) || text, chr(10) ORDER BY pos) AS t FROM df WHERE text_chars > 0 GROUP BY 1)")
ORACLES["A11_document_admission"] = """SELECT doc_id, CASE WHEN NOT big THEN sha256(text) END AS sha256, CASE WHEN big THEN 'failed' WHEN doc_id % 3 = 2 THEN 'skipped' ELSE 'text' END AS extraction_method,
 CASE WHEN big THEN 'download failed (see access issues)' WHEN doc_id % 3 = 2 THEN 'unsupported content type ''image/png''' ELSE '' END AS error FROM (SELECT *, false AS big FROM documents)"""
add("A12_detail_budget", B, "SELECT k, n <= 250 AS in_budget, CASE WHEN n > 250 THEN 'Detail page not fetched (per-run budget reached) — figures below come from the search listing only.' END AS flag FROM (SELECT k, row_number() OVER (ORDER BY k) AS n FROM bids)")
add("A12_document_budget", DOCS, """, r AS (SELECT *, row_number() OVER (ORDER BY pos) <= 400 AS ok FROM df), x AS (SELECT identity_key, count(*) AS documents, count(*) FILTER (ok) AS documents_read, bool_or(text_chars > 0 AND ok) AS has FROM r GROUP BY 1)
SELECT identity_key, documents, documents_read, CASE WHEN documents_read BETWEEN 1 AND documents - 1 THEN 'Not all tender documents were read (per-run download budget reached) — review the remaining attachments manually.' END AS budget_flag,
 CASE WHEN documents_read > 0 AND NOT has THEN 'No tender document text could be extracted — every requirement below comes from the portal listing only.' END AS no_text_flag FROM x""")
_queries = list({x.lower(): x for gr in reversed(R.groups) for x in reversed(gr["queries"])}.values())
N_QUERIES = len(_queries)
_q1 = list(dict.fromkeys(x.lower() for gr in R.groups for x in gr["queries"]))
add("A13_rule_tables", B + f", h AS (SELECT {hits(chr(39) + ' ' + chr(39) + ' || lower(title) || ' + chr(39) + ' ' + chr(39), _q1)} AS q FROM bids), n AS (SELECT unnest(q) AS q, 1 AS one FROM h)",
    f"SELECT t.query, count(n.one) AS bids FROM (SELECT unnest({arr(_queries)}) AS query) t LEFT JOIN n ON n.q = lower(t.query) GROUP BY 1")
_sig = [(gr["key"], pol, t) for gr in R.groups for pol, key in (("signal", "signals"), ("negative", "negatives")) for t in gr[key]]
add("A13_signal_table", B + f", h AS (SELECT {hits(chr(39) + ' ' + chr(39) + ' || lower(title) || ' + chr(39) + ' ' + chr(39), list(dict.fromkeys(t for _, _, t in _sig)))} AS q FROM bids), n AS (SELECT unnest(q) AS q, 1 AS one FROM h)",
    f"SELECT group_key, polarity, term, count(n.one) AS bids FROM (VALUES {', '.join(f'({q(a)}, {q(b)}, {q(c)})' for a, b, c in _sig)}) t(group_key, polarity, term) LEFT JOIN n ON n.q = term GROUP BY ALL")
REP = "ju WHERE verdict <> 'rejected'"
add("A14_snapshot_sink", FULL, f"SELECT '2026-09-06' AS snapshot_date, 'open' AS status, count(*) AS bids, max(dr) AS max_days FROM {REP} UNION ALL SELECT '2026-09-07', 'open', count(*), max(dr) FROM {REP} AND dr > 5")
ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S+05:30')".format


def flat(p: str, today: str) -> str:
    return f"""SELECT identity_key, bid_number, '' AS gem_tender_id, title, buyer_organization AS buyer, ministry AS department, array_to_string(cats, ', ') AS categories, kind, delivery_location AS location,
 array_to_string(gd, ', ') AS districts, CAST(NULL AS VARCHAR) AS published_at, {ISO('bid_end_at')} AS bid_end_at, dr AS days_remaining, urg AS urgency, estatus AS emd_status, eamount AS emd_amount, shead AS epbg_status, spct AS epbg_percentage,
 estimated_value, total AS score, band AS score_band, grade AS match_level, 'open' AS status, source_url, '' AS report_doc_url, '{today}' AS first_seen_on, '{today}' AS last_seen_on FROM {p}ju WHERE verdict <> 'rejected'"""


add("A15_flat_rows", FULL, flat("", NOW[:10]).replace(" FROM ju", ", concat_ws('|', identity_key, bid_number, verdict, CAST(total AS VARCHAR), array_to_string(doc_keys, ',')) AS payload FROM ju"))
TWO = FULL + "," + full("z", "next_day", NOW_2) + f""",
d1 AS ({flat('', NOW[:10])}), d2 AS ({flat('z', NOW_2[:10])}),
mg AS (SELECT coalesce(t.identity_key, p.identity_key) AS identity_key, CASE WHEN t.identity_key IS NULL THEN 'kept' WHEN p.identity_key IS NULL THEN 'new' ELSE 'updated' END AS action,
 {', '.join(f"CASE WHEN t.identity_key IS NOT NULL THEN t.{c} ELSE p.{c} END AS {c}" for c in ('bid_end_at', 'estimated_value', 'last_seen_on', 'score', 'status', 'title'))},
 coalesce(p.first_seen_on, t.first_seen_on) AS first_seen_on FROM d2 t FULL OUTER JOIN d1 p ON p.identity_key = t.identity_key)"""


def num(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'not stated' WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) || '.0' ELSE CAST({x} AS VARCHAR) END"


def shown(x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') IN ('', 'not_stated') THEN 'not stated' WHEN length({x}) >= 10 AND {x}[5] = '-' AND TRY_CAST(left({x}, 10) AS DATE) IS NOT NULL THEN strftime(TRY_CAST(left({x}, 10) AS DATE), '%d %B %Y') ELSE {x} END"


_diffs = []
for _f, _l in (("bid_end_at", "Closing date"), ("emd_status", "EMD requirement"), ("emd_amount", "EMD amount"), ("epbg_status", "Performance security requirement"),
               ("epbg_percentage", "ePBG percentage"), ("estimated_value", "Estimated value"), ("title", "Tender title"), ("status", "Tender status")):
    _n = _f in ("emd_amount", "epbg_percentage", "estimated_value")
    _same = f"abs(coalesce(p.{_f}, 0) - coalesce(t.{_f}, 0)) < 0.01" if _n else f"coalesce(p.{_f}, '') = coalesce(t.{_f}, '')"
    _blank = f"p.{_f} IS NULL" if _n else f"coalesce(p.{_f}, '') IN ('', 'not_stated')"
    _show = num if _n else shown
    _diffs.append(f"SELECT t.identity_key, {q(_l)} AS field_name, {_show('p.' + _f)} AS old_value, {_show('t.' + _f)} AS new_value, CASE WHEN {_blank} THEN 'first time this was stated on the portal' ELSE '' END AS note FROM d1 p JOIN d2 t USING (identity_key) WHERE NOT ({_same})")
CH = TWO + ", ch AS (" + " UNION ALL ".join(_diffs) + ")"

add("A14_all_sinks", CH, f"""SELECT 'bids' AS sink, coalesce(t.day, p.day) AS day, coalesce(t.urg, p.urg) AS what, count(*) AS n
 FROM (SELECT identity_key, urg, '{NOW_2[:10]}' AS day FROM zju WHERE verdict <> 'rejected') t FULL OUTER JOIN (SELECT identity_key, urg, '{NOW[:10]}' AS day FROM ju WHERE verdict <> 'rejected') p USING (identity_key) GROUP BY ALL
 UNION ALL SELECT 'changes', '{NOW_2[:10]}', field_name, count(*) FROM ch GROUP BY ALL
 UNION ALL SELECT 'runs', '{NOW[:10]}', unnest(['bids', 'new', 'updated', 'changes']), unnest([(SELECT count(*) FROM d1), (SELECT count(*) FROM d1), 0, 0])
 UNION ALL SELECT 'runs', '{NOW_2[:10]}', unnest(['bids', 'new', 'updated', 'changes']), unnest([(SELECT count(*) FROM d2), (SELECT count(*) FROM mg WHERE action = 'new'), (SELECT count(*) FROM mg WHERE action = 'updated'), (SELECT count(*) FROM ch)])
 UNION ALL SELECT 'bids of the first version', '{NOW[:10]}', 'all', count(*) FROM d1""")


def tab(p: str, first: str, last: str, url: str) -> str:
    return f"""SELECT '{first}' AS "Date Found", '{last}' AS "Last Seen", title AS "Tender Title", bid_number AS "Bid Number", '' AS "Tender ID", buyer_organization AS "Buyer", ministry AS "Department", array_to_string(cats, ', ') AS "Product Category",
 kind AS "Product / Service", delivery_location AS "Location", array_to_string(gd, ', ') AS "Districts", coalesce(strftime(bid_end_at, '%Y-%m-%d %H:%M'), '') AS "Closing Date", dr AS "Days Remaining", urg AS "Urgency", estatus AS "EMD Required",
 eamount AS "EMD Amount", shead AS "ePBG Required", spct AS "ePBG %", estimated_value AS "Estimated Value", total AS "Opportunity Score", band AS "Score Band", grade AS "Match Level", 'open' AS "Status", source_url AS "Official GeM Link",
 '{url}' AS "Google Doc Report Link", array_to_string(flags, ' | ') AS "Verification Flags" FROM {p}ju WHERE verdict <> 'rejected'"""


add("A16_bid_tab", FULL + "," + full("z", "next_day", NOW_2), f"""
, o AS ({tab('', '2026-09-01', NOW[:10], 'https://docs/1')}), n AS ({tab('z', NOW_2[:10], NOW_2[:10], 'https://docs/2')})
SELECT * FROM n UNION ALL SELECT * FROM o WHERE "Bid Number" NOT IN (SELECT "Bid Number" FROM n WHERE "Bid Number" <> '')""")
add("A16_change_tab", CH, f"""SELECT '{NOW_2[:10]}' AS "Detected On", coalesce(z.bid_number, ch.identity_key) AS "Bid Number", field_name AS "Field", old_value AS "Old Value", new_value AS "New Value", note AS "Note" FROM ch LEFT JOIN zju z ON z.identity_key = ch.identity_key AND z.verdict <> 'rejected'""")
ISSUES = """iss AS (SELECT ts, CASE WHEN event_id % 100 = 0 THEN 'listing' ELSE 'detail' END AS stage, 'https://bidplus.gem.gov.in/' || user_id AS target, 'HTTP_' || (event_id % 7 + 500) AS error_type FROM events WHERE event_type = 'error'),
il AS (SELECT '⚠ GeM ACCESS ISSUE — ' || strftime(ts, '%d %b %Y %H:%M') || ' IST — ' || error_type || ' at ' || stage || ' (' || target || ')' AS line FROM iss),
deg AS (SELECT DISTINCT 'mode ' || (event_id % 3) AS mode FROM events WHERE event_type = 'error'),
rj AS (SELECT reason, count(*) AS n FROM (SELECT screen_reason AS reason FROM scr WHERE screen_reason IS NOT NULL UNION ALL SELECT rejected_reason FROM ju WHERE rejected_reason IS NOT NULL) GROUP BY 1)"""
add("A16_run_tab", TWO + "," + ISSUES, f"""SELECT 'run-1' AS "Run ID", '2026-09-06T08:30:00+05:30' AS "Started", '2026-09-06T09:00:00+05:30' AS "Finished", {N_QUERIES} AS "Queries", (SELECT count(*) FROM scr) AS "Bids Seen", (SELECT count(*) FROM ju WHERE bid_number <> '') AS "Details Fetched", (SELECT count(*) FROM documents) AS "Documents",
 (SELECT count(*) FROM ju WHERE verdict = 'accepted') AS "Accepted", (SELECT count(*) FROM ju WHERE verdict = 'watchlist') AS "Watchlist", (SELECT count(*) FROM mg WHERE action = 'new') AS "New", (SELECT count(*) FROM mg WHERE action = 'updated') AS "Updated",
 (SELECT string_agg(error_type || ' at ' || stage || ' (' || n || ')', ' | ' ORDER BY stage, error_type) FROM (SELECT stage, error_type, count(*) AS n FROM iss GROUP BY ALL)) AS "Access Issues", (SELECT string_agg(mode, ', ' ORDER BY mode) FROM deg) AS "Degraded Modes", 'https://docs/1' AS "Report Link" """)

# -- B ---------------------------------------------------------------------
add("B1_host_filter", f"l AS ({V['links']})", f"SELECT k, link, {official('link')} AS official FROM l")
_listing = "CASE k % 6 WHEN 0 THEN repeat('x ', 150) || 'Closed circuit TV ' WHEN 1 THEN repeat('x ', 250) || 'withdrawn' ELSE title END"
_status = f"portal_status || ' ' || {_listing}"
add("B2_active", B, f"SELECT portal_status, k % 6 AS slot, count(*) FILTER ({active(_status)}) AS active FROM bids GROUP BY ALL")
add("B3_screen", BS, "SELECT k, screen_reason FROM scr")
add("B4_gate", BS, f"SELECT k, {gate('lrel', 'lreg')} AS reason FROM scr")
add("B5_watchlist", FULL, "SELECT k, verdict, rejected_reason, urg AS urgency, total AS score FROM ju")
add("B6_windows", B, "SELECT k, coalesce(dr BETWEEN 0 AND 10, false) AS main, coalesce(dr BETWEEN 11 AND 60, false) AS watch FROM base")
add("B7_haystack", B, f"SELECT k, lower({clean('concat_ws(' + q(' ') + ', title, nullif(buyer_organization, ' + q('') + '), nullif(doc_text, ' + q('') + '))')}) AS haystack FROM bids")
add("B8_geo_fields", BG, "SELECT k, f AS name, t AS text FROM gf WHERE t <> ''")
add("B9_open_bids", TWO, "SELECT identity_key, bid_end_at, score, title FROM mg WHERE NOT coalesce(left(bid_end_at, 10) < '2026-09-07', false) ORDER BY bid_end_at NULLS FIRST, identity_key")
add("B10_buckets", FULL, "SELECT bucket, urg AS urgency, estatus AS emd_status, len(gaps) > 0 AS risky, count(*) AS n FROM ju WHERE verdict = 'accepted' GROUP BY ALL")
add("B11_source_reachable", ISSUES.split("rj AS")[0].rstrip().rstrip(","), "SELECT count(*) FILTER (stage = 'listing') = 0 AS source_reachable, 'all' AS \"case\" FROM iss UNION ALL SELECT true, 'detail only'")

# -- C ---------------------------------------------------------------------
_ws = "regexp_replace(replace(replace(text, chr(160), ' '), chr(8203), ''), '[\\s\\x1C-\\x1F\\x{0085}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g')"
add("C1_signal_match", f"t AS (SELECT doc_id, ' ' || lower(trim({_ws})) || ' ' AS h FROM documents), m AS (" + " UNION ALL ".join(f"SELECT doc_id, {q(gr['label'])} AS label, {hits('h', gr['signals'])} AS hits FROM t" for gr in R.groups) + ")",
    "SELECT doc_id, label, array_to_string(hits, '; ') AS hits FROM m WHERE len(hits) > 0")
_n = len(R.groups)
add("C2_negative_veto", BD, " UNION ALL ".join(f"SELECT k, {q(gr['label'])} AS label, {J(f'h{i}')} AS hits, {J(f'n{i}')} AS negatives, len(n{i}) > 0 AND len(n{i}) >= len(h{i}) AS vetoed FROM cg WHERE len(h{i}) > 0" for i, gr in enumerate(R.groups)))
add("C3_hard_vetoes", BD, f"SELECT k, {J('hv')} AS vetoes FROM cg WHERE len(hv) > 0")
_lvl, _why = capability("lcats")
add("C4_capability", BS, f"SELECT k, {_lvl} AS level, {_why} AS reason FROM scr")
add("C5_geo_matches", BG, f"SELECT k, f AS field, {J('hit')} AS hits, {J('di')} AS districts FROM gm WHERE len(hit) > 0")
add("C6_snapshot_merge", TWO, "SELECT identity_key, action, bid_end_at, estimated_value, first_seen_on, last_seen_on, score, status FROM mg")
add("C7_change_detection", CH, f"SELECT *, '{NOW_2[:10]}' AS detected_on FROM ch")
FOUND = B + "," + HITS + f""", pc AS (SELECT b.identity_key, 'portal' AS adapter, 0 AS a, 'p' || qq AS query, qq AS qp, k AS pos, title FROM base b, (SELECT unnest([2, 3, 5, 1]) AS qq) WHERE k % qq = 0),
sc AS (SELECT CASE WHEN bn <> '' THEN 'bid:' || bn ELSE 'url:' || left(sha256(link), 32) END AS identity_key, 'search' AS adapter, 1 AS a, query, query_pos AS qp, hit_pos AS pos, coalesce(nullif(title, ''), nullif(snippet, ''), link) AS title FROM hc),
un AS (SELECT * FROM pc UNION ALL SELECT * FROM sc), pq AS (SELECT identity_key, adapter, query, min({{'a': a, 'q': qp, 'p': pos}}) AS f, count(*) AS n FROM un GROUP BY ALL)"""
add("C8_discovery_merge", FOUND, """SELECT identity_key, arg_min(adapter, {'a': a, 'q': qp, 'p': pos}) AS adapter, arg_min(title, {'a': a, 'q': qp, 'p': pos}) AS title,
 array_to_string(list_sort(list(DISTINCT adapter)), ',') AS discovered_via, (SELECT string_agg(query, ',' ORDER BY f) FROM pq WHERE pq.identity_key = un.identity_key) AS queries, count(*) AS sightings FROM un GROUP BY identity_key""")
_rev = f"pl AS (SELECT {'CASE WHEN bid_number <> ' + q('') + ' THEN ' + q('bid:') + ' || upper(trim(bid_number)) ELSE ' + q('url:') + ' || left(sha256(source_url), 32) END'} AS ik, payload AS pj FROM ({V['payloads']}))"
_js = "json_extract_string(pj, '$.{0}')".format
add("C9_corrections", FULL + "," + _rev + f""", rv AS (SELECT ju.*, pj, pj IS NOT NULL AS hasp, trim(coalesce({_js('classification_evidence')}, '')) AS cq, trim(coalesce({_js('jharkhand_evidence')}, '')) AS gq, {_js('jharkhand_relevance')} AS rel,
  {_js('tender_kind')} AS tk, CAST({_js('is_it_related')} AS BOOLEAN) AS itr, trim(coalesce({_js('additional_required_documents[0].evidence')}, '')) AS dq FROM ju LEFT JOIN pl ON ik = identity_key)""",
    f"""SELECT k, CASE WHEN hasp THEN {clean("json_extract_string(pj, '$.plain_summary')")} ELSE {'summary'} END AS plain_summary, CASE WHEN hasp THEN 'Call buyer' ELSE '' END AS next_action, CASE WHEN hasp THEN 'late delivery' ELSE '' END AS risks,
 CASE WHEN cq <> '' AND itr IS NOT NULL THEN itr ELSE related END AS related, CASE WHEN cq <> '' AND tk = 'service' THEN tk ELSE kind END AS kind, CASE WHEN cq <> '' AND itr <> related THEN 'inferred' ELSE conf END AS confidence,
 CASE WHEN gq <> '' AND rel IN ('yes', 'no') THEN rel = 'yes' ELSE in_region END AS in_region,
 CASE WHEN gq <> '' AND rel IN ('yes', 'no') AND (rel = 'yes') <> in_region THEN 'inferred' WHEN rel = 'unclear' AND in_region THEN 'unclear' ELSE gconf END AS geo_confidence,
 array_to_string(doc_keys || CASE WHEN NOT hasp THEN [] ELSE ['llm:test report'] END, '; ') AS documents, array_to_string(q_eligibility || CASE WHEN hasp THEN ['Ten years'] ELSE [] END, ' | ') AS eligibility,
 array_to_string(q_technical || CASE WHEN hasp THEN ['16 GB'] ELSE [] END, ' | ') AS technical,
 array_to_string(flags || CASE WHEN hasp THEN ['Check site'] ELSE [] END || CASE WHEN rel = 'unclear' AND in_region THEN ['AI review could not confirm the Jharkhand work location.'] ELSE [] END, ' | ') AS flags FROM (SELECT *, SUMMARY AS summary FROM rv)""")
SUMMARY = f"""(buyer_organization || ' ' || CASE kind WHEN 'service' THEN 'is procuring services:' WHEN 'supply_and_service' THEN 'is procuring supply and related services:' WHEN 'product_supply' THEN 'is buying:' ELSE 'has published a requirement for:' END || ' ' || title
 || ' (' || {g('quantity')} || ' ' || coalesce(nullif(quantity_unit, ''), 'units') || '). Delivery/service location: ' || coalesce(nullif(delivery_location, ''), 'an unspecified location') || '.')"""
ORACLES["C9_corrections"] = ORACLES["C9_corrections"].replace("SUMMARY", SUMMARY)
_mine = arr(d.lower() for d in R.profile["service_districts"])
add("C10_district_coverage", BS, f"SELECT k, CASE WHEN len(lds) > 0 THEN CAST(list_has_any(list_transform(lds, lambda x: lower(x)), {_mine}) AS VARCHAR) ELSE 'not known' END AS serves FROM scr")
LINE = "'⚠ ' || field_name || ' changed from ' || old_value || ' to ' || new_value"
add("C11_change_labels", CH, f"""SELECT ch.identity_key, coalesce(max(z.bid_number || ' — ' || z.title), ch.identity_key) AS label, string_agg({LINE}, chr(10) ORDER BY {LINE}) AS lines
 FROM ch LEFT JOIN (SELECT * FROM zju WHERE verdict <> 'rejected') z ON z.identity_key = ch.identity_key GROUP BY ch.identity_key""")
_labels_of = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.decision["rejection_labels"].items())
add("C12_rejection_labels", FULL + "," + ISSUES, f"SELECT reason, CAST(n AS BIGINT) AS n, CASE reason {_labels_of} ELSE replace(reason, '_', ' ') END AS label FROM rj")

# -- D ---------------------------------------------------------------------
add("D1_rejections", FULL + "," + ISSUES, "SELECT reason, n FROM rj")
ACC = "FROM ju WHERE verdict = 'accepted'"
COUNTS = "count(*) AS total, count(*) FILTER (total >= 80) AS strong, count(*) FILTER (total >= 60 AND total < 80) AS good, count(*) FILTER (urg = 'URGENT') AS urgent, count(*) FILTER (estatus = 'required') AS with_emd, count(*) FILTER (estatus = 'not_required') AS without_emd, count(*) FILTER (estatus = 'not_stated') AS emd_unclear"
add("D2_counters", FULL, f"SELECT {COUNTS} {ACC}")
add("D3_emd_totals", FULL, f"SELECT estatus AS emd_status, count(*) AS n, sum(CASE WHEN estatus = 'required' THEN eamount END) AS known_amount {ACC} GROUP BY 1")
DEMAND = f"(SELECT name, count(*) AS n, (SELECT count(*) {ACC}) AS total FROM (SELECT unnest(list_transform(docs, lambda x: x.n)) AS name {ACC}) GROUP BY 1)"
add("D4_document_demand", FULL, f"SELECT * FROM {DEMAND}")
add("D5_run_manifest", TWO + "," + ISSUES, f"""SELECT 'run-1' AS run_id, {N_QUERIES} AS queries, (SELECT count(*) FROM ju WHERE bid_number <> '') AS details_fetched, (SELECT count(*) FROM documents) AS documents_downloaded, (SELECT count(*) FROM scr) AS listings_seen, (SELECT count(*) FROM scr) AS candidates, (SELECT count(*) FROM ju WHERE verdict = 'accepted') AS accepted, (SELECT count(*) FROM ju WHERE verdict = 'watchlist') AS watchlist,
 (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM rj) AS rejected, (SELECT count(*) FROM mg WHERE action = 'new') AS new_tenders, (SELECT count(*) FROM mg WHERE action = 'updated') AS updated_tenders, (SELECT count(*) FROM iss) AS issues, (SELECT string_agg(mode, ',' ORDER BY mode) FROM deg) AS degraded""")
add("D6_new_and_updated", TWO, "SELECT action, count(*) AS n FROM mg GROUP BY 1")
add("D7_matched_queries", FOUND, "SELECT identity_key, string_agg(query || 'x' || n, ',' ORDER BY f) AS queries, sum(n) AS sightings FROM pq WHERE adapter = 'portal' GROUP BY 1")
add("D8_expire", TWO, "SELECT CASE WHEN coalesce(left(bid_end_at, 10) < '2026-09-12', false) THEN 'closed' ELSE 'open' END AS status, count(*) AS n, count(*) FILTER (left(bid_end_at, 10) < '2026-09-12') AS just_closed FROM mg GROUP BY 1")
add("D9_has_text", DOCS, "SELECT identity_key, bool_or(CASE WHEN pos % 2 = 0 THEN text_chars ELSE 0 END > 0) AS has_document_text FROM df GROUP BY 1")
add("D10_changes_on_day", CH, "SELECT field_name, old_value, new_value, note FROM ch WHERE identity_key = (SELECT min(identity_key) FROM ch)")
add("D11_score_total", FULL, "SELECT k, total FROM ju")

# -- E ---------------------------------------------------------------------
add("E1_identity_dedupe", FOUND, "SELECT identity_key, arg_min(query, {'q': qp, 'p': pos}) AS query, arg_min(pos, {'q': qp, 'p': pos}) AS pos, arg_min(title, {'q': qp, 'p': pos}) AS title FROM pc GROUP BY 1")
_ord = "CASE urg WHEN 'URGENT' THEN 0 WHEN 'HIGH PRIORITY' THEN 1 WHEN 'ACTION REQUIRED' THEN 2 WHEN 'WATCHLIST' THEN 3 WHEN 'UNKNOWN' THEN 4 WHEN 'EXPIRED' THEN 5 ELSE 9 END"


def rank(verdict: str, name: str = "rk") -> str:
    return f"{name} AS (SELECT *, row_number() OVER (ORDER BY total DESC, {_ord}, coalesce(dr, 999), lower(title), identity_key) AS rank FROM ju WHERE verdict = '{verdict}')"


RK = FULL + ", " + rank("accepted")
RW = RK + ", " + rank("watchlist", "rw")
add("E2_ranking", RK, "SELECT rank, identity_key, total AS score, urg AS urgency, dr AS days_remaining FROM rk")
add("E3_action_order", FULL, f"SELECT identity_key, dr AS days_remaining, total AS score {ACC} ORDER BY coalesce(dr, 99), total DESC, identity_key")
_names = ("eligibility", "technical", "delivery", "warranty", "amc", "special")
add("E4_matching_sentences", BC, f"SELECT k, {', '.join(f'array_to_string(q_{n}, {q(chr(32) + chr(124) + chr(32))}) AS {n}' for n in _names)}, q_payment[1] AS payment_terms FROM cl")
add("E5_best_evidence", BC, "SELECT k, pos - 1 AS pos, x.c AS canonical, CASE WHEN x.u THEN 'unclear' ELSE 'confirmed' END AS confidence, x.e AS quotes FROM (SELECT k, unnest(docs) AS x, generate_subscripts(docs, 1) AS pos FROM cl)")
add("E6_first_last_seen", TWO, "SELECT first_seen_on, last_seen_on, count(*) AS n FROM mg GROUP BY ALL")
add("E7_slices", FULL, f"SELECT k, array_to_string(sigs[1:6], ',') AS signals, array_to_string(te[1:5], ',') AS terms, {J('ver[1:8]')} AS points FROM ju")

# -- F ---------------------------------------------------------------------
add("F1_union_counters", FOUND, "SELECT adapter, count(*) AS listings, count(DISTINCT query) AS queries FROM un GROUP BY 1")
add("F2_distinct_ci", B, f"SELECT k, array_to_string({distinct_ci('a')}, '|') AS \"values\" FROM (SELECT k, list_filter(list_transform([title, upper(title), ' ' || delivery_location, buyer_organization, lower(delivery_location), ' '], lambda x: trim(x)), lambda x: x <> '') AS a FROM bids)")
add("F3_flag_sets", FULL, "SELECT flag, count(*) AS n FROM (SELECT unnest(list_distinct(flags)) AS flag FROM ju) GROUP BY 1")
add("F4_category_overlap", BS, f"SELECT k, {J('list_filter(lcats, lambda c: list_contains(' + arr(R.profile['strong'] + R.profile['moderate']) + ', c))')} AS shared FROM scr")

# -- G ---------------------------------------------------------------------
ORACLES["G1_clean"] = f"SELECT doc_id, length(c) AS chars, md5(c) AS digest FROM (SELECT doc_id, trim({_ws}) AS c FROM documents)"
add("G2_normalize_key", B, "SELECT k, trim(regexp_replace(lower(title || ' / ' || delivery_location || ' / ' || bid_number), '[^a-z0-9_]+', ' ', 'g')) AS key FROM bids")
add("G3_strip_label", B, "SELECT k, title AS \"value\" FROM bids")
_fm = {0: "%d-%m-%Y %H:%M:%S", 1: "%d/%m/%Y %H:%M", 2: "%d-%b-%Y", 3: "%-d %B %Y", 4: "%Y-%m-%d %H:%M:%S", 5: "Bid closes on %d-%m-%Y %H:%M IST", 6: "%d-%m-%Y %I:%M %p"}
add("G4_parse_datetime", B, "SELECT k, raw, CASE WHEN raw = 'as per schedule' THEN NULL WHEN k % 8 IN (2, 3) THEN strftime(bid_end_at, '%Y-%m-%d 00:00:00') ELSE strftime(bid_end_at, '%Y-%m-%d %H:%M:%S') END AS parsed FROM (SELECT k, bid_end_at, coalesce(CASE k % 8 "
    + " ".join(f"WHEN {i} THEN strftime(bid_end_at, {q(f)})" for i, f in _fm.items()) + " END, 'as per schedule') AS raw FROM bids)")
add("G5_parse_amount", B, """SELECT k, CASE k % 7 WHEN 0 THEN 'Rs. ' || n || ',50,000.50' WHEN 1 THEN n || '.5 Crore' WHEN 2 THEN '₹' || n || '000' WHEN 3 THEN 'NIL' WHEN 4 THEN 'Not applicable' WHEN 5 THEN n || ' lakhs approx' ELSE 'to be intimated later' END AS raw,
 CASE k % 7 WHEN 0 THEN n * 100000.0 + 50000.5 WHEN 1 THEN (n + 0.5) * 10000000 WHEN 2 THEN n * 1000.0 WHEN 3 THEN 0.0 WHEN 5 THEN n * 100000.0 END::DOUBLE AS amount FROM (SELECT k, k % 90 + 10 AS n FROM bids)""")
add("G6_parse_percentage", B, "SELECT k, CASE k % 3 WHEN 0 THEN (k % 12) + 0.5 WHEN 1 THEN k % 12 END::DOUBLE AS pct FROM bids")
add("G7_parse_quantity", B, "SELECT k, CASE k % 3 WHEN 0 THEN 1000 + k % 60 WHEN 1 THEN k % 60 END::DOUBLE AS number, CASE WHEN k % 3 = 0 THEN 'Units' ELSE '' END AS unit FROM bids")
_ws_of = _ws.replace("replace(text,", "replace(f,")
ORACLES["G8_snippet"] = f"SELECT doc_id, CASE WHEN lo > 0 THEN '…' ELSE '' END || trim({_ws_of}) || CASE WHEN hi < n THEN '…' ELSE '' END AS snippet FROM (SELECT *, substring(text, lo + 1, hi - lo) AS f FROM (SELECT doc_id, text, length(text) AS n, greatest(0, CAST(floor(length(text) / 2) AS INT) - 120) AS lo, least(length(text), CAST(floor(length(text) / 2) AS INT) + 120) AS hi FROM documents))"
add("G9_truncate", B, "SELECT k, CASE WHEN length(title) <= 20 THEN title ELSE rtrim(left(title, 19)) || '…' END AS short FROM bids")
add("G10_identity_key", B, "SELECT k, CASE WHEN bid_number <> '' THEN 'bid:' || bid_number WHEN k % 100 <> 99 THEN 'url:' || left(sha256(source_url), 32) ELSE 'fp:' || left(sha256(title || '|' || buyer_organization || '|' || coalesce(strftime(bid_end_at, '%Y-%m-%d %H:%M:%S+05:30'), 'None')), 32) END AS identity_key FROM bids")
add("G11_bid_number", B, "SELECT k, bid_number AS found FROM bids")
add("G12_days_remaining", B, "SELECT k, CAST(CASE WHEN k % 30 = 5 THEN -1 ELSE dr END AS DOUBLE) AS days FROM base")
add("G13_urgency", B, "SELECT urg AS urgency, count(*) AS n FROM base GROUP BY 1")
add("G14_same_value", B, """SELECT k, abs(coalesce(o, 0) - coalesce(n, 0)) < 0.01 AS same_number, coalesce(nullif(portal_status, ''), '') = ra_enabled AS same_text FROM (SELECT *, CASE WHEN k % 9 = 3 THEN NULL ELSE estimated_value END AS o,
 CASE k % 6 WHEN 0 THEN estimated_value + 0.005 WHEN 3 THEN 0.0 ELSE estimated_value * 1.1 END AS n FROM bids)""")
add("G15_display", B, f"SELECT k, {shown('s')} AS shown, {num('quantity')} AS number FROM (SELECT k, quantity, CASE k % 4 WHEN 0 THEN {ISO('bid_end_at')} WHEN 1 THEN 'not_stated' WHEN 2 THEN '' ELSE title END AS s FROM bids)")
add("G16_change_sentence", CH, f"SELECT identity_key, {LINE} AS line FROM ch")
add("G17_money", B, f"SELECT k, coalesce({rupees('estimated_value')}, 'Not published on GeM') AS \"value\" FROM bids")
add("G18_summary", FULL, f"SELECT k, {SUMMARY} AS summary FROM ju")
EMO = "CASE urg WHEN 'URGENT' THEN '🔴' WHEN 'HIGH PRIORITY' THEN '🟠' WHEN 'ACTION REQUIRED' THEN '🟡' WHEN 'WATCHLIST' THEN '🔭' WHEN 'EXPIRED' THEN '⛔' ELSE '⚪' END"
DQ = "coalesce(CAST(dr AS VARCHAR), '?')"
DN = "coalesce(CAST(dr AS VARCHAR), 'None')"
EH = "CASE estatus WHEN 'not_required' THEN 'NO EMD REQUIRED' WHEN 'required' THEN 'EMD REQUIRED' ELSE 'EMD INFORMATION NOT CLEAR – MANUAL VERIFICATION REQUIRED' END"
ONE = f"{score_text('total')} || '/100 · ' || {EMO} || ' ' || {DQ} || ' days · ' || bid_number || ' · ' || title || ' · ' || {EH}"
DEAD = f"bid_number || ' — closes ' || coalesce(strftime(bid_end_at, '%d %b %Y %H:%M'), '?') || ' (' || {DN} || ' days) — ' || title || ' — score ' || {score_text('total')} || '/100'"
DIS = "array_to_string(gd, ', ')"
LOC = f"""coalesce(nullif(CASE WHEN {DIS} <> '' AND NOT contains(lower(delivery_location), lower({DIS})) THEN CASE WHEN delivery_location <> '' THEN delivery_location || ' (' || {DIS} || ')' ELSE {DIS} END ELSE delivery_location END, ''), '⚠ Not stated') || CASE WHEN gconf <> 'confirmed' THEN '  ⚠ ' || greason ELSE '' END"""
BUY = "CASE WHEN ministry <> '' AND ministry <> buyer_organization THEN buyer_organization || ' · ' || ministry ELSE buyer_organization END"
QTY = f"{g('quantity')} || ' ' || coalesce(nullif(quantity_unit, ''), 'units')"
CLO = "coalesce(strftime(bid_end_at, '%d %B %Y at %H:%M (IST)'), '⚠ Verification Required')"
add("G19_lines", FULL, f"SELECT k, {BUY} AS buyer, {LOC} AS location, {QTY} AS quantity, {CLO} AS closing, {ONE} AS one_liner, {DEAD} AS deadline FROM ju")
ACT = "CASE WHEN total >= 80 THEN 'Open the bid on GeM today, confirm the technical specification and start assembling documents.' WHEN total >= 60 THEN 'Review the bid document on GeM and decide whether to bid.' WHEN len(gaps) > 0 THEN 'Check the eligibility gaps listed above before spending any time on this bid.' ELSE 'Skim the bid on GeM; low priority unless the buyer relationship matters.' END"
add("G20_default_action", FULL, f"SELECT {ACT} AS action, count(*) AS n FROM ju GROUP BY 1")
add("G21_headlines", BC, "SELECT ehead AS emd, shead AS security, sfull AS fully_stated, count(*) AS n FROM cl GROUP BY ALL")
add("G22_security_line", BC, f"SELECT k, {security_line()} AS line FROM cl")
add("G23_json", FULL, "SELECT identity_key, bid_number, urg AS urgency, gconf AS geo_confidence, estatus AS emd_status, cats[1] AS first_category FROM ju WHERE verdict <> 'rejected'")
add("G24_issue_line", ISSUES.split("deg AS")[0].rstrip().rstrip(","), "SELECT line FROM il")

# -- H ---------------------------------------------------------------------
add("H1_emd_status", BC, "SELECT cl.k, estatus AS status, array_to_string(cflags, ' | ') AS flags FROM cl JOIN fl ON fl.k = cl.k")
add("H2_emd_amount", BC, "SELECT k, eamount AS amount FROM cl")
add("H3_emd_conflict", BC, "SELECT k, flag FROM (SELECT k, unnest(cflags) AS flag FROM fl) WHERE flag LIKE 'EMD amount differs%'")
add("H4_payment_mode", BC, "SELECT k, pay AS payment_mode FROM cl")
add("H5_emd_last_date", BC, "SELECT k, ldate AS last_date FROM cl")
add("H6_exemptions", BC, "SELECT k, CASE WHEN msx OR sux THEN 'required' ELSE 'not_stated' END AS available, CASE WHEN msx THEN 'required' ELSE 'not_stated' END AS msme, CASE WHEN sux THEN 'required' ELSE 'not_stated' END AS startup FROM cl")
PROOF = some(["CASE WHEN regexp_matches(d, '(?i)udyam') THEN 'Udyam Registration Certificate' END", "CASE WHEN regexp_matches(d, '(?i)\\bms(?:me|e)\\s+certificate\\b') THEN 'MSME / MSE Certificate' END",
              "CASE WHEN regexp_matches(d, '(?i)\\bnsic\\b') THEN 'NSIC Registration Certificate' END", "CASE WHEN regexp_matches(d, '(?i)dpiit|startup\\s+recognition') THEN 'DPIIT Startup Recognition Certificate' END"])
add("H7_exemption_proofs", BC, f"SELECT k, CASE WHEN msx OR sux THEN {J(PROOF)} ELSE '' END AS proofs FROM cl")
add("H8_instruments", BC, "SELECT k, performance_security, epbg, security_deposit FROM cl")
add("H9_security_percentage", BC, "SELECT k, spct AS percentage FROM cl")
add("H10_security_amount", BC, "SELECT k, TRY_CAST(replace(samt, ',', '') AS DOUBLE) AS amount FROM cl")
add("H11_validity_and_timeline", BC, "SELECT k, sval AS validity, stime AS timeline FROM cl")
add("H12_security_exemption", BC, "SELECT k, coalesce(sex, '') AS exemption FROM cl")
ORACLES["H13_sentences"] = f"SELECT doc_id, count(*) AS n, sum(length(s)) AS chars, max(s) AS last FROM (SELECT doc_id, unnest(string_split(regexp_replace(c, '([.;:])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS s FROM (SELECT doc_id, trim({_ws}) AS c FROM documents)) WHERE s <> '' GROUP BY 1"
add("H14_required_documents", BC, "SELECT x.c AS canonical, x.n AS name, CASE WHEN x.u THEN 'unclear' ELSE 'confirmed' END AS confidence, count(*) AS n FROM (SELECT unnest(docs) AS x FROM cl) GROUP BY ALL")
add("H15_cue_counts", BC, f"SELECT {', '.join(f'sum(len(q_{n})) AS {n}' for n in _names)}, count(q_payment[1]) AS payment FROM cl")
add("H16_requirement_flags", BC, "SELECT k, flag FROM (SELECT k, unnest(cflags) AS flag FROM fl) WHERE flag LIKE 'Required-documents list%' OR flag LIKE 'No specific document%'")
_tp = "(?i)annual\\s+turnover[^.\\n]{0,60}?(?:rs\\.?|inr|₹)?\\s*([\\d,]+(?:\\.\\d+)?)\\s*(lakh?s?|crores?|cr)?"
add("H17_turnover_and_years", BC, f"""SELECT k, list_filter(list_transform(q_eligibility, lambda s: TRY_CAST(replace(regexp_extract(s, {q(_tp)}, 1), ',', '') AS DOUBLE) * CASE lower(regexp_extract(s, {q(_tp)}, 2)) WHEN 'lakh' THEN 100000 WHEN 'lakhs' THEN 100000 WHEN 'crore' THEN 10000000 ELSE 1 END), lambda v: v IS NOT NULL)[1] AS turnover,
 list_filter(list_transform(q_eligibility, lambda s: TRY_CAST(regexp_extract(s, '(\\d{{1,2}})\\s*years?\\s+of\\s+(?:past\\s+)?experience', 1) AS DOUBLE)), lambda v: v IS NOT NULL)[1] AS years FROM cl""")

# -- I ---------------------------------------------------------------------
add("I1_classification", BD, f"SELECT k, related, conf AS confidence, {J('cats')} AS categories, {J('sigs')} AS signals, {J('vetoed')} AS vetoed_by, creason AS reason FROM ccls")
add("I2_kind", BD, "SELECT k, kind FROM ccls")
_init = "list_transform(ds, lambda x: array_to_string(list_transform(string_split(x, ' '), lambda w: upper(left(w, 1)) || lower(w[2:])), ' '))"
add("I3_region", BG, f"SELECT k, in_region, gconf AS confidence, {J('wh')} AS fields, {J(_init)} AS districts, greason AS reason FROM ggeo")
_amb = base() + ", alt AS (SELECT * REPLACE (concat_ws(', ', CASE k % 3 WHEN 0 THEN 'Mango' WHEN 1 THEN 'JH, chas' END, CASE WHEN k % 2 = 0 THEN delivery_location END) AS delivery_location) FROM base)," + located("a", "alt", False)
add("I4_ambiguous_places", _amb, f"SELECT k, in_region, {J('te')} AS terms FROM ageo")
add("I5_substring_places", BG, "SELECT nw AS nationwide, in_region, count(*) AS n, count(*) FILTER (contains(greason, 'locations point to')) AS elsewhere FROM ggeo GROUP BY ALL")

# -- J ---------------------------------------------------------------------
_parts = ("product_match", "location_match", "business_capability", "document_complexity", "deadline_urgency", "commercial_potential", "procurement_complexity")
for _i, _p in enumerate(_parts, start=1):
    add(f"J{_i}_{_p}", FULL, f"SELECT k, s{_i} AS points, {float(R.decision['weights'][_p])}::DOUBLE AS max_points, w{_i} AS reason FROM ju")
add("J8_bands", FULL, "SELECT k, band, rank_label, bucket FROM ju")
_titles = ("Product Match", "Location Match", "Business Capability", "Document Complexity", "Deadline Urgency", "Commercial Potential", "Procurement Complexity")
COMP = "[" + ", ".join(f"'{t}: ' || {score_text(f's{i}')} || '/{R.decision['weights'][p]} — ' || w{i}" for i, (t, p) in enumerate(zip(_titles, _parts), start=1)) + "]"
add("J9_component_lines", FULL, f"SELECT k, array_to_string({COMP}, chr(10)) AS lines FROM ju")

# -- K ---------------------------------------------------------------------
_k = {
    "K1_category": ("sup || gaps || ver", ("Product/service category%", "Category is%", "Whether we can%")),
    "K2_location": ("sup || ver", ("Work location is%", "Service coverage%", "Actual work location%")),
    "K3_oem": ("gaps || ver", ("OEM Authorization%",)),
    "K4_turnover": ("gaps || sup || ver", ("%urnover requirement%",)),
    "K5_experience_years": ("gaps || sup || ver", ("Requirement of % years%", "%-year experience%", "% years' experience required%")),
    "K6_past_supply": ("gaps || sup || ver", ("Past %", "We have prior%")),
    "K7_emd_funding": ("gaps || sup || ver", ("Ability to fund%", "EMD %", "No EMD%", "MSME EMD%")),
    "K8_security": ("ver", ("Performance security%",)),
}
for _name, (_lists, _likes) in _k.items():
    add(_name, FULL, f"SELECT k, point FROM (SELECT k, unnest({_lists}) AS point FROM ju) WHERE {' OR '.join(f'point LIKE {q(x)}' for x in _likes)}")
add("K10_verdict", FULL, "SELECT k, grade AS match_level, fit AS verdict, len(sup) AS supporting, len(gaps) AS gaps, len(ver) AS verify FROM ju")
KNOWN = dict(R.profile, annual_turnover_inr=2_000_000, years_in_business=6, can_arrange_emd_upto_inr=50_000, msme_registered=True, government_supply_experience=False, oem_held=["HP"], avoid_keywords=["all-in-one"])
add("K10_known_profile", base() + "," + screen() + "," + analysed("", KNOWN), "SELECT k, grade AS match_level, fit AS verdict, array_to_string(sup, ' | ') AS supporting, array_to_string(gaps, ' | ') AS gaps, len(ver) AS verify FROM ju")
add("K9_avoid_list", base() + "," + screen() + "," + analysed("", KNOWN), "SELECT k, point FROM (SELECT k, unnest(gaps) AS point FROM ju) WHERE point LIKE 'Matches an avoid-list%'")

# -- L ---------------------------------------------------------------------
add("L1_amendment_feed", CH, "SELECT 0 AS batch, 'new' AS what, count(*) AS n FROM d1 UNION ALL SELECT 1, action, count(*) FROM mg WHERE action <> 'kept' GROUP BY 2 UNION ALL SELECT 1, field_name, count(*) FROM ch GROUP BY 2")

# -- M ---------------------------------------------------------------------
def section(name: str, seq: str, kind: str, text: str, frm: str) -> str:
    return f"SELECT '{name}' AS section, {seq} AS seq, {kind} AS kind, {text} AS text FROM {frm}"


_exec = [
    ("'Tenders in today''s report: ' || total", "true"), ("'Strong opportunities (80–100): ' || strong", "true"), ("'Good opportunities (60–79): ' || good", "true"),
    ("'Urgent deadlines (closing in 0–2 days): ' || urgent", "true"), ("'Tenders requiring EMD: ' || with_emd", "true"), ("'Tenders with no EMD: ' || without_emd", "true"),
    ("'Tenders where EMD is unclear: ' || emd_unclear || ' ⚠'", "emd_unclear > 0"), ("'On the future watchlist: ' || watch", "watch > 0"), ("'Amendments detected since the last run: ' || amended", "amended > 0"),
]
_lines = some([f"CASE WHEN {t} THEN {x} END" for x, t in _exec])
add("M1_executive_summary", CH, f", c AS (SELECT {COUNTS} {ACC}), c2 AS (SELECT *, (SELECT count(*) FROM ju WHERE verdict = 'watchlist') AS watch, (SELECT count(*) FROM ch) AS amended FROM c), l AS (SELECT {_lines} AS ls FROM c2) "
    "SELECT 'executive_summary' AS section, CAST(i - 1 AS VARCHAR) AS seq, 'keyvalue' AS kind, t AS text FROM (SELECT unnest(ls) AS t, generate_subscripts(ls, 1) AS i FROM l)")
add("M2_data_quality", FULL + "," + ISSUES, section("data_quality", "'0.' || (-n)", "'bullet'", f"n || ' — ' || CASE reason {_labels_of} ELSE reason END", "rj") + " UNION ALL " + section("data_quality", "'1.0'", "'bullet'", "line", "il") + " UNION ALL " + section("data_quality", "'2.0'", "'bullet'", "mode", "deg")
    + f""" UNION ALL SELECT 'data_quality', '-1.0', 'paragraph', 'Run run-1 · {N_QUERIES} search terms · ' || (SELECT count(*) FROM scr) || ' bids seen · ' || (SELECT count(*) FROM ju WHERE bid_number <> '') || ' detail pages read · ' || (SELECT count(*) FROM documents) || ' documents analysed.'""")
_bp = "CASE WHEN total >= 80 THEN 1 WHEN total >= 60 THEN 2 WHEN total >= 40 THEN 3 ELSE 4 END"
add("M3_priority", RK, section("priority", "p || '.0'", "'heading'", "bucket || ' (' || n || ')'", f"(SELECT bucket, {_bp} AS p, count(*) AS n FROM rk GROUP BY ALL)") + " UNION ALL " + section("priority", f"{_bp} || '.' || rank", "'bullet'", ONE, "rk"))
add("M4_urgent", RK, section("urgent", "CASE WHEN urg = 'URGENT' THEN 0 ELSE 1 END || '.' || rank", "'bullet'", DEAD, "rk WHERE urg IN ('URGENT', 'HIGH PRIORITY')"))


def kv(key: str, value: str, test: str = "true") -> str:
    return f"CASE WHEN {test} THEN [{{'k': 'keyvalue', 't': '{key}: ' || {value}}}] ELSE [] END"


def bl(head: str, items: str) -> str:
    return f"CASE WHEN len({items}) > 0 THEN [{{'k': 'paragraph', 't': {q(head)}}}] || list_transform({items}, lambda i: {{'k': 'bullet', 't': i}}) ELSE [] END"


def warn(items: str) -> str:
    return f"list_transform({items}, lambda w: '⚠ ' || w)"


_dep = some([f"'Amount: ' || coalesce({rupees('eamount')}, '⚠ Verification Required')", "'Payment: ' || pay", "'Last date: ' || ldate", "CASE WHEN msx THEN 'MSME exemption appears available' END", "CASE WHEN sux THEN 'Startup exemption appears available' END",
             f"CASE WHEN (msx OR sux) AND len({PROOF}) > 0 THEN 'Exemption proof: ' || array_to_string({PROOF}, ', ') END"])
_docl = "CASE WHEN len(docs) > 0 THEN list_transform(docs, lambda x: x.n || CASE WHEN x.u THEN ' ⚠ Verification Required' ELSE '' END) ELSE ['⚠ Not stated in the source we could read — check the bid on GeM'] END"
_blocks = " || ".join(f"({x})" for x in [
    kv("Bid Number", "coalesce(nullif(bid_number, ''), '⚠ Not available')"), kv("Buyer", BUY), kv("Location", LOC), kv("Product / Service Required", SUMMARY),
    kv("Type", "CASE kind WHEN 'product_supply' THEN 'Product supply' WHEN 'service' THEN 'Service contract' WHEN 'supply_and_service' THEN 'Supply + service' ELSE 'Type not clear' END"),
    kv("Quantity / Scope", QTY), kv("Closing Date", CLO), kv("Days Remaining", "coalesce(dr || ' days', '⚠ Verification Required')"), kv("Priority", f"{EMO} || ' ' || urg"),
    kv("Estimated Value", f"coalesce({rupees('estimated_value')}, 'Not published on GeM')"), kv("EMD", "ehead"), f"CASE WHEN estatus = 'required' THEN list_transform({_dep}, lambda i: {{'k': 'bullet', 't': i}}) ELSE [] END",
    kv("Performance Security / ePBG", security_line()), bl("Required Documents", _docl), bl("Important Eligibility Requirements", "q_eligibility"), bl("Key Technical Requirements", "q_technical"),
    bl("Delivery / Warranty / AMC Requirements", "(q_delivery || q_warranty || q_amc)"), kv("Payment Terms", "q_payment[1]", "len(q_payment) > 0"), bl("Special Conditions", "q_special"),
    kv("AI Opportunity Score", f"{score_text('total')} || ' / 100  ' || CASE band WHEN 'STRONG OPPORTUNITY' THEN '🟢' WHEN 'GOOD OPPORTUNITY' THEN '🟡' WHEN 'REVIEW REQUIRED' THEN '🟠' WHEN 'LOW PRIORITY' THEN '🔴' ELSE '' END || ' ' || band"),
    f"list_transform({COMP}, lambda i: {{'k': 'bullet', 't': i}})", kv("Match Assessment", "CASE grade WHEN 'HIGH' THEN '🟢' WHEN 'MEDIUM' THEN '🟡' WHEN 'LOW' THEN '🔴' ELSE '⚪' END || ' ' || grade || ' — ' || fit"),
    bl("Why this could suit us", "sup"), bl("Requirement gaps", "gaps"), bl("To verify before bidding", warn("ver")), bl("Verification Points", warn("list_distinct_keep")),
    kv("Recommended Next Action", ACT), kv("Official GeM Source", "source_url")]).replace("list_distinct_keep", "flags")
add("M5_detailed", RK, section("detailed", "rank || '.0'", "'heading'", "'TENDER #' || rank || ' — ' || title", "rk") + f" UNION ALL SELECT 'detailed', rank || '.' || i, x.k, x.t FROM (SELECT rank, unnest(bs) AS x, generate_subscripts(bs, 1) AS i FROM (SELECT rank, {_blocks} AS bs FROM rk))")
_ep = "CASE estatus WHEN 'not_required' THEN 0 WHEN 'required' THEN 1 ELSE 2 END"
add("M6_emd_summary", RK, section("emd_summary", "p || '.0'", "'paragraph'", "CASE p WHEN 0 THEN '✅ No EMD required (' || n || ')' WHEN 1 THEN '💰 EMD required (' || n || ')' ELSE '⚠ EMD not clearly stated (' || n || ') — verify manually' END", f"(SELECT {_ep} AS p, count(*) AS n FROM rk GROUP BY 1)")
    + " UNION ALL " + section("emd_summary", f"{_ep} || '.' || rank", "'bullet'", f"CASE WHEN estatus = 'required' THEN bid_number || ' — ' || coalesce({rupees('eamount')}, '⚠ Verification Required') || ' — ' || title ELSE bid_number || ' — ' || title END", "rk")
    + " UNION ALL " + section("emd_summary", "'1.9223372036854775807'", "'paragraph'", f"'Total EMD across these tenders: ' || {rupees('s')} || ' (before any MSME/Startup exemption).'", "(SELECT sum(eamount) AS s FROM rk WHERE estatus = 'required') WHERE s > 0"))
add("M7_documents_summary", FULL, section("documents_summary", "CAST(-n AS VARCHAR)", "'bullet'", "name || ' — needed by ' || n || ' of ' || total || ' tenders'", DEMAND))
add("M8_risks", RK, section("risks", "rank || '.0'", "'paragraph'", "bid_number || ' — ' || title", "rk WHERE len(gaps) > 0") + " UNION ALL SELECT 'risks', rank || '.' || i, 'bullet', x FROM (SELECT rank, unnest(gaps) AS x, generate_subscripts(gaps, 1) AS i FROM rk)")
add("M9_actions", RK, section("actions", "coalesce(dr, 99) || '.' || rank", "'bullet'", f"{EMO} || ' ' || bid_number || ' (' || {DQ} || ' days) — ' || {ACT}", "rk"))
add("M10_watchlist", RW, section("watchlist", "CAST(rank AS VARCHAR)", "'bullet'", f"{score_text('total')} || '/100 · ' || bid_number || ' · closes in ' || {DN} || ' days · ' || title", "rw"))
add("M11_change_log", CH, f"SELECT section, kind, text, count(*) AS n FROM (SELECT 'change_log' AS section, 'bullet' AS kind, {LINE} AS text FROM ch UNION ALL SELECT 'change_log', 'paragraph', coalesce(z.bid_number || ' — ' || z.title, i) FROM (SELECT DISTINCT identity_key AS i FROM ch) LEFT JOIN zju z ON z.identity_key = i AND z.verdict <> 'rejected') GROUP BY ALL")
add("M12_references", RW, section("references", "p || '.' || rank", "'bullet'", "bid_number || ' — ' || source_url", "(SELECT 0 AS p, * FROM rk UNION ALL SELECT 1, * FROM rw)"))

_numbered = f"""SELECT 'change_log' AS section, n || '.' || i AS seq, kind, text FROM (SELECT dense_rank() OVER (ORDER BY identity_key) AS n, CASE WHEN kind = 'paragraph' THEN 0 ELSE row_number() OVER (PARTITION BY identity_key, kind ORDER BY text) END AS i, kind, text FROM
 (SELECT identity_key, 'bullet' AS kind, {LINE} AS text FROM ch UNION ALL SELECT i, 'paragraph', coalesce(z.bid_number || ' — ' || z.title, i) FROM (SELECT DISTINCT identity_key AS i FROM ch) LEFT JOIN zju z ON z.identity_key = i AND z.verdict <> 'rejected'))"""
_report = ["M1_executive_summary", "M2_data_quality", "M3_priority", "M4_urgent", "M5_detailed", "M6_emd_summary", "M7_documents_summary", "M8_risks", "M9_actions", "M10_watchlist", None, "M12_references"]
_sections = [f"SELECT {i} AS no, section, seq, kind, text FROM ({SELECTS[n] if n else _numbered})" for i, n in enumerate(_report)]
add("M_report_lines", f"{CH}, {ISSUES}, {rank('accepted')}, {rank('watchlist', 'rw')}",
    f"SELECT row_number() OVER (ORDER BY no, list_transform(string_split(seq, '.'), lambda x: CAST(x AS BIGINT)), text, kind) AS line, section, kind, text FROM ({' UNION ALL '.join(_sections)})")

# -- the whole run ----------------------------------------------------------
def card_rows(view: str = "bids") -> str:
    """SELECT of what the listing cards of ``view`` say; text and head columns as the parser leaves them."""
    addr = "trim(buyer_organization || ', ' || delivery_location)"
    number = "'GEM/2026/B/' || (7000000 + k)"
    text = clean(f"CASE WHEN k % 23 = 22 THEN '' WHEN k % 17 = 16 THEN 'View bid' ELSE {number} END || CASE WHEN k % 17 = 16 THEN ' Ref: gem/2026/b/' || (7000000 + k) ELSE '' END || ' Items: ' || title || ' Quantity: ' || (1 + k % 60) || ' Nos Category: Lot ' || (k % 5) || ' Department Name And Address: ' || {addr} || ' Start Date: 01-09-2026 09:00:00 End Date: ' || coalesce(strftime(bid_end_at, '%d-%m-%Y %H:%M:%S'), 'as per schedule')")
    return f"""SELECT k, 'portal' AS adapter, {number} AS bid_number, 'https://bidplus.gem.gov.in/showbidDocument/' || (7000000 + k) AS source_url, title, title AS item_description, 'Lot ' || (k % 5) AS category,
 {addr} AS buyer_organization, {addr} AS buyer_address, '' AS ministry, CAST(1 + k % 60 AS DOUBLE) AS quantity, 'Nos' AS quantity_unit, bid_end_at, {text} AS listing_text FROM {view} WHERE k % 17 = 16 OR k % 23 <> 22"""


#: Columns that a listing lacks, as the analysis sees them then.
BARE = "'' AS delivery_location, '' AS portal_status, '' AS ra_enabled, CAST(NULL AS DOUBLE) AS estimated_value, CAST(NULL AS DOUBLE) AS portal_emd_amount, CAST(NULL AS DOUBLE) AS portal_epbg_pct, '' AS doc_text"


def listed_out(p: str, source: str) -> str:
    """CTEs {p}scr: the screen of listing rows (k, identity_key, dr among the columns)."""
    return f"""{classified(p + 'l', source, False, LISTING_SAYS, LISTING_HEAD)},{located(p + 'lg', source, False, listing=True)},
{p}scr AS (SELECT b.*, CASE WHEN dr < 0 THEN 'expired' WHEN dr > 60 THEN 'outside_10_day_window' WHEN NOT c.related THEN 'not_it_related' WHEN NOT gg.in_region THEN 'not_jharkhand' END AS screen_reason
  FROM {source} b JOIN {p}lcls c ON c.k = b.k JOIN {p}lggeo gg ON gg.k = b.k)"""


RUN = f"""
bids AS ({V['bids']}),{DETAIL_CTE},
pg AS (SELECT source_url AS page, {', '.join(f"max(value) FILTER (field = '{c}') AS d_{c}" for c in ('bid_number', 'bid_end_at', 'ministry', 'buyer_organization', 'buyer_address', 'quantity', 'estimated_value', 'emd_amount', 'epbg_percentage', 'ra_enabled'))} FROM f GROUP BY 1),
nt AS (SELECT -1 - k AS k, 'search' AS adapter, '' AS bid_number, link AS source_url, title, {clean('snippet')} AS item_description, '' AS category, '' AS buyer_organization, '' AS buyer_address, '' AS ministry,
  CAST(NULL AS DOUBLE) AS quantity, '' AS quantity_unit, CAST(NULL AS TIMESTAMP) AS bid_end_at, title || ' ' || {clean('snippet')} AS listing_text FROM ({V['notices']}) WHERE {official('link')}),
rc AS (SELECT *, {BARE} FROM ({card_rows()} UNION ALL SELECT * FROM nt)),
rb AS (SELECT *, {KEY} AS identity_key, {days('bid_end_at', NOW)} AS dr FROM rc),{listed_out('r', 'rb')},
rm AS (SELECT s.k, s.adapter, s.identity_key AS first_key, s.source_url, coalesce(d_bid_number, s.bid_number) AS bid_number, s.title, s.item_description, s.category, coalesce(d_buyer_organization, s.buyer_organization) AS buyer_organization,
  coalesce(d_buyer_address, s.buyer_address) AS buyer_address, coalesce(d_ministry, '') AS ministry, coalesce(CAST(regexp_extract(d_quantity, '\\d+') AS DOUBLE), s.quantity) AS quantity,
  coalesce(nullif(regexp_extract(d_quantity, '\\d+\\s*([A-Za-z./]+)', 1), ''), s.quantity_unit) AS quantity_unit, coalesce(try_strptime(d_bid_end_at, '%d-%m-%Y %H:%M:%S'), s.bid_end_at) AS bid_end_at, s.listing_text,
  '' AS delivery_location, '' AS portal_status, coalesce(d_ra_enabled, '') AS ra_enabled, TRY_CAST(replace(regexp_extract(d_estimated_value, '[\\d,]+'), ',', '') AS DOUBLE) AS estimated_value,
  TRY_CAST(replace(regexp_extract(d_emd_amount, '[\\d,]+'), ',', '') AS DOUBLE) AS portal_emd_amount, TRY_CAST(d_epbg_percentage AS DOUBLE) AS portal_epbg_pct,
  page, CASE WHEN page IS NOT NULL AND fi.text <> '' THEN chr(10) || '===== Bid Document (bid_document) =====' || chr(10) || fi.text ELSE '' END AS doc_text
  FROM rscr s LEFT JOIN pg ON page = s.source_url LEFT JOIN ({V['files']}) fi ON fi.url = page WHERE screen_reason IS NULL),
rk AS (SELECT *, {KEY} AS identity_key FROM rm),
rw AS (SELECT identity_key, array_to_string(list_sort(list(DISTINCT adapter)), ',') AS discovered_via, count(*) AS sightings, arg_min(k, adapter) AS k FROM rk GROUP BY 1),
rsl AS (SELECT rk.*, rw.discovered_via, rw.sightings, {days('bid_end_at', NOW)} AS dr, {urgency(days('bid_end_at', NOW))} AS urg FROM rk JOIN rw USING (k)),{judged('r', listing=True)}"""
add("run_report", RUN, f"""SELECT identity_key, first_key, discovered_via, sightings, bid_number, title, category, buyer_address, quantity, quantity_unit, estimated_value, {at('bid_end_at')} AS bid_end_at, greason AS region,
 estatus AS emd_status, verdict, rejected_reason, urg AS urgency, total AS score, len(docs) AS documents FROM rju""")
add("run_report_counts", RUN, """SELECT what, which, count(*) AS n FROM (SELECT 'candidate' AS what, adapter AS which FROM rb UNION ALL SELECT 'screened out', screen_reason FROM rscr WHERE screen_reason IS NOT NULL
 UNION ALL SELECT 'verdict', verdict FROM rju UNION ALL SELECT 'detail page', 'read' FROM (SELECT DISTINCT page FROM rju WHERE page IS NOT NULL)
 UNION ALL SELECT 'document', 'read' FROM (SELECT DISTINCT page FROM rju WHERE page IS NOT NULL)) GROUP BY ALL""")

# -- the listing stream -----------------------------------------------------
add("L1_listing_stream", f"""
bids AS ({V['bids']}), nbids AS ({views.sql('next_day', DUCK)}),
c1 AS ({card_rows()}), c2 AS ({card_rows('nbids')}),
lc AS (SELECT coalesce(c2.k, c1.k) AS k, {', '.join(f"CASE WHEN c2.k IS NULL THEN c1.{c} ELSE c2.{c} END AS {c}" for c in ('bid_number', 'source_url', 'title', 'item_description', 'category', 'buyer_organization', 'buyer_address', 'ministry', 'quantity', 'quantity_unit', 'bid_end_at', 'listing_text'))},
  coalesce(c2.k IS NOT NULL AND c1.bid_end_at IS DISTINCT FROM c2.bid_end_at, false) AS moved, {BARE} FROM c1 LEFT JOIN c2 ON c2.k = c1.k),
sb AS (SELECT *, {KEY} AS identity_key, {days('bid_end_at', NOW_2)} AS dr, {urgency(days('bid_end_at', NOW_2))} AS urg FROM lc),{listed_out('s', 'sb')},
ssl AS (SELECT * FROM sscr WHERE screen_reason IS NULL),{judged('s', listing=True)},
own AS (SELECT identity_key, CASE WHEN moved THEN 'updated' ELSE 'new' END AS action, CASE WHEN moved THEN 2 ELSE 1 END AS judged FROM sb)""",
    """SELECT o.identity_key, action, coalesce(j.verdict, 'screened out') AS verdict, CASE WHEN j.verdict IS NULL THEN s.screen_reason ELSE j.rejected_reason END AS reason, coalesce(j.urg, s.urg) AS urgency, j.total AS score, judged
 FROM own o JOIN sscr s USING (identity_key) LEFT JOIN sju j USING (identity_key)""")

# -- N ---------------------------------------------------------------------
add("N1_own_source", FOUND, """, pg AS (SELECT 'bid:GEM/2026/B/' || (7000000 + k) AS identity_key, 'pages' AS adapter FROM bids WHERE k % 17 = 16 OR k % 23 <> 22), u2 AS (SELECT * FROM pg UNION ALL SELECT identity_key, adapter FROM sc),
w AS (SELECT identity_key, array_to_string(list_sort(list(DISTINCT adapter)), ',') AS discovered_via, count(*) AS n FROM u2 GROUP BY 1) SELECT discovered_via, count(*) AS bids, sum(n) AS sightings FROM w GROUP BY 1""")
_ker = dict(R.geography, state="Kerala", state_aliases=["kerala"], districts=["Thiruvananthapuram", "Kochi"], localities=["Kovalam"], ambiguous_localities=[], local_organisations=["Cochin Shipyard"])
add("N2_own_rules", base() + "," + located("n", "base", True, _ker), f"SELECT in_region, gconf AS confidence, {J(_init)} AS districts, count(*) AS n FROM ngeo GROUP BY ALL")
_each = "SELECT k, '{0}' AS profile, grade AS match_level, fit, array_to_string(gaps, ' | ') AS gaps, array_to_string(sup, ' | ') AS supporting, total AS score, verdict, rejected_reason FROM {1}ju"
add("N3_parameters", FULL + "," + base("x") + "," + screen("x") + "," + analysed("x", KNOWN), _each.format("default", "") + " UNION ALL " + _each.format("known", "x"))
add("verdict_summary", FULL, "SELECT verdict, coalesce(rejected_reason, '') AS reason, urg AS urgency, count(*) AS bids, CAST((20 * sum(CAST(round(total * 10) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS mean_score, sum(CASE WHEN estatus = 'required' THEN eamount END) AS emd_total FROM ju GROUP BY ALL")
