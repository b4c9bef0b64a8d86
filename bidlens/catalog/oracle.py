"""Checking SQL for the queries, for an engine with RE2 regexes (no look-around).

Word boundaries are written as consumed neighbours on padded text, and the
clause rule ("a full stop ends it when a letter follows") as a line break put
into the text beforehand. The rule tables fill in the lists of terms; the logic
is plain SQL over the same base tables.
"""

from __future__ import annotations

import re

from bidlens.plans import views
from bidlens.rules import load_rules

R = load_rules()
G = R.geography
NOW, NOW_2 = views.NOW, "2026-09-07 08:30:00"
ORACLES: dict[str, str] = {}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def some(cases: list[str]) -> str:
    """List of the non-null values of the given expressions."""
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)" if cases else "CAST([] AS VARCHAR[])"


def term_regex(term: str) -> str:
    return re.escape(term.lower()).replace(r"\-", r"[\s\-]?").replace(r"\ ", r"\s+")


def hit(text: str, term: str) -> str:
    return f"regexp_matches({text}, {q('[^a-z0-9]' + term_regex(term) + '[^a-z0-9]')})"


def hits(text: str, terms) -> str:
    return some([f"CASE WHEN {hit(text, t)} THEN {q(t.lower())} END" for t in terms])


def any_hit(text: str, terms) -> str:
    return "(" + " OR ".join(hit(text, t) for t in terms) + ")"


def n_hits(text: str, terms) -> str:
    return "(" + " + ".join(f"CAST({hit(text, t)} AS INT)" for t in terms) + ")"


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def rupees(x: str) -> str:
    return f"('₹' || format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)))"


def g(x: str) -> str:
    """%g for the magnitudes in use."""
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


def score_text(x: str) -> str:
    return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"


KEY = "CASE WHEN bid_number <> '' THEN 'bid:' || upper(trim(bid_number)) ELSE 'url:' || left(sha256(source_url), 32) END"


def days(at: str, now: str) -> str:
    return (
        f"CASE WHEN CAST({at} AS DATE) = DATE '{now[:10]}' AND {at} < TIMESTAMP '{now}' THEN -1 "
        f"ELSE date_diff('day', DATE '{now[:10]}', CAST({at} AS DATE)) END"
    )


def urgency(d: str) -> str:
    bands = " ".join(f"WHEN {d} BETWEEN {b['min']} AND {b['max']} THEN {q(b['label'])}" for b in R.deadline["bands"])
    return f"CASE WHEN {d} IS NULL THEN 'UNKNOWN' WHEN {d} < 0 THEN 'EXPIRED' {bands} ELSE 'WATCHLIST' END"


HOSTS = R.portal["allowed_hosts"]


def official(url: str) -> str:
    host = f"lower(regexp_extract({url}, '(?i)^(?:[a-z][a-z0-9+.\\-]*:)?//(?:[^/?#]*@)?([^/?#:@]*)', 1))"
    return "(" + " OR ".join(f"{host} = {q(h)} OR ends_with({host}, {q('.' + h)})" for h in HOSTS) + ")"


def group_columns(text: str) -> str:
    out = []
    for i, gr in enumerate(R.groups):
        out.append(f"{hits(text, gr['signals'])} AS h{i}")
        out.append(f"{hits(text, gr['negatives'])} AS n{i}")
    return ", ".join(out)


def veto(i: int) -> str:
    return f"(len(h{i}) > 0 AND len(n{i}) > 0 AND len(n{i}) >= len(h{i}))"


def kept(i: int) -> str:
    return f"(len(h{i}) > 0 AND NOT {veto(i)})"


ALL_SIGNALS = [t for gr in R.groups for t in gr["signals"]]
SUPPLY, SERVICE = R.taxonomy["supply_verbs"], R.taxonomy["service_verbs"]


#: Columns that say what a bid is, and those of its headline; listings have more of them than the bids' view.
SAYS, HEAD = ("title", "buyer_organization"), ("title",)
LISTING_SAYS, LISTING_HEAD = ("title", "category", "item_description", "buyer_organization", "listing_text"), ("title", "category", "item_description")


def classified(p: str, source: str, doc: bool, says=SAYS, heads=HEAD) -> str:
    """CTEs {p}h, {p}g, {p}c: classification of ``source`` with or without text."""
    parts = ", ".join(f"nullif({c}, '')" for c in says) + (", nullif(doc_text, '')" if doc else "")
    n = len(R.groups)
    product = " OR ".join(f"(k{i})" for i in range(n) if R.groups[i]["kind"] == "product")
    service = " OR ".join(f"(k{i})" for i in range(n) if R.groups[i]["kind"] == "service")
    head = f"' ' || trim(regexp_replace(lower(concat_ws(' ', {', '.join(heads)})), '[^a-z0-9_]+', ' ', 'g')) || ' '"
    return f"""
{p}h AS (SELECT k, ' ' || lower({clean(f"concat_ws(' ', {parts})")}) || ' ' AS h, {head} AS hd FROM {source}),
{p}g AS (SELECT k, h, hd, {group_columns('h')}, {hits('h', R.taxonomy['hard_vetoes'])} AS hv FROM {p}h),
{p}k AS (SELECT *, {', '.join(f'{kept(i)} AS k{i}' for i in range(n))} FROM {p}g),
{p}c AS (SELECT k,
  {some([f"CASE WHEN k{i} THEN {q(R.groups[i]['label'])} END" for i in range(n)])} AS cats,
  flatten([{', '.join(f"CASE WHEN k{i} THEN h{i} ELSE [] END" for i in range(n))}]) AS sigs,
  hv || {some([f"CASE WHEN {veto(i)} THEN {q(R.groups[i]['label'] + ' (')} || array_to_string(n{i}, ', ') || ')' END" for i in range(n)])} AS vetoed,
  list_has_any(flatten([{', '.join(f"CASE WHEN k{i} THEN h{i} ELSE [] END" for i in range(n))}]), {hits('hd', ALL_SIGNALS)}) AS in_head,
  CASE WHEN NOT ({' OR '.join(f'(k{i})' for i in range(n))}) THEN 'unknown'
    WHEN {any_hit('hd', SUPPLY)} AND {any_hit('hd', SERVICE)} THEN 'supply_and_service'
    WHEN {any_hit('hd', SUPPLY)} THEN 'product_supply' WHEN {any_hit('hd', SERVICE)} THEN 'service'
    WHEN {n_hits('h', SERVICE)} > {n_hits('h', SUPPLY)} THEN 'service'
    WHEN {n_hits('h', SUPPLY)} > {n_hits('h', SERVICE)} THEN 'product_supply'
    WHEN ({service}) AND NOT ({product}) THEN 'service' WHEN ({product}) AND NOT ({service}) THEN 'product_supply' ELSE 'unknown' END AS kind
  FROM {p}k),
{p}cls AS (SELECT *, len(cats) > 0 AS related,
  CASE WHEN len(cats) > 0 AND in_head THEN 'confirmed' WHEN len(cats) > 0 THEN 'inferred' WHEN len(vetoed) > 0 THEN 'confirmed' ELSE 'not_found' END AS conf,
  CASE WHEN len(cats) > 0 THEN 'Matched ' || array_to_string(cats, ', ') || ' on ' || CASE WHEN in_head THEN 'title/category' ELSE 'tender documents' END || ' via: ' || array_to_string(sigs, ', ')
    WHEN len(vetoed) > 0 THEN 'No IT signal matched; vetoed by ' || array_to_string(vetoed, ', ')
    ELSE 'No IT product or service signal found in title, category or documents' END AS creason FROM {p}c)"""


def places(text: str, terms) -> str:
    alt = "|".join(term_regex(t) for t in sorted(terms, key=len, reverse=True))
    doubled = f"(' ' || regexp_replace({text}, '([^A-Za-z0-9])', '\\1\\1', 'g') || ' ')"
    return f"list_transform(regexp_extract_all({doubled}, {q('(?i)[^a-z0-9](' + alt + ')[^a-z0-9]')}, 1), lambda x: regexp_replace(x, '\\s+', ' ', 'g'))"


def distinct_ci(x: str) -> str:
    return f"list_filter({x}, lambda v, i: list_position(list_transform({x}, lambda w: lower(w)), lower(v)) = i)"


def located(p: str, source: str, doc: bool, geo=G, location: str = "delivery_location", listing: bool = False) -> str:
    """CTEs {p}f, {p}m, {p}geo: region decision of ``source``; ``listing`` adds the columns that only listings have."""
    amb = arr(geo["ambiguous_localities"]) if geo["ambiguous_localities"] else "CAST([] AS VARCHAR[])"
    fields = [("delivery_location", 1, location), ("buyer_organization", 6, "concat_ws(' ', buyer_organization, ministry)"), ("title", 7, "title")]
    if listing:
        fields += [("buyer_address", 5, "buyer_address"), ("listing_text", 8, "listing_text")]
    if doc:
        fields.append(("documents", 9, "doc_text"))
    rows = " UNION ALL ".join(f"SELECT k, {o} AS o, {q(n)} AS f, {clean('coalesce(' + t + ', {e})'.replace('{e}', q('')))} AS t FROM {source}" for n, o, t in fields)
    org = "|".join(term_regex(t) for t in geo["local_organisations"])
    state = geo["state"]
    accept = arr(geo["accept_fields"])
    return f"""
{p}f AS ({rows}),
{p}m0 AS (SELECT k, o, f, t, list_filter({places('t', geo['state_aliases'])}, lambda x: len(x) > 2) AS st, {places('t', geo['districts'])} AS di, {places('t', geo['localities'])} AS lo FROM {p}f WHERE t <> ''),
{p}m AS (SELECT k, o, f, st || di || list_filter(lo, lambda x: NOT list_contains({amb}, lower(x))) ||
   CASE WHEN len(st) + len(di) > 0 THEN list_filter(lo, lambda x: list_contains({amb}, lower(x))) ELSE [] END AS hit, di FROM {p}m0),
{p}a AS (SELECT k, list(f ORDER BY o) AS wh, flatten(list(hit ORDER BY o)) AS te, flatten(list(di ORDER BY o)) AS ds FROM {p}m WHERE len(hit) > 0 GROUP BY k),
{p}b AS (SELECT k, lower(string_agg(t, ' ' ORDER BY o)) AS blob FROM {p}f GROUP BY k),
{p}j AS (SELECT b.k, coalesce(a.wh, CAST([] AS VARCHAR[])) AS wh, coalesce({distinct_ci('a.te')}, CAST([] AS VARCHAR[])) AS te, coalesce({distinct_ci('a.ds')}, CAST([] AS VARCHAR[])) AS ds,
   ({' OR '.join(f"contains(blob, {q(m)})" for m in geo['nationwide_markers'])}) AS nw,
   regexp_matches(' ' || blob || ' ', {q('(?i)[^a-z0-9](?:' + org + ')[^a-z0-9]')}) AS og,
   {some([f"CASE WHEN contains(blob, {q(s)}) THEN {q(s)} END" for s in geo['other_states']])} AS ot
   FROM {p}b b LEFT JOIN {p}a a ON a.k = b.k),
{p}geo AS (SELECT k, wh, te, ds, nw, list_has_any(wh, {accept}) OR len(te) > 0 OR nw OR og AS in_region,
   CASE WHEN list_has_any(wh, {accept}) THEN 'confirmed' WHEN len(te) > 0 THEN 'inferred' WHEN nw OR og THEN 'unclear' ELSE 'confirmed' END AS gconf,
   CASE WHEN list_has_any(wh, {accept}) THEN '{state} found in ' || array_to_string(wh, ', ') || ': ' || array_to_string(te, ', ')
    WHEN len(te) > 0 THEN '{state} mentioned, but not in a delivery/service/buyer-address field (' || array_to_string(wh, ', ') || ') — confirm the actual work location'
    WHEN nw THEN 'Pan-India / multi-state tender: {state} is likely in scope but is not named — confirm the consignee list before bidding'
    WHEN og THEN 'Buyer is an organisation that operates mainly in {state}, but no {state} location is stated — confirm the delivery location'
    WHEN len(ot) > 0 THEN 'No {state} reference; locations point to ' || array_to_string(ot, ', ')
    ELSE 'No {state} reference found in any location field' END AS greason FROM {p}j)"""


def rx(text: str, pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({text}, {q('(?i)' + pattern)}, {group}), '')"


def cl(n: int) -> str:
    return f"[^\\n]{{0,{n}}}?"


EL = "(?:emd|earnest\\s+money(?:\\s+deposit)?|bid\\s+security)"
SL = "(?:performance\\s+security|e-?pbg|performance\\s+bank\\s+guarantee|security\\s+deposit)"
RS = "(?:rs\\.?|inr|₹)\\s*([\\d,]+(?:\\.\\d+)?)"
PCT = "(\\d{1,2}(?:\\.\\d+)?)\\s*(?:%|percent|per\\s?cent)"
INST = {"performance_security": "performance\\s+security", "epbg": "\\be-?pbg\\b|performance\\s+bank\\s+guarantee", "security_deposit": "security\\s+deposit"}
EX = "\\bexempt(?:ed|ion)?\\b"
MS, SU = "\\b(?:msme|mse|micro\\s+and\\s+small|udyam|nsic)\\b", "\\b(?:startup|start-up|dpiit)\\b"


def unlook(pattern: str) -> str:
    return pattern.replace("(?!\\s*india)", "").replace("(?<![a-z])dsc(?![a-z])", "\\bdsc\\b")


def cue(name: str) -> str:
    pattern = "(?i)" + "|".join(f"(?:{c})" for c in R.requirements["cues"][name])
    return f"list_filter(sents, lambda s: regexp_matches(s, {q(pattern)}))"


def clauses(p: str, source: str) -> str:
    """CTEs {p}t .. {p}cl: clause facts of ``source``."""
    demand, hedge = "(?i)" + R.requirements["demand"], "(?i)" + R.requirements["hedge"]
    docs = []
    for canonical, name, pattern in R.requirements["documents"]:
        m = f"list_filter(asks, lambda a: regexp_matches(a, {q('(?i)' + unlook(pattern))}))"
        firm = f"list_filter({m}, lambda a: NOT regexp_matches(a, {q(hedge)}))"
        first = f"{m}[1]"
        docs.append(
            f"CASE WHEN len({m}) > 0 THEN {{'u': len({firm}) = 0, 'n': {q(name)}, 'c': {q(canonical)}, 'e': CASE WHEN regexp_matches({first}, {q(hedge)}) AND len({firm}) > 0 "
            f"THEN {firm}[1] || ' | ' || {first} ELSE {first} END}} END"
        )
    status = "CASE WHEN {m} IS NULL THEN 'not_stated' WHEN regexp_matches(snil, {p}) THEN 'not_required' ELSE 'required' END"
    flag = "CASE WHEN {0} THEN {1} END"
    from bidlens.operators import emd, requirements, security

    return f"""
{p}t AS (SELECT *, {clean('doc_text')} AS d, regexp_replace({clean('doc_text')}, '\\.\\s+([A-Za-z])', chr(46) || chr(10) || '\\1', 'g') AS t,
   list_filter(string_split(regexp_replace({clean('doc_text')}, '([.;:])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS sents FROM {source}),
{p}r AS (SELECT *,
   {rx('t', f'\\b{EL}\\b{cl(80)}\\b(?:nil|not\\s+applicable|not\\s+required|no\\s+emd|exempt(?:ed|ion)?|zero|rs\\.?\\s*0(?:\\.00)?\\b|₹\\s*0(?:\\.00)?\\b)')} AS enil,
   coalesce({rx('t', f'\\b{EL}\\b{cl(120)}{RS}', 1)}, {rx('t', f'{RS}{cl(60)}\\b(?:as\\s+)?{EL}\\b', 1)}) AS eamt,
   {rx('t', f'\\b{EL}\\b{cl(160)}\\b(online|net\\s?banking|neft|rtgs|demand\\s+draft|dd|bank\\s+guarantee|bg|fixed\\s+deposit|fdr|insurance\\s+surety\\s+bond|through\\s+gem\\s+pool\\s+account)\\b', 1)} AS pay,
   {rx('t', f'\\b{EL}\\b{cl(160)}(?:on\\s+or\\s+)?(?:before|by|up\\s?to|last\\s+date{cl(20)})\\s*(\\d{{1,2}}[-/\\s][A-Za-z0-9]{{2,9}}[-/\\s]\\d{{2,4}}(?:\\s+\\d{{1,2}}:\\d{{2}})?)', 1)} AS ldate,
   regexp_matches(t, {q('(?i)' + MS + cl(120) + EX + '|' + EX + cl(120) + MS)}) AS msx,
   regexp_matches(t, {q('(?i)' + SU + cl(120) + EX + '|' + EX + cl(120) + SU)}) AS sux,
   {rx('t', f'{SL}{cl(80)}\\b(?:nil|not\\s+applicable|not\\s+required|no\\s+performance|zero|rs\\.?\\s*0\\b)')} AS snil,
   {rx('t', f'{SL}{cl(140)}{PCT}', 1)} AS sp1,
   {rx('t', f'{SL}{cl(120)}{RS}', 1)} AS samt,
   coalesce({rx('d', '(?:performance\\s+security|e-?pbg|performance\\s+bank\\s+guarantee)[^.]{0,240}?(\\d{1,4}\\s*(?:days?|months?|years?)[^.\\n]{0,80})', 1)},
            {rx('d', '(?:valid|validity)[^.\\n]{0,80}?(\\d{1,4})\\s*(days?|months?|years?)[^.\\n]{0,60}?(?:beyond|after|from)?[^.\\n]{0,60}')}) AS sval,
   {rx('t', f'(?:performance\\s+security|e-?pbg){cl(160)}within\\s+(\\d{{1,3}}\\s*(?:days?|weeks?){cl(60)})', 1)} AS stime,
   {rx('t', f'(?:performance\\s+security|e-?pbg|security\\s+deposit){cl(160)}exempt(?:ed|ion)?{cl(120)}')} AS sex,
   {', '.join(f"{rx('d', v)} AS m_{k}" for k, v in INST.items())},
   list_filter(sents, lambda s: regexp_matches(s, {q(demand)})) AS asks,
   {', '.join(f"{cue(c)} AS q_{c}" for c in R.requirements['cues'])}
   FROM {p}t),
{p}s AS (SELECT *, TRY_CAST(replace(eamt, ',', '') AS DOUBLE) AS amt, coalesce(portal_epbg_pct, TRY_CAST(sp1 AS DOUBLE)) AS spct,
   {status.format(m='m_performance_security', p=q('(?i)' + INST['performance_security']))} AS ps0,
   CASE WHEN portal_epbg_pct > 0 THEN 'required' WHEN portal_epbg_pct IS NOT NULL THEN 'not_required' ELSE {status.format(m='m_epbg', p=q('(?i)' + INST['epbg']))} END AS epbg,
   {status.format(m='m_security_deposit', p=q('(?i)' + INST['security_deposit']))} AS security_deposit,
   list_sort({some(docs)}) AS docs FROM {p}r),
{p}u AS (SELECT *, CASE WHEN portal_emd_amount > 0 THEN 'required' WHEN portal_emd_amount IS NOT NULL THEN 'not_required' WHEN amt > 0 THEN 'required'
     WHEN enil IS NOT NULL THEN 'not_required' WHEN amt = 0 THEN 'not_required' ELSE 'not_stated' END AS estatus,
   coalesce(portal_emd_amount, amt) AS eamount,
   CASE WHEN spct IS NOT NULL AND ps0 = 'not_stated' AND epbg = 'not_stated' AND security_deposit = 'not_stated' THEN 'required' ELSE ps0 END AS performance_security FROM {p}s),
{p}cl AS (SELECT *,
   CASE WHEN 'required' IN (performance_security, epbg, security_deposit) THEN 'Required' WHEN 'not_required' IN (performance_security, epbg, security_deposit) THEN 'Not Required' ELSE '⚠ Verification Required' END AS shead,
   'not_stated' NOT IN (performance_security, epbg, security_deposit) AS sfull,
   CASE estatus WHEN 'not_required' THEN '✅ NO EMD REQUIRED' WHEN 'required' THEN '💰 EMD REQUIRED' ELSE '⚠ EMD INFORMATION NOT CLEAR – MANUAL VERIFICATION REQUIRED' END AS ehead,
   list_transform(docs, lambda x: x.c) AS doc_keys FROM {p}u),
{p}fl AS (SELECT k, {some([
    flag.format("d = '' AND portal_emd_amount IS NULL", q(emd.FLAG_NO_TEXT)),
    flag.format(f"d <> '' AND portal_emd_amount IS NULL AND estatus = 'not_stated' AND regexp_matches(d, {q('(?i)earnest\\s+money(?:\\s+deposit)?|\\bemd\\b|bid\\s+security')})", q(emd.FLAG_UNREAD)),
    flag.format("portal_emd_amount IS NOT NULL AND abs(portal_emd_amount - amt) > 1", "'EMD amount differs between the GeM listing (' || " + rupees('portal_emd_amount') + " || ') and the bid document (' || " + rupees('amt') + " || ') — confirm which applies before paying.'"),
    flag.format("shead = '⚠ Verification Required' AND (m_performance_security IS NOT NULL OR m_epbg IS NOT NULL)", q(security.FLAG_NO_TERMS)),
    flag.format("d = '' AND len(docs) = 0", q(requirements.FLAG_NO_TEXT)),
    flag.format("d <> '' AND len(docs) = 0", q(requirements.FLAG_NO_DOCUMENTS)),
  ])} AS cflags FROM {p}cl)"""


def security_line() -> str:
    def named(s: str) -> str:
        return "array_to_string(" + some([
            f"CASE WHEN epbg = '{s}' THEN 'ePBG' END", f"CASE WHEN performance_security = '{s}' THEN 'Performance Security' END",
            f"CASE WHEN security_deposit = '{s}' THEN 'Security Deposit' END"]) + ", ' / ')"
    parts = some([f"{named('required')} || ': Required'", f"{g('spct')} || '% of contract value'",
                  rupees("TRY_CAST(replace(samt, ',', '') AS DOUBLE)"), "'validity ' || sval", "'submit within ' || stime"])
    from bidlens.operators import security

    return (f"CASE WHEN shead = '⚠ Verification Required' THEN {q(security.LINE_UNKNOWN)} WHEN shead = 'Not Required' THEN {named('not_required')} || ': Not Required' || "
            f"CASE WHEN sfull THEN '' ELSE {q(security.LINE_CAVEAT)} END ELSE array_to_string({parts}, ' — ') END")


LEVELS = (("strong", "core category"), ("moderate", "adjacent category"), ("weak", "outside usual scope"))


def capability(cats: str, profile=R.profile) -> tuple[str, str]:
    level, reason = "CASE", "CASE"
    for name, words in LEVELS:
        hit_list = f"list_sort(list_intersect(list_transform({cats}, lambda c: lower(c)), {arr(c.lower() for c in profile[name])}))"
        level += f" WHEN len({hit_list}) > 0 THEN '{name}'"
        reason += f" WHEN len({hit_list}) > 0 THEN '{words} (' || array_to_string({hit_list}, ', ') || ')'"
    return level + " ELSE 'unknown' END", reason + " ELSE 'category not listed in the company profile' END"


def eligible(p: str, source: str, prof) -> str:
    """CTEs {p}e0, {p}e: eligibility of ``source`` (clauses, class and geo joined)."""
    level, reason = capability("cats", prof)
    mine = arr(d.lower() for d in prof["service_districts"])
    sc = " ".join(f"WHEN '{k}' THEN {v}" for k, v in (("lakh", 1e5), ("lakhs", 1e5), ("crore", 1e7), ("crores", 1e7), ("cr", 1e7)))
    tp = "(?i)(?:average\\s+)?annual\\s+turnover[^.\\n]{0,60}?(?:rs\\.?|inr|₹)?\\s*([\\d,]+(?:\\.\\d+)?)\\s*(lakh?s?|crores?|cr)?"
    where = "array_to_string(gd, ', ')"
    loc = "(in_region AND gconf = 'confirmed')"
    emd_known = "(estatus = 'required' AND eamount IS NOT NULL)"
    oem = "list_contains(doc_keys, 'oem_authorization')"
    past = "list_has_any(doc_keys, ['work_order', 'completion_certificate', 'experience'])"
    w = lambda test, text: f"CASE WHEN {test} THEN {text} END"
    sup, gap, ver = [], [], []
    sup.append(f"CASE lvl WHEN 'strong' THEN 'Product/service category matches our core business — ' || lrs || '.' WHEN 'moderate' THEN 'Product/service category is workable for us — ' || lrs || '.' END")
    gap.append(w("lvl = 'weak'", "'Category is outside our usual scope — ' || lrs || '.'"))
    ver.append(w("lvl = 'unknown'", "'Whether we can supply this category (company profile does not cover it).'"))
    sup.append(w(loc, f"'Work location is in our operating area (' || coalesce(nullif({where}, ''), 'Jharkhand') || ').'"))
    ver.append(f"CASE WHEN {loc} AND serves = false THEN 'Service coverage in ' || {where} || ' — outside the districts listed in our profile.' WHEN in_region AND NOT {loc} THEN 'Actual work location — ' || greason || '.' END")
    if prof["oem_held"]:
        ver.append(w(oem, q("OEM Authorization (MAF) for the exact make/model this bid asks for — we hold authorisations for " + ", ".join(prof["oem_held"]) + ".")))
    else:
        gap.append(w(oem, "'OEM Authorization Letter is required and no OEM authorisation is recorded in our profile.'"))
    t = prof["annual_turnover_inr"]
    if t is None:
        ver.append(f"'Turnover requirement of about ' || {rupees('tov')} || ' — our turnover is not recorded in the company profile.'")
    else:
        sup.append(w(f"tov <= {t}", f"'Stated turnover requirement (' || {rupees('tov')} || ') appears met.'"))
        gap.append(w(f"tov > {t}", f"'Turnover requirement of ' || {rupees('tov')} || ' exceeds our recorded turnover (' || {rupees(str(t))} || ').'"))
    y = prof["years_in_business"]
    if y is None:
        ver.append("'Requirement of ' || yrs || ' years'' experience.'")
    else:
        sup.append(w(f"yrs <= {y}", "yrs || '-year experience requirement appears met.'"))
        gap.append(w(f"yrs > {y}", f"yrs || ' years'' experience required; profile records {y}.'"))
    if prof["government_supply_experience"] is None:
        ver.append(w(past, "'Past government supply experience (work orders / completion certificates) — not recorded in our profile.'"))
    else:
        gap.append(w(past, "'Past work orders / completion certificates are required and we have no recorded government supply experience.'"))
    cap = prof["can_arrange_emd_upto_inr"]
    unsure = "'EMD requirement is not stated clearly in the source.'"
    if cap is None:
        ver.append(f"CASE WHEN {emd_known} THEN 'Ability to fund EMD of ' || {rupees('eamount')} || '.' WHEN estatus <> 'not_required' THEN {unsure} END")
        sup.append(w("estatus = 'not_required'", "'No EMD is required.'"))
    else:
        gap.append(w(f"{emd_known} AND eamount > {cap}", f"'EMD of ' || {rupees('eamount')} || ' exceeds the ' || {rupees(str(cap))} || ' we have recorded as arrangeable.'"))
        relief = "msx" if prof["msme_registered"] else "false"
        sup.append(f"CASE WHEN {emd_known} AND eamount <= {cap} AND {relief} THEN 'MSME EMD exemption appears available to us.' WHEN estatus = 'not_required' THEN 'No EMD is required.' END")
        ver.append(w(f"NOT {emd_known} AND estatus <> 'not_required'", unsure))
    ver.append(f"CASE WHEN shead = 'Required' AND spct IS NOT NULL THEN 'Performance security of ' || {g('spct')} || '% must be arranged if we win.' WHEN shead = '⚠ Verification Required' THEN 'Performance security / ePBG terms are not stated clearly.' END")
    for kw in prof["avoid_keywords"]:
        gap.append(w(f"contains(lower(title), {q(kw)})", q(f"Matches an avoid-list keyword: '{kw}'.")))
    return f"""
{p}e0 AS (SELECT *, {level} AS lvl, {reason} AS lrs, CASE WHEN len(gd) > 0 THEN list_has_any(list_transform(gd, lambda x: lower(x)), {mine}) END AS serves,
   list_filter(list_transform(list_filter(q_eligibility, lambda s: regexp_matches(s, {q(tp)})),
     lambda s: TRY_CAST(replace(regexp_extract(s, {q(tp)}, 1), ',', '') AS DOUBLE) * CASE lower(regexp_extract(s, {q(tp)}, 2)) {sc} ELSE 1 END), lambda v: v IS NOT NULL)[1] AS tov,
   list_filter(list_transform(q_eligibility, lambda s: TRY_CAST(regexp_extract(s, '(?i)(\\d{{1,2}})\\s*(?:\\+)?\\s*years?\\s+of\\s+(?:past\\s+)?experience', 1) AS INT)), lambda v: v IS NOT NULL)[1] AS yrs
   FROM {source}),
{p}e1 AS (SELECT *, {some(sup)} AS sup, {some(gap)} AS gaps, {some(ver)} AS ver FROM {p}e0),
{p}e AS (SELECT *, CASE WHEN len(gaps) >= 2 OR (len(gaps) > 0 AND lvl = 'weak') THEN 'LOW' WHEN len(gaps) > 0 THEN 'MEDIUM' WHEN lvl = 'strong' AND len(sup) >= 3 AND len(ver) <= 2 THEN 'HIGH'
   WHEN lvl IN ('strong', 'moderate') AND len(sup) > 0 THEN 'MEDIUM' ELSE 'UNKNOWN' END AS grade FROM {p}e1),
{p}el AS (SELECT *, CASE grade WHEN 'LOW' THEN 'Major Requirement Gap' WHEN 'HIGH' THEN 'Likely Suitable' WHEN 'MEDIUM' THEN CASE WHEN len(gaps) = 0 THEN 'Potentially Suitable' ELSE 'Requires Verification' END ELSE 'Requires Verification' END AS fit FROM {p}e)"""


KIND_WORDS = "CASE kind WHEN 'product_supply' THEN 'product supply' WHEN 'service' THEN 'service' WHEN 'supply_and_service' THEN 'supply + service' ELSE 'type unclear' END"


def scored(p: str) -> str:
    hard = arr(R.requirements["hard_documents"])
    spec = "lower(array_to_string(q_special, ' '))"
    auction = f"(contains({spec}, 'reverse auction') OR lower(ra_enabled) = 'yes')"
    penalty = f"regexp_matches({spec}, 'liquidated damages|penalt')"
    nd, nh = "len(docs)", f"len(list_filter(doc_keys, lambda x: list_contains({hard}, x)))"
    base = "CASE WHEN len(cats) >= 2 THEN least(20.0::DOUBLE, (CASE WHEN conf = 'confirmed' THEN 20.0 ELSE 14.0 END)::DOUBLE + 2.0) ELSE (CASE WHEN conf = 'confirmed' THEN 20.0 ELSE 14.0 END)::DOUBLE END"
    r1 = lambda x: f"CAST(round_even(({x})::DOUBLE, 1) AS DOUBLE)"
    where = "array_to_string(gd, ', ')"
    return f"""
{p}p AS (SELECT *,
  {r1(f"CASE WHEN NOT related THEN 0.0 ELSE ({base}) * CASE WHEN len(sigs) = 1 THEN 0.85::DOUBLE ELSE 1.0 END END")} AS s1,
  CASE WHEN related THEN array_to_string(cats, ', ') || ' (' || {KIND_WORDS} || ')' ELSE 'Not an IT product or service' END AS w1,
  {r1("CASE WHEN NOT in_region THEN 0.0 WHEN gconf = 'confirmed' THEN CASE WHEN serves = false THEN 11.25 ELSE 15.0 END WHEN gconf = 'inferred' THEN 10.5 ELSE 6.0 END")} AS s2,
  CASE WHEN NOT in_region THEN greason WHEN gconf = 'confirmed' THEN 'Jharkhand confirmed (' || coalesce(nullif({where}, ''), 'state-level') || ')' || CASE WHEN serves = false THEN ' — outside our listed service districts' ELSE '' END
    WHEN gconf = 'inferred' THEN 'Jharkhand mentioned but not in a location field' ELSE 'Pan-India / inferred only — confirm Jharkhand is in scope' END AS w2,
  {r1("CASE lvl WHEN 'strong' THEN 20.0 WHEN 'moderate' THEN 14.0 WHEN 'weak' THEN 6.0 ELSE 8.0 END * CASE grade WHEN 'LOW' THEN 0.5 WHEN 'HIGH' THEN CASE WHEN lvl = 'strong' THEN 1.0 ELSE 1.1 END ELSE 1.0 END")} AS s3,
  CASE WHEN lvl = 'unknown' THEN 'Company profile does not cover this category — scored neutrally' WHEN grade = 'LOW' THEN lrs || '; eligibility gaps identified' ELSE lrs END AS w3,
  {r1(f"CASE WHEN {nd} = 0 THEN 5.0 ELSE greatest(0.0, 10.0 - least(5.0, greatest(0, {nd} - 6) * 0.6) - {nh} * 1.2) END")} AS s4,
  CASE WHEN {nd} = 0 THEN 'Document requirements unknown — scored neutrally' ELSE {nd} || ' documents required' || CASE WHEN {nh} > 0 THEN ', ' || {nh} || ' of them hard to arrange' ELSE '' END END AS w4,
  {r1("CASE WHEN dr IS NULL THEN 3.0 WHEN dr < 0 THEN 0.0 WHEN dr <= 1 THEN 2.5 WHEN dr <= 2 THEN 4.5 WHEN dr <= 5 THEN 8.0 ELSE 10.0 END")} AS s5,
  CASE WHEN dr IS NULL THEN 'Closing date unknown — verify on GeM' WHEN dr < 0 THEN 'Closed' WHEN dr <= 1 THEN dr || ' day left — very little preparation time' WHEN dr <= 2 THEN dr || ' days left — tight' WHEN dr <= 5 THEN dr || ' days left — workable' ELSE dr || ' days left — comfortable' END AS w5,
  {r1("CASE WHEN estimated_value IS NULL THEN CASE WHEN quantity >= 25 THEN 9.75 ELSE 7.5 END WHEN estimated_value < 100000 THEN 4.5 WHEN estimated_value > 20000000 THEN 9.0 ELSE 15.0 END")} AS s6,
  CASE WHEN estimated_value IS NULL THEN CASE WHEN quantity >= 25 THEN 'Value not published; quantity of ' || {g('quantity')} || ' ' || coalesce(nullif(quantity_unit, ''), 'units') || ' suggests a worthwhile order' ELSE 'Estimated value not published on GeM — scored neutrally' END
    WHEN estimated_value < 100000 THEN {rupees('estimated_value')} || ' is below our ₹100,000 threshold' WHEN estimated_value > 20000000 THEN {rupees('estimated_value')} || ' exceeds our ₹20,000,000 comfort ceiling' ELSE {rupees('estimated_value')} || ' sits in our target range' END AS w6,
  {r1(f"greatest(0.0, least(10.0, 10.0 - CASE estatus WHEN 'required' THEN 1.5 WHEN 'not_required' THEN 1.0 ELSE 2.0 END - CASE WHEN shead = 'Required' THEN 1.5 ELSE 0.0 END - CASE WHEN {auction} THEN 2.0 ELSE 0.0 END - CASE WHEN {penalty} THEN 1.0 ELSE 0.0 END + CASE WHEN kind = 'service' THEN 0.5 ELSE 0.0 END))")} AS s7,
  array_to_string({some(["CASE estatus WHEN 'required' THEN 'EMD payable' WHEN 'not_required' THEN 'no EMD — expect more bidders' ELSE 'EMD terms unclear' END", "CASE WHEN shead = 'Required' THEN 'performance security required' END", f"CASE WHEN {auction} THEN 'reverse auction — price pressure' END", f"CASE WHEN {penalty} THEN 'penalty clauses' END", "CASE WHEN kind = 'service' THEN 'service contract — recurring revenue' END"])}, '; ') AS w7
  FROM {p}el),
{p}sc AS (SELECT *, CAST(round_even(s1 + s2 + s3 + s4 + s5 + s6 + s7, 1) AS DOUBLE) AS total FROM {p}p),
{p}an AS (SELECT *, CASE WHEN total BETWEEN 80 AND 100 THEN 'STRONG OPPORTUNITY' WHEN total BETWEEN 60 AND 79 THEN 'GOOD OPPORTUNITY' WHEN total BETWEEN 40 AND 59 THEN 'REVIEW REQUIRED' WHEN total BETWEEN 0 AND 39 THEN 'LOW PRIORITY' ELSE '' END AS band,
  CASE WHEN total BETWEEN 80 AND 100 THEN 'TOP PRIORITY' WHEN total BETWEEN 60 AND 79 THEN 'GOOD OPPORTUNITY' WHEN total BETWEEN 40 AND 59 THEN 'REVIEW REQUIRED' WHEN total BETWEEN 0 AND 39 THEN 'LOW PRIORITY' ELSE '' END AS rank_label,
  CASE WHEN total >= 80 THEN '🥇 TOP PRIORITY' WHEN total >= 60 THEN '🥈 GOOD OPPORTUNITY' WHEN total >= 40 THEN '🥉 REVIEW REQUIRED' ELSE '❌ LOW PRIORITY' END AS bucket FROM {p}sc),
{p}jg AS (SELECT *, CASE WHEN why IS NULL THEN 'accepted' WHEN why = 'outside_10_day_window' AND dr BETWEEN 11 AND 60 AND total >= 70 THEN 'watchlist' ELSE 'rejected' END AS verdict FROM
  (SELECT *, {gate('related', 'in_region')} AS why FROM {p}an)),
{p}ju AS (SELECT * EXCLUDE (urg), CASE WHEN verdict = 'watchlist' THEN 'WATCHLIST' ELSE urg END AS urg, CASE WHEN verdict = 'rejected' THEN why END AS rejected_reason FROM {p}jg)"""


def active(status: str) -> str:
    return f"NOT regexp_matches(lower({status}), 'cancelled|canceled|withdrawn|closed|retendered')"


def gate(related: str, region: str) -> str:
    return (f"CASE WHEN NOT {official('source_url')} THEN 'not_official_gem_source' WHEN NOT ({active('portal_status')}) THEN 'not_active' WHEN NOT {related} THEN 'not_it_related' "
            f"WHEN NOT {region} THEN 'not_jharkhand' WHEN dr IS NULL THEN 'no_closing_date' WHEN dr < 0 THEN 'expired' WHEN dr > 10 THEN 'outside_10_day_window' END")


def base(p: str = "", view: str = "bids", now: str = NOW) -> str:
    return f"""
{p}bids AS ({views.sql(view, views.DUCK)}),
{p}base AS (SELECT *, {KEY} AS identity_key, {days('bid_end_at', now)} AS dr, {urgency(days('bid_end_at', now))} AS urg FROM {p}bids)"""


def screen(p: str = "") -> str:
    return f"""{classified(p + 'l', p + 'base', False)},{located(p + 'lg', p + 'base', False)},
{p}scr AS (SELECT b.*, c.related AS lrel, c.cats AS lcats, gg.in_region AS lreg, gg.ds AS lds,
  CASE WHEN dr < 0 THEN 'expired' WHEN dr > 60 THEN 'outside_10_day_window' WHEN NOT c.related THEN 'not_it_related' WHEN NOT gg.in_region THEN 'not_jharkhand' END AS screen_reason
  FROM {p}base b JOIN {p}lcls c ON c.k = b.k JOIN {p}lggeo gg ON gg.k = b.k)"""


def initcaps(x: str) -> str:
    return f"list_transform({x}, lambda x: array_to_string(list_transform(string_split(x, ' '), lambda w: upper(left(w, 1)) || lower(w[2:])), ' '))"


def analysed(p: str = "", prof=R.profile) -> str:
    return f"""
{p}sl AS (SELECT * EXCLUDE (screen_reason, lrel, lcats, lreg, lds) FROM {p}scr WHERE screen_reason IS NULL),{judged(p, prof)}"""


def judged(p: str, prof=R.profile, listing: bool = False) -> str:
    """CTEs from {p}sl (the shortlist) to {p}ju: full analysis and gate."""
    class_of = classified(p + "d", p + "sl", True, *((LISTING_SAYS, LISTING_HEAD) if listing else ()))
    return f"""{class_of},{located(p + 'dg', p + 'sl', True, listing=listing)},{clauses(p, p + 'sl')},
{p}wide AS (SELECT cl.*, c.* EXCLUDE (k), gg.* EXCLUDE (k, ds), {initcaps('gg.ds')} AS gd,
   {some(["CASE WHEN dr IS NULL THEN " + q("Bid closing date could not be read from the official listing — confirm the deadline on GeM before planning any submission.") + " END"])} || f.cflags AS flags
   FROM {p}cl cl JOIN {p}dcls c ON c.k = cl.k JOIN {p}dggeo gg ON gg.k = cl.k JOIN {p}fl f ON f.k = cl.k),{eligible(p, p + 'wide', prof)},{scored(p)}"""


def full(p: str = "", view: str = "bids", now: str = NOW) -> str:
    return base(p, view, now) + "," + screen(p) + "," + analysed(p)


#: What follows the shared tables in each query, for those that put several together.
SELECTS: dict[str, str] = {}


def add(name: str, prelude: str, select: str) -> None:
    SELECTS[name] = "WITH " + select.lstrip(", ") if select.lstrip().startswith(",") else select
    ORACLES[name] = (f"WITH {prelude.strip().lstrip(',')}\n" if prelude else "") + select


def at(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


B, FULL = base(), full()
BD = base() + "," + classified("c", "base", True)
BG = base() + "," + located("g", "base", True)
BC = base() + "," + clauses("", "base")
BS = base() + "," + screen()
