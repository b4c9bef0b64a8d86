"""Saved web pages as tables: search-result cards, detail rows, attachment links.

Pages come as ``url, html``. Only the fragments the rules need are cut out with
built-in regex functions; the work per page is independent of other pages.
"""

from __future__ import annotations

import html.entities
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlens.functions import as_column, let, literal
from bidlens.functions.identity import BID_NUMBER
from bidlens.functions.lists import strings
from bidlens.functions.text import blank_to, clean, escape, normalize_key, strip_label
from bidlens.functions.values import parse_amount, parse_datetime, parse_percentage, parse_quantity
from bidlens.rules import Rules
from bidlens.schema import NOT_REQUIRED, REQUIRED, conform


def _up_to(tag: str) -> str:
    """Everything before the next closing ``tag``, read once and without steps back."""
    return f"[^<]*+(?:<(?!/{tag}>)[^<]*+)*+"


# The portal's markup.
CLASS = "class=[\"'](?:[^\"']*\\s)?(?:{})(?:\\s[^\"']*)?[\"']"
CARD = f"(?i)<div[^>]*{CLASS.format('card|bid-card|block pkglist')}[^>]*>"
BLOCK = f"(?is)<div[^>]*{CLASS.format('col-block')}[^>]*>({_up_to('div')})</div>"
BID_LINK = (
    f"(?is)<a\\s[^>]*{CLASS.format('bid_no_hover')}[^>]*>.*?</a>",
    "(?is)<a\\s[^>]*href=[\"'][^\"']*showbidDocument[^\"']*[\"'][^>]*>.*?</a>",
    "(?is)<a\\s[^>]*href=[\"'][^\"']*bidlists[^\"']*[\"'][^>]*>.*?</a>",
)
ROW = f"(?is)<tr[^>]*>({_up_to('tr')})</tr>"
CELL = f"(?is)<td[^>]*>({_up_to('td')})</td>"
DIV_ROW = (
    f"(?is)<div[^>]*{CLASS.format('bid-detail')}[^>]*>\\s*<div[^>]*{CLASS.format('key')}[^>]*>(.*?)</div>"
    f"\\s*<div[^>]*{CLASS.format('value')}[^>]*>(.*?)</div>"
)
ANCHOR = f"(?is)<a\\s[^>]*href=[\"'][^\"']*[\"'][^>]*>{_up_to('a')}</a>"
HREF = "(?i)<a\\s[^>]*?href=[\"']([^\"']*)[\"']"
LINK_TEXT = f"(?is)<a\\s[^>]*>({_up_to('a')})</a>"
# Tags in a row with the spaces behind them: one space stands for all.
TAGS = "(?:<[^>]*+> *+)++"
# Clean text (see ``clean``) without tags or character references.
BARE = "\\A(?: ?+[\\x21-\\x25\\x27-\\x3B\\x3D-\\x7E]++)*+ ?\\z"
BLOCKS = {
    "items": ("Items",),
    "quantity": ("Quantity",),
    "department": ("Department Name And Address", "Department"),
    "category": ("Category",),
}
DATE_SPANS = {"start_date": "Start Date", "end_date": "End Date"}
ENTITY = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
NAMES = {name: chr(point) for name, point in html.entities.name2codepoint.items()} | {"apos": "'", "nbsp": " "}


def decode_entities(text: Column) -> Column:
    """Numeric and named character references as characters, each decoded once; unknown ones stay."""
    names = literal(NAMES, "map<string,string>")

    def decoded(part: Column) -> Column:
        def known(name: Column) -> Column:
            digits = F.when(name.rlike("^#[xX]"), F.substring(name, 3, 6)).otherwise(F.hex(F.substring(name, 2, 7).cast("long")))
            char = F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
            whole = F.conv(digits, 16, 10).cast("long")
            valid = whole.between(1, 0x10FFFF) & ~whole.between(0xD800, 0xDFFF)
            found = F.when(name.startswith("#"), F.when(valid, char)).otherwise(F.element_at(names, name))
            return F.coalesce(F.concat(found, F.substring(part, F.length(name) + 2, F.length(part))), F.concat(F.lit("&"), part))

        return let(F.regexp_extract(part, ENTITY, 1), known)

    parts = F.transform(F.split(text, "&", -1), lambda part, i: F.when(i == 0, part).otherwise(decoded(part)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def text_of(html: Column) -> Column:
    """Visible text of a fragment: tags out, entities decoded, whitespace collapsed."""
    def read(fragment: Column) -> Column:
        out = F.regexp_replace(fragment, "(?s)<!--.*?-->", " ")
        return clean(let(F.regexp_replace(out, TAGS, " "), decode_entities))

    return let(html, lambda h: F.when(h.rlike(BARE), F.trim(h)).otherwise(read(h)))


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link found on page ``base``."""
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.\\-]*:)", 1)
    page = F.regexp_extract(base, "^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(
        F.regexp_replace(page, "[^/]*$", "")
    )
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.\\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


def cards(html: Column) -> Column:
    """ARRAY of card fragments, each running to the card's own closing tag (or the next card, if that is missing)."""
    return F.transform(F.filter(F.split(html, CARD), lambda piece, i: i > 0), inside)


_FLAT = "[^<]*+(?:<(?!div\\b|/div)[^<]*+)*+"
_NESTED = f"{_FLAT}(?:<div\\b{_FLAT}</div{_FLAT})*+"
#: A fragment whose divs are nested no deeper than two; one that begins like a div but is none is left to the fold.
SHALLOW = f"(?i)\\A(?!<div\\B)({_FLAT}(?:<div\\b{_NESTED}</div{_FLAT})*+</div)"


def inside(fragment: Column) -> Column:
    """What precedes the closing tag of the element that the fragment starts in, by the depth of its ``div`` tags."""
    def read(closed: Column) -> Column:
        return F.when(closed != "", F.left(closed, F.length(closed) - len("</div"))).otherwise(_inside(fragment))

    return let(F.regexp_extract(fragment, SHALLOW, 1), read)


def _inside(fragment: Column) -> Column:
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("chars"))

    def step(state: Column, part: Column) -> Column:
        low = F.lower(F.substring(part, 1, 5))
        depth = state["depth"] + F.when(low == "</div", -1).when(low.startswith("<div"), 1).otherwise(0)
        within = (state["depth"] > 0) & (depth > 0)
        return F.struct(
            F.when(state["depth"] > 0, depth).otherwise(0).cast("int").alias("depth"),
            (state["chars"] + F.when(within, F.length(part)).otherwise(0)).cast("int").alias("chars"),
        )

    parts = F.split(fragment, "(?i)(?=<div\\b|</div)")
    return F.substring(fragment, F.lit(1), F.aggregate(parts, start, step, lambda s: s["chars"]))


TOKEN = "<[^>]*>|[^<]+"
VOID = "(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)\\b"
SIBLING_OF = f"(?is)^<a\\s[^>]*{CLASS.format('bid_no_hover')}"


def sibling_text(card: Column) -> Column:
    """Text of the first ``div`` that follows the card's bid link under the same parent; '' if there is none.

    The card's tags are folded in order with the depth they stand at: ``at`` is the
    depth of the link's parent while it is open, ``taking`` that of the div being read.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("at"), F.lit(-1).alias("taking"), F.lit(False).alias("done"), F.lit("").alias("text"))

    def step(s: Column, token: Column) -> Column:
        tag, shut = token.startswith("<"), token.startswith("</")
        opens = tag & ~shut & ~token.rlike(VOID) & ~token.startswith("<!")
        depth = s["depth"] + F.when(opens, 1).when(shut, -1).otherwise(0)
        takes = opens & ~s["done"] & (s["taking"] < 0) & (s["at"] == s["depth"]) & token.rlike("(?i)^<div\\b")
        ends = shut & (s["taking"] >= 0) & (depth == s["taking"])
        at = F.when(opens & (s["at"] < 0) & token.rlike(SIBLING_OF), s["depth"]).when(depth < s["at"], -1).otherwise(s["at"])
        return F.struct(
            depth.cast("int").alias("depth"), at.cast("int").alias("at"), F.when(takes, s["depth"]).when(ends, -1).otherwise(s["taking"]).cast("int").alias("taking"),
            (s["done"] | ends).alias("done"), F.when((s["taking"] >= 0) & ~ends, F.concat(s["text"], F.lit(" "), token)).otherwise(s["text"]).alias("text"),
        )

    return text_of(F.aggregate(F.regexp_extract_all(card, F.lit(TOKEN), F.lit(0)), start, step, lambda s: s["text"]))


_NO_TABLE = "[^<]*+(?:<(?!table\\b|/table)[^<]*+)*+"
#: A page with one closed table, whatever else stands on it.
ONE_TABLE = f"(?i)\\A{_NO_TABLE}(<table\\b{_NO_TABLE})</table{_NO_TABLE}\\z"
OPENS_TABLE = f"(?is)^<table\\b[^>]*{CLASS.format('table')}"


def in_tables(html: Column) -> Column:
    """What stands inside tables of class ``table``, nested ones included; '' if there is none."""
    def read(only: Column) -> Column:
        return F.when(only.rlike(OPENS_TABLE), only).when(only != "", "").otherwise(_in_tables(html))

    return let(F.regexp_extract(html, ONE_TABLE, 1), read)


def _in_tables(html: Column) -> Column:
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, part: Column) -> Column:
        low = F.lower(F.substring(part, 1, 7))
        depth = F.when(low == "</table", F.greatest(s["depth"] - 1, F.lit(0))).when((low.startswith("<table")) & ((s["depth"] > 0) | part.rlike(OPENS_TABLE)), s["depth"] + 1).otherwise(s["depth"])
        return F.struct(depth.cast("int").alias("depth"), F.when(depth > 0, F.concat(s["kept"], F.array(part))).otherwise(s["kept"]).alias("kept"))

    parts = F.split(html, "(?i)(?=<table\\b|</table)")
    return F.array_join(F.aggregate(parts, start, step, lambda s: s["kept"]), "")


def listing_cards(pages: DataFrame, rules: Rules, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per card with a bid number: candidates plus ``page_url, pos`` and the pages' columns ``keep``."""
    base = F.lit(rules.portal["base_url"])
    df = pages.select(F.col("url").alias("page_url"), *keep, F.posexplode(cards(F.col("html"))).alias("pos", "card"))
    link = F.coalesce(
        *[F.nullif(F.regexp_extract("card", p, 0), F.lit("")) for p in BID_LINK], F.lit("")
    )
    df = df.withColumns({
        "link": link,
        "blocks": F.regexp_extract_all("card", F.lit(BLOCK), F.lit(1)),
        "card_text": text_of(F.col("card")),
    })
    df = df.withColumns({"link_text": text_of(F.col("link")), "href": F.regexp_extract("link", HREF, 1)})

    def block(name: str) -> Column:
        """Text of the first block that holds the label, label dropped."""
        texts = [
            F.get(F.filter("blocks", lambda b: F.contains(b, F.lit(label))), F.lit(0))
            for label in BLOCKS[name]
        ]
        first = F.coalesce(*texts, F.lit(""))
        value = text_of(first)
        if name == "items":  # the link's own text, where the block has one; without such a block, what follows the bid link
            value = let(text_of(F.regexp_extract(first, LINK_TEXT, 1)), lambda t: F.when(t != "", t).otherwise(text_of(first)))
            value = F.when(F.coalesce(*texts).isNull(), sibling_text(F.col("card"))).otherwise(value)
        for label in (*rules.portal["labels"].get(name, []), name):
            value = strip_label(value, label)
        return value

    def date_text(name: str) -> Column:
        span = f'(?is)<span[^>]*class="(?:[^"]*\\s)?{name}(?:\\s[^"]*)?"[^>]*>({_up_to("span")})</span>'
        labelled = F.get(F.filter("blocks", lambda b: F.contains(b, F.lit(DATE_SPANS[name]))), F.lit(0))
        inner = F.regexp_extract(F.coalesce(labelled, F.lit("")), "(?is)<span[^>]*>(.*?)</span>", 1)
        value = text_of(blank_to(F.regexp_extract("card", span, 1), inner))
        for label in (*rules.portal["labels"].get(name, []), name.replace("_", " ")):
            value = strip_label(value, label)
        return value

    number = F.when(F.col("link_text").rlike(BID_NUMBER), F.col("link_text")).otherwise(
        blank_to(F.regexp_extract("card_text", BID_NUMBER, 0), F.col("link_text"))
    )
    df = df.withColumns({"bid_number": F.upper(number), "items": block("items"), "_number": number})
    df = df.filter(F.col("bid_number") != "")
    quantity = parse_quantity(block("quantity"))
    df = df.withColumns({
        "source_url": F.when(F.col("href") != "", resolve(base, F.col("href"))).otherwise(F.col("page_url")),
        "title": blank_to("items", "_number"),
        "item_description": F.col("items"),
        "category": block("category"),
        "buyer_address": block("department"),
        "_quantity": quantity,
        "bid_start_at": parse_datetime(date_text("start_date")),
        "bid_end_at": parse_datetime(date_text("end_date")),
        "listing_text": F.col("card_text"),
    })
    return df.select(
        "page_url", "pos", "bid_number", "source_url", "title", "item_description", "category",
        "buyer_address", F.col("buyer_address").alias("buyer_organization"),
        F.col("_quantity.number").alias("quantity"), F.col("_quantity.unit").alias("quantity_unit"),
        "bid_start_at", "bid_end_at", "listing_text", *keep,
    )


def label_table(rules: Rules) -> dict[str, str]:
    """Normalised label to field; a repeated label goes to the later field."""
    fields = {}
    for field, labels in rules.portal["labels"].items():
        for label in labels:
            fields[" ".join(re.sub(r"[^\w\s]", " ", label.lower()).split())] = field
    return fields


def detail_fields(html: Column, rules: Rules) -> Column:
    """MAP field -> text of the first non-empty row with a known label."""
    labels = literal(label_table(rules), "map<string,string>")

    def entry(row: Column) -> Column:
        cells = F.regexp_extract_all(row, F.lit(CELL), F.lit(1))
        key = normalize_key(text_of(F.coalesce(F.get(cells, F.lit(0)), F.lit(""))))
        return F.struct(
            F.element_at(labels, key).alias("field"),
            text_of(F.coalesce(F.get(cells, F.lit(1)), F.lit(""))).alias("value"),
        )

    def div_entry(key: Column, value: Column) -> Column:
        return F.struct(F.element_at(labels, normalize_key(text_of(key))).alias("field"), text_of(value).alias("value"))

    table = F.transform(F.regexp_extract_all(in_tables(html), F.lit(ROW), F.lit(1)), entry)
    divs = F.zip_with(F.regexp_extract_all(html, F.lit(DIV_ROW), F.lit(1)), F.regexp_extract_all(html, F.lit(DIV_ROW), F.lit(2)), div_entry)
    # The page's table rows, or, where it has none at all, its div rows.
    rows = let(table, lambda t: F.when(F.size(t) > 0, t).otherwise(divs))
    known = F.filter(rows, lambda r: r["field"].isNotNull() & (r["value"] != ""))

    def firsts(rows: Column) -> Column:
        names = F.transform(rows, lambda r: r["field"])
        return F.map_from_entries(
            F.filter(rows, lambda r, i: F.array_position(names, r["field"]) == i + 1)
        )

    return let(known, firsts)


def detail_rows(pages: DataFrame, rules: Rules) -> DataFrame:
    """``page_url, field, value``: known fields of each detail page."""
    return pages.select(F.col("url").alias("page_url"), F.explode(detail_fields(F.col("html"), rules)).alias("field", "value"))


def merge_details(bids: DataFrame, details: DataFrame, rules: Rules, by: str = "bid_number") -> DataFrame:
    """Lay detail pages (``url, html``, and ``bid_number`` unless ``by`` is "url") over listing bids.

    A page belongs to the bid of its number, or, by "url", to the bids whose
    ``source_url`` is the page's. Of several pages of a bid the one with the largest
    url counts; blank numbers and urls match nothing, so no bid is ever repeated.
    ``detail_url`` is null where no page was found.

    Text overrides where it is not blank, dates where they parse, quantity where
    it parses (keeping the listing's unit if the page gives none).
    """
    parsed = details.filter(F.col(by) != "").select(
        F.col(by).alias("_bid"), F.col("url").alias("detail_url"),
        F.xxhash64("html").alias("_page"), detail_fields(F.col("html"), rules).alias("_d"),
    )
    latest = Window.partitionBy("_bid").orderBy(F.desc("detail_url"), "_page")
    parsed = parsed.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n", "_page")
    df = conform(bids).join(parsed, F.col("source_url" if by == "url" else by) == F.col("_bid"), "left")

    def said(field: str) -> Column:
        return F.element_at("_d", field)

    text = {
        c: F.coalesce(said(c), F.col(c))
        for c in ("gem_tender_id", "ministry", "department", "buyer_organization", "office",
                  "buyer_address", "category", "delivery_location")
    }
    dates = {c: F.coalesce(parse_datetime(said(c)), F.col(c)) for c in ("published_at", "bid_start_at", "bid_end_at", "bid_open_at")}
    percent = F.coalesce(
        parse_percentage(said("epbg_percentage")),
        parse_percentage(F.concat(clean(said("epbg_percentage")), F.lit("%"))),
    )

    def portal_flag(field: str, own: str) -> Column:
        word = F.lower(clean(said(field)))
        return F.when(word.isin("yes", "true"), REQUIRED).when(word.isin("no", "false"), NOT_REQUIRED).otherwise(F.col(own))

    df = df.withColumn("_q", F.when(said("quantity").isNotNull(), parse_quantity(said("quantity"))))
    df = df.withColumns(
        {"bid_number": F.upper(F.coalesce(said("bid_number"), F.col("bid_number")))} | text | dates | {
            "quantity": F.coalesce("_q.number", "quantity"),
            "quantity_unit": F.when(F.col("_q.number").isNotNull(), blank_to("_q.unit", "quantity_unit")).otherwise(F.col("quantity_unit")),
            "estimated_value": F.coalesce(F.when(said("estimated_value").isNotNull(), parse_amount(said("estimated_value"))), F.col("estimated_value")),
            "portal_emd_text": blank_to(said("emd_amount"), "portal_emd_text"),
            "portal_emd_amount": F.coalesce(F.when(said("emd_amount").isNotNull(), parse_amount(said("emd_amount"))), F.col("portal_emd_amount")),
            "portal_epbg_text": blank_to(said("epbg_percentage"), "portal_epbg_text"),
            "portal_epbg_pct": F.coalesce(F.when(said("epbg_percentage").isNotNull(), percent), F.col("portal_epbg_pct")),
            "msme_portal_flag": portal_flag("msme_exemption", "msme_portal_flag"),
            "startup_portal_flag": portal_flag("startup_exemption", "startup_portal_flag"),
            "ra_enabled": blank_to(said("ra_enabled"), "ra_enabled"),
        }
    )
    return conform(df.drop("_bid", "_d", "_q"))


def document_kind(name: Column | str) -> Column:
    return let(normalize_key(name), _kind_of)


def _kind_of(n: Column) -> Column:
    def has(*words: str) -> Column:
        return n.rlike("|".join(escape(w) for w in words))

    return (
        F.when(has("atc", "additional terms"), "atc")
        .when(has("corrigend", "amend"), "corrigendum")
        .when(has("spec", "technical"), "technical_spec")
        .when(has("scope", "sow"), "scope_of_work")
        .when(has("bid", "tender", "document"), "bid_document")
        .otherwise("unknown")
    )


def attachments(pages: DataFrame, rules: Rules, known: DataFrame | None = None) -> DataFrame:
    """``page_url, pos, name, url, kind``: links to documents, one row per URL.

    Ordered by link pattern, then place on the page. ``known`` holds
    ``page_url, url`` pairs that are already on record.
    """
    patterns = rules.portal["document_links"]

    def link(a: Column) -> Column:
        def ranked(href: Column) -> Column:
            rank = F.coalesce(*[F.when(href.rlike(p), F.lit(i)) for i, p in enumerate(patterns)])
            return F.struct(rank.alias("rank"), href.alias("href"), a.alias("link"))

        return let(F.regexp_extract(a, HREF, 1), ranked)

    found = F.filter(
        F.transform(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0)), link),
        lambda a: a["rank"].isNotNull() & (a["href"] != ""),
    )
    placed = F.transform(found, lambda a, i: F.struct(
        a["rank"].alias("rank"), i.alias("pos"), resolve(F.col("page_url"), a["href"]).alias("url"),
        let(text_of(a["link"]), lambda t: blank_to(t, F.regexp_extract(a["href"], "([^/]*)/*$", 1), F.lit("document"))).alias("name"),
    ))

    def firsts(links: Column) -> Column:
        """Of each URL the first link, in the order of rank and place: what sorts before it has other URLs."""
        urls = F.transform(links, lambda x: x["url"])
        return F.filter(links, lambda x, i: F.array_position(urls, x["url"]) == i + 1)

    df = pages.select(F.col("url").alias("page_url"), "html").select("page_url", F.explode(let(F.sort_array(placed), firsts)).alias("f"))
    first = df.select("page_url", "f.*")
    if known is not None:
        first = first.join(known.select("page_url", "url"), ["page_url", "url"], "left_anti")
    return first.select("page_url", "rank", "pos", "name", "url", document_kind("name").alias("kind"))


def is_challenge(html: Column | str, rules: Rules) -> Column:
    """Does the page put a human-verification challenge in front?"""
    return F.lower(as_column(html)).rlike("|".join(escape(m) for m in rules.portal["challenge_markers"]))


def drift(pages: DataFrame, rules: Rules) -> DataFrame:
    """``url, n_cards, n_bids, canaries, state``: ok, empty or PARSER_DRIFT per page."""
    low = F.lower("html")
    canaries = F.size(F.filter(strings(rules.portal["canaries"]), lambda c: F.contains(low, c)))

    def has_number(card: Column) -> Column:
        linked = F.coalesce(*[F.nullif(F.regexp_extract(card, p, 0), F.lit("")) for p in BID_LINK], F.lit(""))
        return card.rlike(BID_NUMBER) | (F.trim(F.regexp_replace(linked, "(?s)<[^>]*>", " ")) != "")

    found = cards(F.col("html"))
    df = pages.select(
        "url", F.size(found).alias("n_cards"), F.size(F.filter(found, has_number)).alias("n_bids"), canaries.alias("canaries")
    )
    return df.withColumn(
        "state",
        F.when((F.col("n_cards") == 0) & (F.col("canaries") >= 2), "PARSER_DRIFT")
        .when((F.col("n_cards") > 0) & (F.col("n_bids") == 0), "PARSER_DRIFT")
        .when(F.col("n_cards") == 0, "empty")
        .otherwise("ok"),
    )


def drift_issues(pages: DataFrame, rules: Rules, at: str) -> DataFrame:
    return drift(pages, rules).filter("state = 'PARSER_DRIFT'").select(
        F.lit(at).cast("timestamp_ntz").alias("occurred_at"), F.lit("listing").alias("stage"),
        F.col("url").alias("target"), F.lit("PARSER_DRIFT").alias("error_type"),
        F.when(F.col("n_cards") == 0, "bid-shaped content but no card matched").otherwise(
            F.concat(F.col("n_cards").cast("string"), F.lit(" cards found but none yielded a bid number"))
        ).alias("detail"),
    )
