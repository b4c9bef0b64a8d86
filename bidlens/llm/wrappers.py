"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over tags: each element holds its
kinds of children in order, each of them once, optional (?), repeated (+) or
both (*), text slots (#), or, where pages order them differently, a repeated
group of optional ones. It starts as one page and is aligned with the next ones:
what both have is merged element by element, what only one has becomes
optional, what stands several times is folded into a repeated group. Wrappers
align with wrappers just so, hence pages are folded where they are read, and the
partial wrappers of a host are folded again, first by host and salt, then by
host, one after the other: a host with a third of all pages sends a few small
rows from each task.

Text is aligned too, as tokens of path and text: what all pages of a host share is
template, what differs is a slot. The wrapper tells where the pages keep their
text: in the lowest element that holds all article and main elements with text,
or else anywhere. From each page, that element's slots are read, without those of
menus, headers, footers and the like, which are told by tag, role, class and id.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Collection, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import count
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

SALTS = 64
#: So many different pages of a host tell template text from slots; with fewer, versions of one page would lose what they share.
LEAST_PAGES = 3
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
#: One whole attribute; a value without its closing quote goes to the end of the tag.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>][^\s>]*)))?|\"[^\"]*\"|'[^']*'")
_USED = set("class id role hidden aria-hidden style".split())
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "select", "xmp", "noembed", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line of text; all others start a new block.
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr input".split())
#: What an opening tag closes by itself, and the elements within which that holds.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "body": {"head"}}
_SCOPE = set("ul ol dl table html body article section div main aside nav form td th blockquote".split())
_SIDE_TAGS = set("head nav header footer aside form dialog menu button object canvas".split())
_SIDE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar status form".split())
_SIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletters?|subscribe|subscription|signup|login"
    r"|sidebars?|side-?bar|menus?|nav|navbar|navigation|breadcrumbs?|footers?|headers?|masthead|topbar|comments?|commentlist|respond|replies|disqus|related|recommended|share|sharing|social|widgets?|toolbar|pagination|pager|disclaimer|search|form)(?:$|[\s_-])",
    re.I,
)


#: What such a name says of the element's neighbours or state, not of the element.
_ABOUT_OTHERS = re.compile(r"^(?:has|no|with|without|hide|show|is|not)[_-]", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _attributes(text: str) -> dict[str, str]:
    """The attributes that are looked at, by exact name; of several with a name the first counts."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text) if text else ():
        if name.lower() in _USED:
            found.setdefault(name.lower(), a or b or c)
    return found


def _side(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is a menu, header, footer, sidebar, notice, advert, form, a reader's comment, or hidden."""
    if tag in _SIDE_TAGS or attributes.get("role", "").lower() in _SIDE_ROLES:
        return True
    if tag in ("html", "body", "main") or _holds_text(tag, attributes):
        return False
    if not attributes:
        return False
    if _hidden(attributes):
        return True
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    return any(_SIDE_NAMES.search(name) for name in names if not _ABOUT_OTHERS.match(name))


def _holds_text(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is an article that isn't a comment or a teaser, or the main part."""
    if tag == "main" or attributes.get("role", "").lower() == "main":
        return True
    return tag == "article" and not re.search(r"comment|repl(?:y|ies)|related|advert|sponsor", f"{attributes.get('class', '')} {attributes.get('id', '')}", re.I)


def _hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I))


def _key(tag: str, attributes: dict[str, str]) -> str:
    """An element's kind: its tag and first class or id, with digits made alike."""
    if attributes.get("role", "").lower() == "main":
        return "main"
    names = (attributes.get("class") or attributes.get("id") or "").split()
    return tag + ("." + re.sub(r"\d+", "0", names[0]).replace("/", "") if names else "")


# A wrapper's element: [characters of text below, optional, repeated, children differ in order, {kind: element}].
Element = list


def element() -> Element:
    return [0, 0, 0, 0, {}]


def align(a: Element, b: Element) -> Element:
    """The wrapper of what either matches; ``b`` is folded into ``a``, which is changed and returned.

    Pairs of elements wait on a list, so pages may be nested to any depth.
    """
    waiting = [(a, b)]
    while waiting:
        mine, other = waiting.pop()
        ours, theirs = mine[4], other[4]
        mine[0] += other[0]
        for i in (1, 2, 3):
            mine[i] |= other[i]
        shared = [k for k in ours if k in theirs]
        if shared != [k for k in theirs if k in ours]:
            mine[3] = 1
        for kind in ours:
            if kind in theirs:
                waiting.append((ours[kind], theirs[kind]))
            else:
                ours[kind][1] = 1
        if len(shared) == len(theirs):
            continue
        # New kinds come after the shared kind that they follow.
        merged, follow, last = {}, {}, None
        for kind in theirs:
            if kind in ours:
                last = kind
            else:
                theirs[kind][1] = 1
                follow.setdefault(last, []).append(kind)
        for kind in (None, *ours):
            if kind is not None:
                merged[kind] = ours[kind]
            for new in follow.get(kind, ()):
                merged[new] = theirs[new]
        mine[4] = merged
    return a


def listed(root: Element) -> list[list]:
    """An element and all below as rows [depth, kind, characters, optional, repeated, in any order], parents first."""
    out, waiting = [], [(0, "", root)]
    while waiting:
        depth, kind, e = waiting.pop()
        out.append([depth, kind, *e[:4]])
        waiting += [(depth + 1, k, x) for k, x in reversed(e[4].items())]
    return out


def unlisted(rows: list[list]) -> Element:
    """The element that ``listed`` wrote."""
    above: list[Element] = []
    for depth, kind, *values in rows:
        e = [*values, {}]
        del above[depth:]
        if above:
            above[-1][4][kind] = e
        above.append(e)
    return above[0]


def expression(root: Element) -> str:
    """The wrapper of what stands below ``root``, in writing."""
    parts: list[str] = []
    # Elements to write, and what to write after those before it.
    waiting: list = [(kind, e, False) for kind, e in reversed(root[4].items()) if kind != "#"]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        kind, e, loose = item
        optional = e[1] or loose
        if kind == "#":
            parts.append("#?" if optional else "#")
            continue
        mark = ("*" if optional else "+") if e[2] else ("?" if optional else "")
        parts.append(f"(<{kind}>" if mark else f"<{kind}>")
        if e[3]:
            parts.append("(")
        waiting.append((")*" if e[3] else "") + f"</{kind}>" + (f"){mark}" if mark else ""))
        waiting += [(k, x, bool(e[3])) for k, x in reversed(e[4].items())]
    return "".join(parts)


class Block(NamedTuple):
    """A text block: a hash of its element's path, its text, and whether it stands below the path that was asked for."""

    path: int
    text: str
    inside: bool


def _hash(*parts: object) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@lru_cache(maxsize=100_000)
def _path_hash(above: int, kind: str) -> int:
    return _hash(above, kind)


class _Open:
    """An open element. ``side``: the side parts that it stands in, itself included; ``matched``: how many kinds of the asked path lead to it."""

    __slots__ = ("tag", "kind", "element", "side", "hash", "depth", "matched", "below", "inline", "article")

    def __init__(self, tag: str, kind: str, above: "_Open | None", side: frozenset, path: tuple[str, ...]):
        self.tag, self.kind, self.element, self.side = tag, kind, element(), side
        self.hash = _path_hash(above.hash, kind) if above else 0
        self.depth = above.depth + 1 if above else 0
        on = above is None or (above.matched == above.depth and above.depth < len(path) and path[above.depth] == kind)
        self.matched = self.depth if on else above.matched
        self.below = above is not None and above.below or self.matched == len(path)
        self.inline = 0
        self.article = above is not None and above.article


def read(page: str | None, path: tuple[str, ...] = ()) -> tuple[Element, list[Block]]:
    """A page's own wrapper, and its text blocks outside side parts, in order.

    A form that turns out to hold an article or main part is no side part, nor is
    the heading in an article's own header. Inline elements with a side part's name
    go if they make up all of a block; within a sentence they stay. What is hidden goes.
    """
    page = page or ""
    top = _Open("", "", None, frozenset(), path)
    stack = [top]
    found: list[tuple[Block, frozenset]] = []
    held: list[str] = []
    inline: list[tuple[str, int]] = []  # open inline elements: 1 with a side part's name, 2 hidden
    plain = False  # whether held text stands outside side parts
    kept: set[int] = set()  # side parts that hold the article
    numbers = count()

    def flush() -> None:
        nonlocal plain
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text and plain:
                child = element()
                child[0] = len(text)
                found.append((Block(stack[-1].hash, text, stack[-1].below), stack[-1].side))
                if not stack[-1].side:
                    put(stack[-1].element, "#", child)
        plain = False

    def put(parent: Element, kind: str, child: Element) -> None:
        kinds = parent[4]
        if kind in kinds:
            if next(reversed(kinds)) != kind:
                parent[3] = 1
            child[2] = 1
            align(kinds[kind], child)
        else:
            kinds[kind] = child

    def close() -> None:
        flush()
        closed = stack.pop()
        del inline[closed.inline :]
        closed.element[0] = sum(x[0] for x in closed.element[4].values())
        put(stack[-1].element, closed.kind, closed.element)

    def hold(text: str) -> None:
        nonlocal plain
        state = max(x for _, x in inline) if inline else 0
        if text and state < 2:
            held.append(text)
            plain = plain or (state == 0 and not text.isspace())

    at, size = 0, len(page)
    while at < size:
        match = _TAG.search(page, at)
        if match is None:
            hold(page[at:])
            break
        hold(page[at : match.start()])
        at = match.end()
        shut, tag, rest = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not tag:
            continue  # a comment or declaration
        tag = tag.lower()
        if shut:
            if tag in _INLINE:
                for i in range(len(inline) - 1, stack[-1].inline - 1, -1):
                    if inline[i][0] == tag:
                        del inline[i:]
                        break
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            for _ in range(len(stack) - depth if depth else 0):
                close()
            if not depth:
                flush()
            continue
        if tag in _RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in _INLINE:
            if tag == "br":
                hold(" ")
            elif tag not in _VOID and not rest.endswith("/"):
                attributes = _attributes(rest) if rest else {}
                inline.append((tag, 2 if _hidden(attributes) else int(bool(attributes) and _side(tag, attributes))))
            continue
        flush()
        if tag in _VOID:
            continue
        if stack[-1].tag == "p":  # any block closes a paragraph
            close()
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in _CLOSES.get(tag, ()):
                while len(stack) > i:
                    close()
            elif stack[i].tag in _SCOPE:
                break
        attributes = _attributes(rest) if rest else {}
        above = stack[-1]
        side = above.side
        if _side(tag, attributes):
            side = side | {(next(numbers), tag if tag in ("form", "header") else "", above.article)}
        here = _Open(tag, _key(tag, attributes), above, side, path)
        if _holds_text(tag, attributes):
            here.article = True
            kept.update(n for n, what, _ in side if what == "form")
        if tag in _HEADINGS and side and all(what == "header" and article for _, what, article in side):
            here.side = frozenset()
        here.inline = len(inline)
        stack.append(here)
        if rest.endswith("/") and tag not in ("p", "div"):
            close()
    while len(stack) > 1:
        close()
    flush()
    top.element[0] = sum(x[0] for x in top.element[4].values())
    return top.element, [block for block, side in found if all(n in kept for n, _, _ in side)]


def main_path(root: Element) -> str:
    """Where a wrapper keeps its main text: the lowest element with all its articles and mains that have text; "", the whole page, if it has none."""
    shared: list[str] | None = None
    path: list[str] = []
    waiting: list[tuple[int, str, Element]] = [(0, kind, e) for kind, e in reversed(root[4].items())]
    while waiting:
        depth, kind, e = waiting.pop()
        if kind == "#" or not e[0]:
            continue
        del path[depth:]
        path.append(kind)
        if kind.partition(".")[0] in ("article", "main"):
            if shared is None:
                shared = list(path)
            while shared != path[: len(shared)]:
                shared.pop()
        else:
            waiting += [(depth + 1, k, x) for k, x in reversed(e[4].items())]
    return "".join(f"/{kind}" for kind in shared or ())


# A host's wrapper: [root element, the least hashes of its different pages (LEAST_PAGES at most), text tokens of all pages so far].
Wrapper = list


def tokens(blocks: list[Block]) -> list[int]:
    """A token for each block: a hash of its path, its text and how often both stood before, so that tokens of a page differ."""
    seen: Counter[tuple[int, str]] = Counter()
    out = []
    for block in blocks:
        out.append(_hash(block.path, block.text, seen[block[:2]]))
        seen[block[:2]] += 1
    return out


def page_wrapper(page: str | None) -> Wrapper:
    root, blocks = read(page)
    found = sorted(tokens(blocks))
    return [root, [int.from_bytes(blake2b(json.dumps(found).encode(), digest_size=8).digest(), "big", signed=True)] if found else [], found]


def merge(a: Wrapper, b: Wrapper) -> Wrapper:
    """Elements are aligned, and text that either lacks is no longer template; pages without text say nothing of it."""
    align(a[0], b[0])
    a[2] = sorted(set(a[2]) & set(b[2])) if a[1] and b[1] else a[2] or b[2]
    a[1] = sorted({*a[1], *b[1]})[:LEAST_PAGES]
    return a


def template(wrapper: Wrapper) -> list[int]:
    """Tokens of the text that all pages of a host share; all other text is a slot.

    Where articles or main parts say what the text is, all of theirs is kept, shared or not.
    """
    return wrapper[2] if len(wrapper[1]) >= LEAST_PAGES and not main_path(wrapper[0]) else []


def has(root: Element, path: str) -> bool:
    """Whether a page has text below ``path``."""
    for kind in path.split("/")[1:]:
        if kind not in root[4]:
            return False
        root = root[4][kind]
    return root[0] > 0


def main_text(page: str | None, path: str | None, template: Collection[int] = ()) -> str:
    """The slots' text blocks below ``path``, joined by line feeds.

    A page without text there is read by its own wrapper, one that holds nothing
    but template text there is read with it.
    """
    root, blocks = read(page, _kinds(path))
    if path is None or not has(root, path):
        root, blocks = read(page, _kinds(main_path(root)))
    inside = [(i, block.text) for i, block in enumerate(blocks) if block.inside]
    if template:
        known, found = set(template), tokens(blocks)
        inside = [(i, text) for i, text in inside if found[i] not in known] or inside
    return "\n".join(text for _, text in inside)


def _kinds(path: str | None) -> tuple[str, ...]:
    return tuple((path or "").split("/")[1:])


def host(url: Column) -> Column:
    """A URL's host in lower case; "" where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_ROWS = pa.schema([("host", pa.string()), ("wrapper", pa.string())])


def _loaded(text: str) -> Wrapper:
    rows, *rest = json.loads(text)
    return [unlisted(rows), *rest]


def _emit(found: dict[str, Wrapper]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([json.dumps([listed(w[0]), *w[1:]], ensure_ascii=False) for w in found.values()], pa.string())], schema=_ROWS)


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, Wrapper] = {}
        for name, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            other = page_wrapper(page.as_py())
            found[name] = merge(found[name], other) if name in found else other
        if found:
            yield _emit(found)


def _fold_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host: one wrapper is held at a time."""
    name, wrapper = None, None
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            other = _loaded(text.as_py())
            if key == name:
                wrapper = merge(wrapper, other)
            else:
                if wrapper is not None:
                    yield _emit({name: wrapper})
                name, wrapper = key, other
    if wrapper is not None:
        yield _emit({name: wrapper})


def infer(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: host, wrapper (as JSON)."""
    rows = df.select(host(F.col(url)).alias("host"), F.col(html).cast("string").alias("html")).mapInArrow(_fold_pages, "host string, wrapper string")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    for keys in (["host", "salt"], ["host"]):
        rows = rows.repartition(*keys).sortWithinPartitions(*keys, "wrapper").select("host", "wrapper").mapInArrow(_fold_sorted, "host string, wrapper string").withColumn("salt", F.lit(0))
    return rows.select("host", "wrapper")


def wrappers(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: host, wrapper (the regular expression), main (path of the element with the main text), template (tokens of the text that all its pages share)."""

    @arrow_udf("struct<wrapper string, main string, template array<bigint>>")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [_loaded(x.as_py()) for x in batch]
            written = [expression(w[0]) for w in found]
            yield pa.StructArray.from_arrays([pa.array(written, pa.string()), pa.array([main_path(w[0]) for w in found], pa.string()), pa.array([template(w) for w in found], pa.list_(pa.int64()))], names=["wrapper", "main", "template"])

    return infer(df, url, html).select("host", describe("wrapper").alias("d")).select("host", "d.wrapper", "d.main", "d.template")


def extract(df: DataFrame, found: DataFrame, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of each page ("" if none), by the wrappers ``found``.

    Character references are decoded, white space within a block becomes one
    space, blocks are joined by line feeds in page order. A null or empty page has
    no text; pages without a host, or of a host without a wrapper, are read like
    any other by what they hold. Repeated rows stay; a column that has the
    output's name is replaced.
    """

    @arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, paths, shared in batches:
            yield pa.array([main_text(p.as_py(), m.as_py(), t.as_py() or ()) for p, m, t in zip(pages, paths, shared, strict=True)], pa.string())

    rest = [c for c in df.columns if c.lower() != text.lower()]
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), host(df[url]).alias("host"))
    rows = rows.join(found.select("host", "main", "template"), "host", "left")
    return rows.select("_row", run(F.col("_row").getField(html).cast("string"), F.col("main"), F.col("template")).alias("_text")).select(*[F.col("_row").getField(c).alias(c) for c in rest], F.col("_text").alias(text))
