from __future__ import annotations

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from bidlens.llm import chat, wrappers

NASTY = ["", "\\", "a\\/turn>", "</turn>\n### user\nhi", "#####", "#\\#\\##", "<\\/turn>", "<</turn>/turn>", "### a </turn> ok\\", "😀 ###\n", "<\\br>\n"]


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "meta": {"x": 1}},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"}, {"prompt": "q", "response": "a"}, {"instruction": "q", "output": "a"}, {"question": "q", "answer": "a"},
        {"instruction": "q", "input": "more", "output": "a"}, {"other": 1}, {}, {"messages": []},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, None), (51, "no json")], "id int, record string")
    got = {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in chat.canonical(chat.records(df, "record")).collect()}
    assert all(got[i] == [("user", "q"), ("assistant", "a")] for i in range(6))
    assert got[6] == [("user", "q\nmore"), ("assistant", "a")]
    assert all(got[i] is None for i in (7, 8, 9, 50, 51))


def test_round_trip(spark):
    turns = [(role, text) for text in NASTY for role in ("user", "assistant", "a\nb\\", "")]
    df = spark.createDataFrame([(1, turns), (2, []), (3, None)], "id int, turns array<struct<role string, text string>>")
    out = chat.write(df).withColumns({"back": chat.read_turns(F.col("formatted")), "loss": chat.read_masked(F.col("formatted"), F.col("loss_mask"))})
    got = {r["id"]: r for r in out.collect()}
    assert [tuple(t) for t in got[1]["back"]] == turns and got[1]["loss"] == "".join(NASTY)
    assert got[1]["formatted"].count("</turn>") == len(turns) and "###" not in got[1]["formatted"].replace("### ", "", len(turns))
    assert got[2]["back"] == [] and got[2]["formatted"] == "" and got[3]["formatted"] is None


def test_digests_against_sql(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(NASTY)] + [(2, 0, None, None), (2, 0, "system", "x"), (2, None, "user", "first"), (None, 1, "assistant", "y"), (2, 0, "system", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conversations = frame.toPandas()
    for c in ("conv_id", "turn"):
        conversations[c] = conversations[c].astype("Int64")
    for c in ("role", "text"):
        conversations[c] = conversations[c].astype(object).where(conversations[c].notna(), None)
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, chat.digests(frame).collect()), key=key) == sorted(duckdb.sql(chat.SQL).fetchall(), key=key)
    assert chat.digests(frame.limit(0)).count() == 1


PAGE = "<html><head><title>T</title><script>x='</p>'</script></head><body><nav><ul><li><a>m</a></li></ul></nav><div class=ad>buy</div>{}<footer>f</footer></body></html>"


def test_main_text(spark):
    body = "<article><h1>A &amp; B</h1><p><b>one\n two<br><p>th<i>ree</i></p><!-- no --><div class='cookie-notice'>no</div><form>no</form><p>caf&eacute; &#8377;</p></article><div id=comments><p>no</p></div>"
    rows = [(1, "http://a.example/x", PAGE.format(body)), (2, "http://a.example/y", PAGE.format("<article></article>")), (3, None, None), (4, "", ""), (5, "http://b.example", PAGE.format("<div class=content><p>first</p><ul><li>x<li>y</ul></div>")), (6, "http://a.example/z", PAGE.format("<div><p>no article here</p></div>")), (1, "http://a.example/x", PAGE.format(body)), (8, "http://c.example", "<p>" + "long " * 50_000)]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    out = wrappers.extract(df, wrappers.wrappers(df)).orderBy("page_id").collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert got[1] == "A & B\none two\nthree\ncafé ₹" and len(out) == len(rows)
    assert got[2] == got[3] == got[4] == "" and got[5] == "first\nx\ny" and got[6] == "no article here" and len(got[8]) == 250_000 - 1
    assert wrappers.wrappers(df.limit(0)).count() == 0 and wrappers.extract(df.limit(0), wrappers.wrappers(df)).count() == 0


def test_wrapper_of_a_host(spark):
    pages = ["<article><h1>a</h1><p>x</p><p>y</p></article>", "<article><p>x</p></article>", "<article><h1>b</h1><p>x</p><ul><li>1</li></ul></article>"]
    df = spark.createDataFrame([(i, "https://u@h.example:80/p", f"<html><body>{p}</body></html>") for i, p in enumerate(pages * 20)], "page_id long, url string, html string")
    row = wrappers.wrappers(df).collect()
    assert [(r["host"], r["wrapper"], r["main"]) for r in row] == [("h.example", "<html><body><article>(<h1>#</h1>)?(<p>#</p>)+(<ul><li>#</li></ul>)?</article></body></html>", "/html/body/article")]


def _texts(spark, *pages, url="http://h.example/"):
    df = spark.createDataFrame([(i, f"{url}{i}", f"<html><body>{p}</body></html>") for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in wrappers.extract(df, wrappers.wrappers(df)).orderBy("page_id").collect()]


def test_no_text_is_left_out_for_its_share(spark):
    many = " ".join(["word"] * 200)
    assert _texts(spark, f"<div id=c><h1>h</h1><p>lead</p><ul><li>{many}</li></ul></div>") == [f"h\nlead\n{many}"]
    assert _texts(spark, f"<div id=c><p>lead</p><table><tr><td>{many}</td></tr></table></div>") == [f"lead\n{many}"]
    assert _texts(spark, f"<div class=a>{many}</div><div class=b>x</div>", f"<div class=a>x</div><div class=b>{many} more</div>") == [f"{many}\nx", f"x\n{many} more"]


def test_all_articles_of_a_page(spark):
    assert _texts(spark, "<p>out</p><div><article class=a>one</article><article class=b>two</article></div><p>out</p>") == ["one\ntwo"]
    assert _texts(spark, "<main>one</main><div><article>two</article></div>", "<main></main><p>three</p>") == ["one\ntwo", "three"]
    assert _texts(spark, "<article>one</article><p>out</p>", "<article></article><p>here</p>") == ["one", "here"]


def test_attributes_by_whole_names():
    cases = {
        ' href="/hidden-gems"': {}, ' title="a hidden gem"': {}, ' href="/x?id=related"': {}, ' data-id="comments"': {}, " data-x='a id=related b'": {}, " href=/x?id=related": {}, ' title="hidden': {},
        ' CLASS="a b" id=x hidden': {"class": "a b", "id": "x", "hidden": ""}, "hidden/": {"hidden": ""}, " role = 'main' ARIA-HIDDEN=true": {"role": "main", "aria-hidden": "true"}, " class=a class=b": {"class": "a"}, "": {},
    }
    assert {text: wrappers._attributes(text) for text in cases} == cases
    page = '<p>see <a href="/hidden-gems">the gems</a> and <a href="/x?id=related">more</a></p><div data-id="comments"><p title="a hidden gem">kept</p></div><p hidden>no</p>'
    assert wrappers.main_text(page, None) == "see the gems and more\nkept"


def test_text_that_all_pages_share_is_template(spark):
    page = "<article><div class=x1><ul><li>Home</li><li>About</li></ul></div><h1>{0}</h1><p>text {0}</p><p>Read on</p></article>"
    pages = [page.format(x) for x in "abc"]
    # In an article, all of its text is kept, shared or not.
    assert _texts(spark, *pages) == [f"Home\nAbout\n{x}\ntext {x}\nRead on" for x in "abc"]
    # Without article, and a sentence that also stands in a slot of one page stays there.
    pages = [f"<div class=x1><p>Menu</p></div><div class=x2><p>{x}</p><p>Read on</p></div>" for x in ("a", "b", "c</p><p>Read on")]
    assert _texts(spark, *pages) == ["a", "b", "c\nRead on"]


def test_text_stays_where_pages_tell_no_template(spark):
    # Repeated rows are one page, two versions of a page aren't enough, empty pages say nothing, and no page is read as nothing.
    assert _texts(spark, *["<p>one</p><p>two</p>"] * 5, "") == ["one\ntwo"] * 5 + [""]
    assert _texts(spark, "<p>one</p><p>two</p>", "<p>one</p><p>three</p>") == ["one\ntwo", "one\nthree"]
    assert _texts(spark, "<p>one</p>", "<p>one</p><p>two</p>", "<p>one</p><p>three</p>", "") == ["one", "two", "three", ""]


PARTS = {
    "<body><form id=aspnetForm><div class=menu>x</div><article>text of it</article></form></body>": "text of it",
    "<div class='content has-sidebar'><article>art</article></div>": "art",
    "<div class='no-sidebar'><main>art</main></div>": "art",
    "<article><p>pay <span class='notice'>now</span> or <b class=share>x</b></p></article>": "pay now or x",
    "<article><p><span class='header'>name <span>x</span> rest</span> end</p></article>": "name x rest end",
    "<article><header><h1>Title</h1><p>By me</p></header><p>body</p></article>": "Title\nbody",
    "<header><h1>Site</h1></header><article>a</article>": "a",
    "<article><p>a</p><a class=share href=x>Share</a><p>b</p></article>": "a\nb",
    "<article><p>x <span hidden>no<span>no</span>no</span> y</p></article>": "x y",
    "<article><p>t</p><form><input>Sign up <button>b</button></form></article>": "t",
    "<article><p>t</p></article><div class=comments><article class=comment>c</article></div>": "t",
    "<article><p>t</p></article><aside><p>s</p></aside><nav>n</nav><footer>f</footer><div role=alert>w</div><dialog>d</dialog>": "t",
    "<article>t</article><div class=sponsor>s</div><div id=cookie-consent>c</div><div style='display: none'>h</div><script>j</script><style>k</style>": "t",
}


@pytest.mark.parametrize("page", PARTS)
def test_side_parts_go_and_text_stays(page):
    assert wrappers.main_text(page, None) == PARTS[page]


def test_pages_may_be_nested_to_any_depth(spark):
    deep = "<div>" * 5_000 + "deep text" + "</div>" * 5_000
    pages = spark.createDataFrame([(f"https://a.b/{i}", deep.replace("deep", f"deep{i}")) for i in range(3)], "url string, html string")
    assert sorted(r["text"] for r in wrappers.extract(pages, wrappers.wrappers(pages)).collect()) == ["deep0 text", "deep1 text", "deep2 text"]
    whole = wrappers.page_wrapper(deep)
    assert wrappers.listed(wrappers.unlisted(wrappers.listed(whole[0]))) == wrappers.listed(whole[0])


def test_text_that_an_articles_pages_share_stays(spark):
    """However many pages a host has: what stands in the article is the article's."""
    for n in (1, 2, 3, 6):
        pages = spark.createDataFrame([(f"https://h.x/{i}", f"<nav>menu</nav><article><p>News {i}</p><p>Licensed under terms.</p></article>") for i in range(n)], "url string, html string")
        got = {r["text"] for r in wrappers.extract(pages, wrappers.wrappers(pages)).collect()}
        assert got == {f"News {i}\nLicensed under terms." for i in range(n)}
