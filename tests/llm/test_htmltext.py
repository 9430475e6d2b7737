from __future__ import annotations

import html as H
import re
import time

import pytest

from aerolith.llm import htmltext as h

PAGE_SCHEMA = "page_id long, url string, html string"


def article_text(page: str) -> str:
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(H.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", inner)))
    return "\n".join(b for b in blocks if b)


def test_supplied_pages_give_their_articles(table):
    pages = table("pages")
    wanted = {r.page_id: article_text(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in h.main_text_report(pages).collect()}
    assert got == {k: (t, len(t)) for k, t in wanted.items()}


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &lt;text&gt; &amp no tags", "plain <text> & no tags"),
        ("<article><h1>T</h1><p>a<br>b  c<p>d <i>e</i>f</article>after", "T\na b c\nd ef"),
        ("<main><nav>m</nav><p>x</p></main><p>y", "x"),
        ("<p>one<div class='side sidebar'>s</div><ul><li>two<li>three</ul><table><tr><td>4<td>5</table>", "one\ntwo\nthree\n4\n5"),
        ("<article>a<div id=comments>c</div><aside>s</aside><form>f</form><!-- x --><p hidden>h</p></article>", "a"),
        ("<article class=comment>no</article><article>yes</article>", "yes"),
        ("<script>if (a</b) '<p>'</script><style>p{}</style><p>shown", "shown"),
        ("<title>t</title><body class='has-nav'><p>x</p><div role=navigation>n</div><div style='display: none'>d</div>", "x"),
        ("<p>a < b <3 <", "a < b <3 <"),
        ("<P TITLE='a > b'>q</P><p title=\"x>y\">r", "q\nr"),
        ("<b><div>x</b>y</div>z", "xy\nz"),
        ("<main><h1>Head</h1><p>A long paragraph of the page itself</p><article>teaser</article></main>", "Head\nA long paragraph of the page itself\nteaser"),
        ("<main><p>intro</p><article><h1>Head</h1><p>Most of the text</p></article></main>", "Head\nMost of the text"),
        ("<body><form action=x><div><h1>T</h1><p>All of the page</p></div><input></form></body>", "T\nAll of the page"),
        ("<form><nav>menu</nav><article><p>story</p><form>small</form></article></form>", "story"),
        ("<aside><article>teaser</article></aside><p>the story itself</p>", "the story itself"),
        ("<main><h1 class='header'>Title</h1><p class='social'>one<p class='related'>two<p class=ad>buy<div class=share>s</div></main>", "Title\none\ntwo"),
        ("a<p>&#x41;&nbsp;&eacute;&#128512;", "a\nA é😀"),
    ],
)
def test_rules(page, text):
    assert h.Page(page).main_text(set()) == text


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "with-header", "social-layout", "page-with-comments", "sidebar"])
@pytest.mark.parametrize("inner", ["<article><p>story</article>", "<main><p>story</main>", "<p>story"])
def test_wrappers_of_the_main_part_stay(name, inner):
    side = "<div class='sidebar-left'>s</div>"
    for attribute in ("class", "id"):
        page = f"<div {attribute}='{name}'>{inner}{'' if name == 'sidebar' else side}</div>{side}"
        assert h.Page(page).main_text(set()) == "story"


def site(host, n, body, first=0):
    return [(first + i, f"https://user@{host}:8080/{i}?q", body.replace("#", str(i))) for i in range(n)]


def test_site_templates_are_counted_per_host(spark):
    plain = "<div><a>Home</a> of us</div><div><p>Story # text</p><p>Quote</p></div><div><p>Bye now</p></div>"
    article = "<article><p>Story #</p><p>Quote</p><div>Share this with <b>all</b></div></article>"
    rows = site("t.example", 30, plain) + site("A.example", 30, article, 1000) + site("few.example", 2, plain, 2000)
    rows += [(3000, None, plain), (3001, "relative/x", "<p>a"), (None, "http://h/", None)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).withColumn("text", h.F.lit("mine")).withColumn("host", h.F.lit(1))
    out = h.extract_main_text(pages)
    assert out.columns == ["page_id", "url", "html", "host", "text"]
    got = {r.page_id: r.text for r in out.collect()}
    assert got[3] == "Story 3 text"
    assert got[1003] == "Story 3\nQuote"
    assert got[2001] == "Home of us\nStory 1 text\nQuote\nBye now"
    assert got[3000] == "Home of us\nStory # text\nQuote\nBye now" and got[3001] == "a" and got[None] == ""


def test_copies_and_shared_passages_are_no_templates(spark):
    copy = "<div><h1>Title</h1><p>The whole story</p><ul><li>a point</li></ul></div>"
    inner = "<main><h1>Own</h1><p>Text</p></main><p>Bye now</p>"
    near = "<div><p>Nearly the same story on each</p></div><p>seen #</p>"
    own = "<div><p>Only # here</p></div><div>Menu of us</div><p>Quote</p>"
    rows = site("copies.example", 3, copy) + site("main.example", 3, inner, 10)
    rows += site("near.example", 3, near, 100) + site("near.example", 30, "<p>other #</p>", 110)
    rows += site("own.example", 3, own, 200) + site("own.example", 30, "<p>other #</p>", 210)
    got = {r.page_id: r.text for r in h.extract_main_text(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert [got[i] for i in range(3)] == ["Title\nThe whole story\na point"] * 3
    assert [got[i] for i in (10, 11, 12)] == ["Own\nText"] * 3
    assert [got[i] for i in (100, 102)] == ["Nearly the same story on each\nseen 0", "Nearly the same story on each\nseen 2"]
    assert got[200] == "Only 0 here\nMenu of us\nQuote"  # three pages are not many


def test_a_block_on_few_of_many_pages_is_no_template(spark):
    rows = site("big.example", 200, "<div><p>page # only</p></div>")
    for i in (5, 50, 150):
        rows[i] = (i, rows[i][1], f"<div><p>A paragraph on three pages</p></div><p>own {i}</p>")
    menu = "<div><a>Home</a><a>News</a></div>"
    rows += [(1000 + i, u, menu + h) for i, u, h in site("menu.example", 12, "<p>story #</p>")]
    rows += [(2000 + i, u, menu + h) for i, u, h in site("small.example", 4, "<p>story #</p>")]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).withColumnRenamed("html", "HTML").withColumnRenamed("page_id", "id")
    got = {r.id: r.text for r in h.extract_main_text(pages).collect()}
    assert [got[i] for i in (5, 150)] == ["A paragraph on three pages\nown 5", "A paragraph on three pages\nown 150"]
    assert got[1003] == "story 3" and got[2003] == "HomeNews\nstory 3"


@pytest.mark.parametrize(
    "page",
    ["<div>" * 20_000 + "x", "<b>" * 20_000 + "x" + "</b>" * 20_000, "<p>a" * 20_000, "<" * 50_000, '<a href="' * 20_000, "<!--" * 20_000 + ">", "&" * 50_000, "<a x='" + "<i>" * 20_000],
)
def test_odd_markup_takes_linear_time(page):
    began = time.process_time()
    h.Page(page).main_text(set())
    assert time.process_time() - began < 5


def test_empty_table_and_repeats(spark):
    none = spark.createDataFrame([], PAGE_SCHEMA)
    assert h.main_text_report(none).count() == 0
    twice = spark.createDataFrame([(1, "http://h/", "<article>a")] * 2, PAGE_SCHEMA)
    assert [r.text for r in h.main_text_report(twice).collect()] == ["a", "a"]
