import html
import math
import random
import re

import pytest

from tape.llm.html import Page, extract, noise_nodes, style_tree
from tape.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def text(page):
    return Page(page, {}).main_text(None)


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<p>a<br>b <b>c</b>d</p>", "a b cd"),
    ("<body><nav>menu</nav><div>x</div><footer>f</footer></body>", "x"), ("<article><h1>T</h1><p>a&nbsp;&#233;&eacute;&lt;b&gt;</article>after", "T\na éé<b>"),
    ("<script>var a='</p><p>no';</script><p>yes", "yes"), ("<style>p{}</style><!-- <p>no</p> --><p>yes<!-- cut off", "yes"),
    ("<p>cut off <b", "cut off"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<article><p>x</p><div class='comments'><p>no</p></div><aside>no</aside><form>no</form></article>", "x"),
    ("<article><header><h1>T</h1></header>x<footer>no</footer></article><div id=sidebar>no</div>", "T\nx"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
    ('<p title="a > b" class="x">q</p>', "q"), ('<a href="x>t</a><p>open quote', "t\nopen quote"), ("</div></p>stray", "stray"), ("<div hidden>no</div><div style='display: none'>no</div>yes", "yes"),
    ("<div class='cookie-notice'>no</div><div class='ad'>no</div><div class=added>yes</div>", "yes"), ("<TITLE>no</TITLE><P>A\n\t b</P>", "A b"),
])
def test_pages(page, want):
    assert text(page) == want


def test_a_very_long_page_and_deep_nesting():
    assert len(text("<div>" * 3000 + "x " * 100_000 + "</div>" * 3000)) == 199_999
    assert text("<p" + " a='" * 20_000) == ""


def test_given_pages_equal_a_plain_reading(spark):
    """All test pages have their text in one article of h1 and p blocks."""
    d = "/root/testdata/sf0.01"
    source = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = QUERIES["op1_html_style_tree"](spark, d).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert (r.text, r.n_chars) == (want, len(want))


def site(n, host="a.com"):
    """Pages without telling names: a template and one block of content."""
    return [(k, f"http://{host}/{k}", f"<div class=q><div class=top><span>Home</span></div><div class=mid><p>Story {k} of {host} tells {k * 7}.</p><p>More on {k}.</p></div><div class=end><p>All rights reserved</p></div></div>") for k in range(n)]


def test_template_branches_of_a_site_go(spark):
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(site(30), SCHEMA)).collect()}
    assert got == {k: f"Story {k} of a.com tells {k * 7}.\nMore on {k}." for k in range(30)}


def test_few_pages_are_no_evidence(spark):
    got = [r.text for r in extract(spark.createDataFrame(site(3), SCHEMA)).collect()]
    assert all("All rights reserved" in t and "Home" in t for t in got)


def test_sites_are_judged_apart_and_copies_keep_their_text(spark):
    copies = [(100 + k, f"http://b.com/{k}", "<div class=end><p>All rights reserved</p></div>") for k in range(20)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(site(20) + copies, SCHEMA)).collect()}
    assert all("reserved" not in got[k] for k in range(20)) and all(got[100 + k] == "All rights reserved" for k in range(20))


def test_articles_keep_what_all_pages_of_a_host_share(spark):
    """Near copies: the same h1 and passage in the articles, the same notice around them."""
    marks = ("<article>", "</article>"), ("<main>", "</main>"), ("<div role=main>", "</div>"), ("<div role=article>", "</div>")
    for start, end in marks:
        for unique in (True, False):
            rows = [(k, f"http://c.com/{k}", f"<div class=top>Home</div>{start}<h1>Same</h1><h2>Summary</h2><p>{k if unique else 'one'} story</p>{end}<div class=end>All rights reserved</div>") for k in range(8)]
            got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
            assert got == {k: f"Same\nSummary\n{k if unique else 'one'} story" for k in range(8)}


@pytest.mark.parametrize("n, make, want", [
    (8, lambda k: f"<div class=x>Text {k}</div>", lambda k: f"Text {k}"), (10, lambda k: f"<p>Only {k}</p>", lambda k: f"Only {k}"),
    (9, lambda k: f"<article><p>Story {k}</p></article>", lambda k: f"Story {k}")])
def test_hosts_without_a_noise_node(spark, n, make, want):
    rows = [(k, f"http://d.com/{k}", make(k)) for k in range(n)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: want(k) for k in range(n)}


def test_the_tree_judges_what_is_beside_the_article(spark):
    page = "<div class=top>Home</div><div class=lead>Lead of {k}: {k}{k}</div><article><p>Story {k}</p></article><div class=end>All rights reserved</div>"
    for n, lead in ((20, True), (3, False)):
        rows = [(k, f"http://e.com/{k}", page.format(k=k)) for k in range(n)]
        got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {k: (f"Lead of {k}: {k}{k}\n" if lead else "") + f"Story {k}" for k in range(n)}


def tree_by_hand(pages):
    """(chain of labels -> m, styles, texts, presentation, content) of plain
    pages in the form [(label, text or [children])]."""
    seen = {}

    def walk(node, chain, page):
        label, inner = node
        chain = (*chain, label)
        kids = inner if isinstance(inner, list) else []
        seen.setdefault(chain, {}).setdefault(page, []).append((" ".join(c[0] for c in kids), None if isinstance(inner, list) else inner))
        for c in kids:
            walk(c, chain, page)

    for p, roots in enumerate(pages):
        for r in roots:
            walk(r, (), p)
    out = {}
    for chain, by in seen.items():
        m = len(by)
        styles, texts = {}, {}
        for shown in by.values():
            style = " ".join(s for s, _ in shown if s)
            styles[style] = styles.get(style, 0) + 1
            for t in {t for _, t in shown if t}:
                texts[t] = texts.get(t, 0) + 1
        log = (lambda x: math.log(x) / math.log(m)) if m > 1 else (lambda x: 0.0)
        presentation = -sum(k / m * log(k / m) for k in styles.values()) if m > 1 else 1.0
        content = 1 - sum(log(k) for k in texts.values()) / len(texts) if m > 1 and texts else 1.0
        out[chain] = (m, len(styles), len(texts), round(presentation, 9), round(content, 9))
    return sorted(out.values())


def test_entropies_equal_a_count_by_hand(spark):
    r = random.Random(2)
    pages = [[("div", [("p", r.choice(["same", "same", f"own {k}"]))] * 1 + [("h2", f"t{k % 3}")] * r.randint(0, 1) + [("section", [("p", f"x{k // 2}")] * 1)] * r.randint(0, 1))] for k in range(24)]
    mark = lambda n: f"<{n[0]}>" + ("".join(map(mark, n[1])) if isinstance(n[1], list) else n[1]) + f"</{n[0]}>"
    html_rows = [("h.com", "".join(map(mark, p))) for p in pages]
    got = style_tree(spark.createDataFrame(html_rows, "host string, html string")).collect()
    assert sorted((x.m, x.styles, x.texts, round(x.presentation, 9), round(x.content, 9)) for x in got) == tree_by_hand(pages)


def test_style_tree_counts(spark):
    tree = {(r.m, r.styles, r.texts): r for r in style_tree(spark.createDataFrame(site(10), SCHEMA).selectExpr("'a.com' AS host", "html")).collect()}
    assert {m for m, _, _ in tree} == {10}
    assert tree[10, 1, 20].content == 1.0 and tree[10, 1, 1].content == 0.0
    assert noise_nodes(style_tree(spark.createDataFrame(site(10), SCHEMA).selectExpr("'a.com' AS host", "html"))).count() == 1


def test_nulls_repeats_clashes_empty(spark):
    rows = [(1, None, None, "t"), (None, "http://a.com", "<p>x</p>", "t"), (1, "no scheme", "<p>y</p>", None), (1, "no scheme", "<p>y</p>", None), (2, "http://a.com/q", "", "t")]
    pages = spark.createDataFrame(rows, SCHEMA + ", text string")
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (None, "http://a.com", "x", 1), (1, "no scheme", "y", 1), (1, "no scheme", "y", 1), (2, "http://a.com/q", "", 0)], key=str)
    assert extract(pages.limit(0)).count() == 0
