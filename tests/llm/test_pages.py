import html
import re

import pytest

from tidemark.llm import pages
from tidemark.llm.queries import op4_html_extraction, table

SF_DIR = "/root/testdata/sf0.01"


def test_the_query_gives_the_articles(spark):
    raw = {r.page_id: r.html for r in table(spark, SF_DIR, "pages").collect()}
    got = op4_html_extraction(spark, SF_DIR).collect()
    assert len(got) == len(raw)
    for r in got:
        part = re.search(r"<article>(.*?)(?:</article>|\Z)", raw[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", part))
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a<p>b", "a\nb"),
        ("<div>x <b>y</b>z<br>w</div>", "x yz w"),
        ("<header>H</header><main><h1>T</h1><p>one &amp two&nbsp;3</p><div class='user-comments'>c</div></main>", "T\none & two 3"),
        ("<article><p>a < b</p><ul><li>1<li>2</ul><form>f</form></article><footer>f</footer>", "a < b\n1\n2"),
        ("<script>if(a<b){'</p>'}</script><style>p{}</style>t<!-- no > -->u", "tu"),
        ("<a title='x>y' href=\"z\">k</a><nav>n</nav><aside>s</aside>", "k"),
        ("<article><header><h1>T</h1></header><p>q</article><div role=banner>b</div>", "T\nq"),
        ("<p>unclosed <b", "unclosed"),
        ("<div class=\"cookie-notice\">c</div><div id=sidebar>s</div><p hidden>h</p>x", "x"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<a href=\"broken>text", "text"),
        ("<div class=site-header>h</div><p>x</p><article><div class=header>T</div><p>y</article>", "T\ny"),
        ("<div class=site-header>h</div><p>x</p>", "x"),
        ("&lt;p&gt; &#233; &eacute;", "<p> é é"),
    ],
)
def test_texts_of_pages(page, text):
    assert pages.main_text(page) == text


def test_deep_nesting_needs_no_recursion():
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000
    assert pages.main_text(deep, frozenset([1])) == "x"


def test_subtrees_on_most_pages_of_a_host_go(spark):
    def page(host, i):
        return (f"http://{host}/{i}", f"<div class=top><i>Same</i> line</div><p>Text {host} {i}</p><p>Stay</p><div>{i % 3} rare</div>")

    rows = [(i, *page("many.example", i)) for i in range(30)]
    rows += [(100 + i, *page("few.example", i)) for i in range(5)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(made).collect()}
    assert got[4] == "Text many.example 4\n1 rare"
    assert got[102] == "Same line\nText few.example 2\nStay\n2 rare"


def test_copies_of_a_page_are_no_template(spark):
    copy = "<ul><li>Menu {}</li></ul><article><h1>Title</h1><p>The article that is kept.</p></article>"
    rows = [(i, url, copy.format(i)) for i in range(15) for url in ("http://copies.example/a", None)]
    rows += [(50 + i, "http://copies.example/b", f"<article><p>Another {i}</p></article>") for i in range(12)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.url): r.text for r in pages.extract(made).collect()}
    assert len(got) == len(rows) and got[61, "http://copies.example/b"] == "Another 11"
    assert {got[i, u] for i, u, _ in rows if i < 15} == {"Title\nThe article that is kept."}


def test_parts_on_many_pages_of_a_large_host_go(spark):
    promo = "<div class=x>Our great offer of this week</div>"
    rows = [
        (i, "http://large.example", f"<p>Text {i} of its own</p><h2>Heading of some five words</h2>" + promo * (i % 10 < 3))
        for i in range(400)
    ]
    made = spark.createDataFrame([(i, u, h if i % 10 < 3 else h.replace("<h2>", f"<h2>{i} ")) for i, u, h in rows],
                                 "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(made).collect()}
    assert got[2] == "Text 2 of its own\nHeading of some five words"
    assert got[5] == "Text 5 of its own\n5 Heading of some five words"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article class='post tag-social'><p>a</article>", "a"),
        ("<main class=with-sidebar><p>a</main>", "a"),
        ("<div class='content no-sidebar'><p>a</div>", "a"),
        ("<div class=widget><p>most of the text</div><p>b", "most of the text\nb"),
        ("<article><h2 id=related-work>R</h2><section id=notice-period>n</section><p id=comment-1>c</article>", "R\nn\nc"),
        ("<article class=promo><h1 class=social>T</h1><p>a</article>", "T\na"),
        ("<div><p>the whole text of the page</p></div><article>teaser</article>", "the whole text of the page\nteaser"),
        ("<article><p>first</article><div class=ad>x</div><article><p>second one</article>", "first\nsecond one"),
        ("<article><p>a</article><div class=comments>many comments, more than text</div>", "a"),
        ("<p>text<div class='widget-area site-footer'>w</div><div class=left-sidebar>s</div>", "text"),
    ],
)
def test_only_whole_names_drop_and_never_most_of_a_page(page, text):
    assert pages.main_text(page) == text


PROBED = ("ad-slot ad-unit related-posts post-comments entry-comments article-comments cookie-law google-ads "
          "breadcrumb-trail top-stories author-card share-this newsletter-form").split()


@pytest.mark.parametrize("name", PROBED)
def test_names_of_two_words_drop_by_either_end(name):
    page = f"<article><p>The text of the article that is read.</p><div class='{name}'>Not of it</div></article>"
    assert pages.main_text(page) == "The text of the article that is read."


def test_long_prose_under_a_name_of_two_meanings_stays():
    prose = "What the words of a section on social science say, at some length. " * 5
    for name in ("social-science", "notice-of-loss", "ancient-banner"):
        page = f"<article><p>First.</p><section class={name}><p>{prose}</p></section><p>{'Last ' * 200}</p></article>"
        assert pages.main_text(page).split("\n")[1] == prose.strip()
        links = page.replace(prose, f"<a href=x>{prose}</a>")
        assert pages.main_text(links).split("\n")[1].startswith("Last")
    assert pages.main_text(f"<p>{'Text ' * 300}</p><div class=reader-comments>{prose}</div>") == ("Text " * 300).strip()


def test_what_recurs_inside_a_text_is_no_template(spark):
    page = ("<div class=menu-of-site>Start here</div><article><h2>Summary</h2><p>He <b>Note:</b> said 3 things, "
            "<em>not</em> all of them {0}.</p><p>The end.</p><ul><li>Yes<li>{0}</ul><table><tr><td>Yes<td>{0}</table>"
            "<div>Yes</div><div>A box of more than five words</div></article>")
    rows = [(i, "http://one.example/x", page.format(i)) for i in range(20)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(made).collect()}
    assert got[7] == "Summary\nHe Note: said 3 things, not all of them 7.\nThe end.\nYes\n7\nYes\n7\nYes"


def test_template_counts_equal_brute_force(spark):
    """Every part of every distinct page, counted by itself."""
    raw = [(r.url, r.html or "") for r in table(spark, SF_DIR, "pages").collect()]
    raw += [(f"http://b.example/{i}", f"<ul><li>One menu</ul><article><p>{i}</p><div>Five words in a box</div></article>")
            for i in range(14)]
    made = spark.createDataFrame(raw, "url string, html string")
    hosts = made.select(pages._host(made["url"]).alias("_host"), made["html"].alias("_html"))
    got = {(r["_host"], key) for r in pages.templates(hosts, 10, 0.5).collect() for key in r["keys"]}
    seen = {}
    for url, text in raw:
        root = pages.parse(text)
        keys = pages.subtrees(root)
        host = re.match(r"\w+://([^/]*)", url)[1]
        distinct = seen.setdefault(host, {})
        distinct.setdefault(pages.page_text(root), set()).update(keys)
    want = set()
    for host, distinct in seen.items():
        for key in set().union(*distinct.values()):
            n = sum(key in keys for keys in distinct.values())
            if n >= 10 and n > 0.5 * len(distinct):
                want.add((host, key))
    assert got == want and {host for host, _ in got} == {"b.example"}
