"""Main text: the tables' template, repeated site parts and odd markup."""
import html
import re

from quaybook.llm import style_tree as S
from quaybook.llm.queries import op9_site_style_tree
from quaybook.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text int"


def reference(page):
    """The tables' pages are simple: the article's blocks by its tags."""
    article = re.search("(?s)<article>(.*)</article>", page)[1]
    parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", ""))
    return "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_whole_table(spark):
    pages = {r.page_id: r for r in read_table(spark, SF001, "pages").collect()}
    rows = op9_site_style_tree(spark, SF001).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        assert r.text == reference(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)


def text(page):
    return "\n".join(S.walk(page)[0])


def test_markup():
    assert text("<p>a &amp;lt; b&nbsp;&#233;<br>c\n d</p><p>e") == "a &lt; b é c d\ne"
    assert text("<div>x<script>if (a</b) '<p>'</script>y<!-- <p>z --></div>") == "xy"
    assert text("<article><div class='comments'>no</div><p title='a > b'>yes</p><ARTICLE class=comment>no</ARTICLE></article>") == "yes"
    assert text("<form>no<p>no</form><ul><li>a<li>b</ul>c<footer>no</footer>") == "a\nb\nc"
    assert text("<div id=cookie-notice>no</div><div class='adventure'>yes</div><div class=ad>no</div>") == "yes"
    assert text("a < b <3 and <unclosed") == "a < b <3 and" and text("") == "" and text("<p>" * 3000 + "x") == "x"
    assert text("<p>a<script>b") == "a" and text("</p></div>x") == "x" and text("<![CDATA[a<b]]>") == "a<b"


def test_repeated_branches_go(spark):
    rows = []
    for i in range(30):
        rows.append((i, f"http://H.x/{i}", f"<body><div class=q7>Welcome to our site</div><div class=main><p>Story {i} of many</p>"
                                           f"<p>same line</p></div></body>", 0))
    rows += [(100 + i, f"http://small.x/{i}", "<div class=q7>Only here</div>", 0) for i in range(3)]
    rows += [(200, None, "<p>t</p>", 0), (201, "http://h.x/", None, 0), (0, "http://H.x/0", rows[0][2], 0)]
    got = {}
    for r in S.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect():
        got.setdefault(r.page_id, r.text)
    assert got[3] == "Story 3 of many\n\nsame line" and got[101] == "Only here" and got[200] == "t" and got[201] == ""
    assert S.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_large_hosts(spark):
    """Most hosts of sf0.1 have enough pages for the tree."""
    pages = {r.page_id: r.html for r in read_table(spark, "/root/testdata/sf0.1", "pages").collect()}
    rows = op9_site_style_tree(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == len(pages) and not [r.page_id for r in rows if r.text != reference(pages[r.page_id])]


def test_articles_in_one_template_stay(spark):
    page = ("<html><body><div class=q7>Welcome</div><div class=wrap><article><h1>Title {0}</h1><p>Story {0}</p></article></div>"
            "</body></html>")
    rows = [(i, f"http://h.x/{i}", page.format(i), 0) for i in range(30)]
    rows += [(100 + i, f"http://h.x/no/{i}", "<html><body><div class=wrap>Nothing here</div></body></html>", 0) for i in range(900)]
    got = {r.page_id: r.text for r in S.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[i] for i in range(30)] == [f"Title {i}\n\nStory {i}" for i in range(30)]
    wrap = "<div class=wrap><article>a</article>b</div>"
    assert S.walk(wrap, frozenset(n[0] for n in S.walk(wrap)[1]))[0] == ["a"]


def test_copies_weigh_once(spark):
    page = "<html><body><div class=q7>Welcome</div><div class=text><p>Story {0} of many</p></div></body></html>"
    rows = [(i, f"http://h.x/{i}", page.format(i), 0) for i in range(50)]
    rows += [(100 + i, f"http://h.x/c/{i}", page.format(0), 0) for i in range(950)]
    rows += [(2000 + i, f"http://same.x/{i}", page.format(0), 0) for i in range(12)]
    one = "".join(f"<p>{i}</p>" for i in range(20))  # a path that one page has often
    rows += [(3000 + i, f"http://few.x/{i}", f"<div class=q7>Same</div>{one}", 0) for i in range(3)]
    got = {r.page_id: r.text for r in S.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert [got[i] for i in range(50)] == [f"Story {i} of many" for i in range(50)] and got[1000] == "Story 0 of many"
    assert got[2000] == "Welcome\n\nStory 0 of many" and got[3000].startswith("Same\n\n0\n\n1")


def test_names_spare_articles():
    for name in ("with-sidebar", "has-sidebar", "no-comments", "search-results", "legal", "sidebar"):
        assert text(f"<div class=nav>no</div><div class='{name}'><article><p>yes</p></article></div>") == "yes"
        assert text(f"<main><div class='{name}'><article><p>yes</p></article></div></main>") == "yes"
    assert text("<div class=legal><p>most of the text of a page</p></div><p>and more</p>") == "most of the text of a page\nand more"
    parts = "".join(f"<div class={n}>{n}</div>" for n in ("related", "notice", "discussion", "legal"))
    assert text(f"<article><header><h1>Title</h1></header>{parts}</article>") == "Title\nrelated\nnotice\ndiscussion\nlegal"
    # What lies beside an article, and comments inside one, still go.
    assert text("<article>yes</article><div class=related><article>teaser, long as it is</article></div>") == "yes"
    assert text("<article>yes</article><div class='comments-area'><p>a lot of talk</p></div><div id=site-nav>no</div>") == "yes"
    assert text("<article>the article<div class=comments><article>no</article></div></article>") == "the article"
    assert text("<div class=nav>" * 3000 + "x") == "x"


def test_inline_parts_below_noise():
    page = "<div class=a>one <b>two</b> <span class=s>three<br> 3</span> four</div><article>five <i>six</i></article>"
    nodes = {n[0].rsplit("/", 1)[1]: n[0] for n in S.walk(page)[1]}
    assert S.walk(page)[0] == ["one two three 3 four", "five six"]
    assert S.walk(page, frozenset([nodes["span.s#"]]))[0] == ["one two four", "five six"]
    assert S.walk(page, frozenset([nodes["div.a#"]]))[0] == ["five six"]
    assert not S.below("/div.ab#", frozenset(["/div.a#", "/div"])) and S.below("/div/p/b", frozenset(["/div/p"]))


def test_the_tree_alone_finds_the_text(spark):
    """Pages without article or telling names: only repetition shows what
    belongs to the site, so without the tree every page keeps all of it."""
    page = ("<html><body><div class=x1><p>Home</p><p>About us</p></div><div class=x2><h1>Title {0}</h1><p>Body {0} begins</p>"
            "<p>and ends {0}</p></div><table><tr><td class=x3>Call 555</td></tr></table><div class=x4><p>All rights kept</p></div>"
            "</body></html>")
    rows = [(i, f"http://plain.x/{i}", page.format(i), 0) for i in range(60)]
    rows += [(100 + i, "http://plain.x/copy", page.format(3), 0) for i in range(200)]
    df = spark.createDataFrame(rows, PAGES).repartition(5)
    got = {r.page_id: r.text for r in S.main_text(df).collect()}
    assert all(got[i] == f"Title {i}\n\nBody {i} begins\n\nand ends {i}" for i in range(60)) and got[250] == got[3]
    assert all("Call 555" in text(r[2]) for r in rows)
    renamed = df.selectExpr("page_id", "url", "replace(replace(html, 'x2', 'x9'), 'x1', 'x8') AS html", "text")
    assert {r.page_id: r.text for r in S.main_text(renamed).collect()} == got
