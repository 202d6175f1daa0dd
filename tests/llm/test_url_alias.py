"""URL rules, alias edges and components against brute force."""
import random

from quaybook.llm import url_alias as U
from quaybook.llm.components import component_labels

PAGES = "page_id long, url string, html string, host string"


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], PAGES)
    return {r.page_id: r for r in U.judge(df, **options).collect()}


def test_rules(spark):
    urls = ["http://a.example.net/en/1", "http://EXAMPLE.net/en/", "http://a.example.net/de/", "http://net/", "http://b.net",
            "http://b.net?x=/", "https://x.example.com/de/a#/en/", "https://x.example.com/den", "https://y.org/fr/x",
            "https://y.org/fr", "https://xnet/", None, "", "no scheme", "a://b://c.net/", "http://a.net:80/", "://q.net/é"]
    got = run(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [got[i].rule for i in range(len(urls))] == [
        "example.net/en/", "example.net/en/", "net/", "net/", None, None, "example.com/de/", None, "org/fr/",
        None, None, None, None, None, None, None, "net/"]
    assert [got[i].verdict for i in range(4)] == ["allow", "allow", "block", "block"]
    assert (got[0].host, got[1].host, got[14].host, got[14].path) == ("a.example.net", "example.net", "b:", "//c.net/")
    assert (got[5].host, got[5].path, got[11].host, got[11].path) == ("b.net", "", "", "")


def test_aliases(spark):
    link = '<LINK href="{}" rel="Canonical">'
    rows = [(1, "http://s.org/a", link.format("http://evil.net/x")),           # alias of a blocked url
            (2, "http://t.org/b", '<meta http-equiv=refresh content="0; URL=http://S.org/a">'),
            (3, "http://u.example.net/en/c", link.format("http://s.org/a")),   # explicitly allowed
            (4, "http://v.org/d", link.format("http://u.example.net/en/c")),   # through the allowed one
            (5, "http://w.org/e", link.format("/f")), (6, "https://w.org/f#top", None),
            (7, "http://w.org/g", "<!-- " + link.format("http://evil.net/x") + " -->"),
            (8, "http://evil.net/x", ""), (9, "http://w.org/h", "<link rel='canonical' href='i'>"), (10, "http://w.org/i", None),
            (1, "http://s.org/a", None)]
    got = run(spark, rows)
    assert {i: r.verdict for i, r in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow"}
    assert got[5].component == got[6].component and got[9].component == got[10].component != got[5].component


def test_empty_and_no_rules(spark):
    assert run(spark, []) == {}
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert run(spark, [(1, "http://a.net/", None)], rules=none)[1].verdict == "allow"


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(50)]
    edges += [(300, 301 + i) for i in range(40)] + [(5, None), (None, None), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in component_labels(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert component_labels(spark.createDataFrame([], "u long, v long")).collect() == []
