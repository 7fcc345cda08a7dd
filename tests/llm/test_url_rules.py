"""URL rules against plain string work, and aliases against a plain search of the graph."""

from __future__ import annotations

from collections import defaultdict

import pytest

from tillmart.llm import url_rules
from tillmart.llm.url_rules import RULES, page_links

SCHEMA = "page_id long, url string, html string, rule string, rule_verdict string, node string"


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:stop]


def own_rule(url, rules=RULES):
    host, path = place(url)
    fits = [
        (len(h) + len(p), len(h), verdict == "allow", h + p, verdict)
        for verdict, h, p in [(v, h.lower(), p) for v, h, p in rules]
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[3:] if fits and host else (None, None)


def brute(pages, rules=RULES, redirects=()):
    def node(url):
        host, _ = place(url)
        if not host:
            return None
        scheme, rest = url.split("://", 1)
        return scheme.lower() + "://" + host + rest.split("#")[0][len(host):]

    edges = defaultdict(set)
    links = [(u, t) for _, u, h in pages if u and h for t in page_links(u, h)]
    for a, b in [*links, *redirects]:
        a, b = a and node(a), b and node(b)
        if a and b:
            edges[a].add(b)
            edges[b].add(a)
    wanted = []
    for key, url, _ in pages:
        rule, verdict = own_rule(url, rules)
        by = "rule"
        if rule is None:
            seen, todo = set(), [url and node(url)]
            while todo:
                at = todo.pop()
                if at and at not in seen:
                    seen.add(at)
                    todo += edges[at]
            hit = any(own_rule(at, rules)[1] == "block" for at in seen if edges[at])
            verdict, by = ("block", "alias") if hit else ("allow", "default")
        wanted.append((key, url, *place(url), rule, verdict, by))
    return sorted(wanted, key=str)


def judged(spark, pages, rules=RULES, redirects=None):
    given = spark.createDataFrame([(*p, "r", "v", "n") for p in pages], SCHEMA)
    told = redirects and spark.createDataFrame(redirects, "from_url string, to_url string, a int")
    found = url_rules.judge(given, url_rules.rules_table(spark, rules), told)
    assert found.columns[-3:] == ["rule", "verdict", "decided_by"]
    rows = found.select(
        "page_id", "url", "host", "path", "rule", "verdict", "decided_by", "rule_verdict", "node"
    ).collect()
    assert all(r.rule_verdict == "v" and r.node == "n" for r in rows)
    return sorted((tuple(r)[:7] for r in rows), key=str)


def canonical(target):
    return f'<html><head><link rel="canonical" href="{target}"></head></html>'


def refresh(target):
    return f"<meta http-equiv='Refresh' content='0; URL={target}'>"


PAGES = [
    (1, "http://example.com/en/1", None),
    (2, "HTTP://WWW.Example.com/en/1?x=1#y", ""),
    (3, "https://shop.example.com/fr/1", canonical("http://example.com/en/1")),
    (4, "https://a.org/1", canonical("http://example.com/en/1")),
    (5, "https://a.org/2", refresh("/1")),
    (6, "https://a.org/3#part", canonical("https://a.org/2#other")),
    (7, "https://b.net/es/1", canonical("https://b.net/de/1")),
    (8, "https://b.net/de/1", None),
    (9, "https://c.net/de/1", canonical("https://nowhere.net/fr/")),
    (10, "https://x.org/", canonical("https://www.example.com/en/2")),
    (11, "http://com", None),
    (12, "com/en/1", None),
    (13, None, canonical("http://example.com/en/1")),
    (14, "", ""),
    (15, "://?x", None),
    (16, "http://notexample.com/en/1", "text " * 100_000),
    (17, "http://example.com/en", None),
    (18, "http://b.net.org/es/1", None),
    (4, "https://a.org/1", canonical("http://example.com/en/1")),
    (None, "https://a.org/1", None),
    (19, "ftp://ÄB.net/es/\n?", None),
    (20, "https://k.org/1", canonical("https://k.org/1")),
]


def test_rules_and_aliases(spark):
    found = judged(spark, PAGES)
    assert found == brute(PAGES)
    by_id = {row[0]: row for row in found}
    assert by_id[1][4:] == ("example.com/en/", "block", "rule")
    assert by_id[2][2:] == ("www.example.com", "/en/1", "www.example.com/en/", "allow", "rule")
    assert by_id[3][4:] == ("com/", "allow", "rule")  # its own rule goes before its alias
    assert by_id[5][4:] == by_id[6][4:] == (None, "block", "alias")
    assert by_id[8][4:] == by_id[9][4:] == (None, "block", "alias")
    assert by_id[10][4:] == (None, "allow", "default")


def test_redirects_join_chains_and_hubs(spark):
    pages = [(n, f"http://p{n}.org/", None) for n in range(60)]
    redirects = [(f"http://p{n}.org/", f"http://p{n + 1}.org/", 1) for n in range(20)]
    redirects += [(f"http://p{n}.org/", "http://hub.net/es/", 1) for n in range(30, 55)]
    redirects += [(None, "http://p1.org/", 1), ("http://p59.org/", None, 1), ("x", "http://hub.net/es/", 1)]
    rules = [*RULES, ("block", "p20.org", "/")]
    found = judged(spark, pages, rules, redirects)
    assert found == brute(pages, rules, [r[:2] for r in redirects])
    assert sum(row[5] == "block" for row in found) == 21 + 25


def test_longest_rule_and_allow_first(spark):
    rules = [("block", "a.org", "/x"), ("allow", "A.org", "/x"), ("block", "org", "/xyz/12"),
             ("allow", "a.org", "/xyz"), ("block", "b.a.org", ""), ("block", "a.org", "/é")]
    urls = ["http://a.org/x", "http://a.org/xyz/12", "http://b.a.org", "http://b.a.org/xyz/1", "http://c.org/xyz/123",
            "http://a.org/é/", "http://org/xyz/12", "http://a.org", "http://ba.org/x"]
    pages = [(n, url, None) for n, url in enumerate(urls)]
    assert judged(spark, pages, rules) == brute(pages, rules)
    odd = spark.createDataFrame([(None, "com", "/"), ("allow", None, "/"), ("block", "com", None), ("x", "com", "/")],
                                "verdict string, host string, path string")
    one = spark.createDataFrame([(1, "http://a.com/", None)], "page_id long, url string, html string")
    assert url_rules.judge(one, odd).first().decided_by == "default"


def test_no_pages(spark):
    assert judged(spark, []) == []
    assert judged(spark, PAGES[:3], [("block", "zz", "/")])[0][5] == "allow"


@pytest.mark.parametrize(
    "text, wanted",
    [
        (canonical("/x?a=1&amp;b=2"), ["http://a.org/x?a=1&b=2"]),
        ("<LINK HREF=//B.org/y REL='x Canonical'>", ["http://B.org/y"]),
        ("<link rel=canonical>", []),
        (canonical(""), []),
        ("<!-- " + canonical("/no") + " -->", []),
        ("<script>var t = '" + canonical("/no") + "'</script>", []),
        ("<link rel=stylesheet href=canonical>", []),
        (refresh("../up"), ["http://a.org/up"]),
        ('<meta http-equiv="refresh" content="30">', []),
        ("<meta content='5;url=\"http://c.org/\"' http-equiv=refresh>", ["http://c.org/"]),
        (canonical("http://[bad/"), []),
        ("refresh <link canonical", []),
    ],
)
def test_links_of_a_page(text, wanted):
    assert page_links("http://a.org/b/c", text) == wanted
