"""Links as a browser reads them, rules by joins, and both against a plain graph of pages."""

import random
import re

import plain
from pyspark.sql import functions as F

from talkweave.llm import url_filters
from talkweave.llm.url_filters import Rule

PAGE = "http://Host.net/a/b/c?q=1#f"


def test_targets():
    expect = {
        '<link rel="canonical" href="/x?a=1&amp;b=2">': "http://Host.net/x?a=1&b=2", '<link rel=canonical href="?z=1">': "http://Host.net/a/b/c?z=1", "<link href='../g' rel='alternate  CANONICAL'>": "http://Host.net/a/g",
        '<LINK REL="canonical" HREF=//o.net/p />': "http://o.net/p", '<link rel="canonical" href=" &#x2F;&#119;&eacute; ">': "http://Host.net/w\xe9", '<link rel="canonical" href="./d/./e">': "http://Host.net/a/b/d/e",
        '<meta http-equiv="Refresh" content="0; URL=\'../../up\'">': "http://Host.net/up", '<meta content="5;http://n.net/" http-equiv=refresh>': "http://n.net/", '<link rel="canonical" href="https://o.net/a/../b">': "https://o.net/a/../b",
        '<link rel="canonical" href="http://[" >': None, '<link rel="canonical" href="">': None, '<link rel="canonical">': None, '<link rel="canonical" href="mailto:a@b.c">': None, '<link rel="noncanonical" href="/n">': None,
        '<meta http-equiv="refresh" content="30">': None, '<meta name="refresh" content="0;url=/n">': None, "<link": None,
    }
    for tag, to in expect.items():
        if to is None and "[" in tag:
            assert url_filters.targets("Host.net/a/b/c?q=1", [tag]) in ([], ["http://["])
        else:
            assert url_filters.targets("Host.net/a/b/c?q=1", [tag]) == ([] if to is None else [to]), tag
    assert url_filters.targets("h.net/a/b", ['<base href="/other/">', '<base href="/no/">', '<link rel="canonical" href="c">']) == ["http://h.net/other/c"]


def test_tags_of_pages(spark):
    link = '<link rel="canonical" href="/x">'
    rows = [(PAGE, link), (PAGE, f"<!-- {link} -->"), (PAGE, f"<!-- {link}"), (PAGE, f"<script>'{link}'</script >"), (PAGE, f"<script>{link}"), (PAGE, None), (None, link), ("nourl", link), (PAGE, "canonical refresh"), (PAGE, f"<!-- -->{link}{link}<p>"), ("ftp://é.net", link), (PAGE, "<!--" * 100_000)]
    got = url_filters.links(spark.createDataFrame(rows, "url string, html string")).collect()
    assert sorted(map(tuple, got)) == sorted([("host.net/a/b/c?q=1", "http://Host.net/x")] * 2 + [("é.net/", "http://é.net/x")])


def naive_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fits, key=lambda r: (-len(r.pattern), r.verdict, r.pattern), default=None)


def test_rules_by_joins(spark, monkeypatch):
    rng = random.Random(1)
    labels, parts = ["a", "bb", "org", "com", "example", "x" * 40], ["", "/", "/de", "/de/", "/de/1", "/é", "/fr/x/y"]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(60)] + ["", ".", "a.", "..org", "www." * 30 + "com"]
    rules = [Rule(rng.choice(hosts[:40]) + rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(150)] + [Rule("/", "block"), Rule("com/", "allow"), Rule("org/de", "block"), Rule("org/de", "allow")]
    rows = [(h, rng.choice(parts) + rng.choice(parts)) for h in hosts for _ in range(4)]
    df = spark.createDataFrame(rows, "host string, path string")
    want = sorted((h, p, (r.pattern, r.verdict) if (r := naive_rule(h, p, rules)) else None) for h, p in rows)
    table = spark.createDataFrame([(r.pattern, r.verdict) for r in rules] + [(None, "block")], "pattern string, verdict string")
    for given in (rules, table):
        got = [(r.host, r.path, r.m and (r.m.rule, r.m.verdict)) for r in url_filters._with_rule(df, given).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert {r.m for r in url_filters.joined(df, table.filter("false")).collect()} == {None}
    monkeypatch.setattr(url_filters, "IN_PLAN", 1000)
    got = [(r.host, r.path, r.m and (r.m.rule, r.m.verdict)) for r in url_filters._with_rule(df, rules).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_many_rules_by_a_table(spark):
    """Three thousand rules, far more than a plan takes, half of them of one host."""
    rules = [Rule(f"big.net/{i}/", "block") for i in range(1500)] + [Rule(f"h{i}.org/", "block") for i in range(1500)]
    df = spark.createDataFrame([(i, f"http://www.big.net/{i}/x") for i in range(0, 3000, 100)] + [(-i, f"http://s.h{i}.org/") for i in range(1, 3000, 100)], "page_id int, url string").withColumn("html", F.lit(None).cast("string"))
    got = {r.page_id: r.verdict for r in url_filters.judged(df, rules).collect()}
    assert got == {i: "block" if abs(i) < 1500 else "allow" for i in got} and len(got) == 60


def naive_verdicts(pages, rules):
    """Of (id, url, target): the verdict of each page, by a plain graph."""

    def parts(url):
        m = re.match(r"[^:]*://([^/?#]*)([^?#]*)(\?[^#]*)?", url)
        return m[1].lower(), m[2], m[1].lower() + (m[2] or "/") + (m[3] or "")

    edges = [(parts(u)[2], parts(t)[2]) for _, u, t in pages if t]
    nodes = {parts(u)[2] for _, u, _ in pages} | {x for e in edges for x in e}
    group = plain.components(nodes, edges)
    bad = set()
    for url in [u for _, u, _ in pages] + [t for _, _, t in pages if t]:
        h, p, node = parts(url)
        if (r := naive_rule(h, p, rules)) and r.verdict == "block":
            bad.add(group[node])
    out = {}
    for i, u, _ in pages:
        h, p, node = parts(u)
        r = naive_rule(h, p, rules)
        out[i] = r.verdict if r else "block" if group[node] in bad else "allow"
    return out


def test_against_a_plain_graph(spark):
    rng = random.Random(4)
    urls = [f"https://{rng.choice(['S1', 's2', 's3'])}.{rng.choice(['net', 'com', 'example.org'])}{rng.choice(['', '/', '/de/', '/fr/', '/en/1', '/k/l'])}{rng.randrange(40)}{rng.choice(['', '?a=1&b=2'])}" for _ in range(400)]
    urls = [u for u in urls if re.match(r"https://[^/?]*\.(net|com|org)(/|\?|$)", u)]
    pages = [(i, u, rng.choice(urls) if rng.random() < 0.4 else None) for i, u in enumerate(urls)]
    forms = ['<link rel="alternate canonical" href="{}">', "<meta http-equiv=refresh content='0;url={}'>", "<p><LINK href='{}' REL=canonical>"]
    rows = [(i, u, rng.choice(forms).format(t.replace("&", "&amp;")) if t else "<p>refresh") for i, u, t in pages]
    got = {r.page_id: r.verdict for r in url_filters.judged(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    want = naive_verdicts(pages, url_filters.RULES)
    assert got == want and sum(naive_verdicts([(i, u, None) for i, u, _ in pages], url_filters.RULES)[i] != v for i, v in want.items()) > 10
