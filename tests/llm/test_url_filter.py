import random

import pytest

from footfall.llm import url_filter
from footfall.llm.url_filter import CONTRACT_RULES, filter_urls, rules_table

SCHEMA = "page_id long, url string"


def plain(url, rules, default="allow"):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fitting = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fitting, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def _judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), SCHEMA)
    rows = filter_urls(pages, rules_table(spark, rules)).collect()
    return {r.page_id: tuple(r)[-4:] for r in rows}


URLS = [
    None, "", "no scheme", "http://", "https://net", "https://net/", "http://A.Example.NET/en/x?y#z", "http://xexample.net/en/",
    "http://example.net/en", "ftp://x.example.com/de/#a", "http://x.example.com?/de/", "http://a..org/fr//x", "http://org/fr/",
    "x://y://net/", "http://Ünet/", "http://user:pw@a.net:80/", "http://a.net:80/en/", "http://a.net\n/x",
]


def test_rules_of_the_query(spark):
    assert _judged(spark, URLS, CONTRACT_RULES) == {i: plain(u, CONTRACT_RULES) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("seed", range(3))
def test_against_every_rule(spark, seed):
    rng = random.Random(seed)
    hosts = [".".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(30)]
    paths = ["/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(6))) for _ in range(30)]
    rules = list({(rng.choice(hosts), rng.choice([*paths, ""])): rng.choice(["block", "allow"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{rng.choice(hosts)}{rng.choice([*paths, ''])}{rng.choice(['', '/ab/a', '?x', '#y'])}" for _ in range(300)]
    assert _judged(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_odd_tables(spark):
    rules = rules_table(spark, [("a.com", "/", "block"), ("a.com", "/", "allow"), (None, "/", "block"), ("", "/", "block"), ("b.com", None, "block")])
    pages = spark.createDataFrame([(1, "http://a.com/", "own"), (1, "http://a.com/", "own"), (2, "http://b.com", "own")], SCHEMA + ", host string")
    rows = filter_urls(pages, rules).collect()
    assert sorted((r.page_id, r.host, r.rule, r.verdict) for r in rows) == [(1, "a.com", "a.com/", "block")] * 2 + [(2, "b.com", "b.com", "block")]
    none = spark.createDataFrame([], SCHEMA)
    assert filter_urls(none, rules).collect() == []
    assert filter_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == 3


def test_deep_urls_are_not_blown_up(spark):
    url = "http://" + ".".join(["x"] * 2000) + ".a.com/" + "y/" * 2000
    assert _judged(spark, [url], [("a.com", "/y/", "block")])[0][2:] == ("a.com/y/", "block")


def test_input_columns_called_like_inner_ones(spark):
    """Any names pass through, those of the results are replaced."""
    names = ["host_", "path_", "host__", "rule_verdict", "digest", "suffix", "host", "verdict"]
    pages = spark.createDataFrame([("http://a.net/x", *names)], ["url", *names])
    rules = url_filter.rules_table(spark, url_filter.CONTRACT_RULES)
    row = url_filter.filter_urls(pages, rules).collect()[0].asDict()
    assert [row[c] for c in names[:6]] == names[:6]
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == ("a.net", "/x", "net/", "block")
