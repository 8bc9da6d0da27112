from __future__ import annotations

import random

from blotter.llm import urls
from blotter.llm.queries import URL_RULES


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def judged(spark, pages, rules):
    df = spark.createDataFrame([(i, u, "x") for i, u in pages], "page_id long, url string, host string")
    return sorted((tuple(r) for r in urls.url_filter(df, rules).collect()), key=str)


def test_dealt_rules_on_odd_urls(spark):
    given = [
        "http://EXAMPLE.com/en/1", "https://www.example.com/en/?q#f", "http://a.net/es/", "http://a.net/es", "http://net/fr/x", "ftp://x.org/en/",
        "http://example.com", "http://example.com?x=/en/", "http://notexample.com/en/", "http://m.www.example.com/en/9", "http://Ä.com/en/",
        "example.com/en/", "", None, "://", "://com/", "http://a..com/", "x://y://com/", "http://.com/z", "http://com./",
    ]
    pages = list(enumerate(given)) + [(0, given[0]), (None, given[1])]
    assert judged(spark, pages, URL_RULES) == sorted(((i, *brute(u, URL_RULES)) for i, u in pages), key=str)


def test_many_rules_take_several_levels(spark):
    r = random.Random(1)
    hosts = [f"{a}.{b}.org" for a in "abcdefghij" for b in "klmnopqrst"]
    rules = [(r.choice(["allow", "block"]), h, r.choice(["", "/", "/en/", "/x"])) for h in r.sample(hosts, 60)] + [("block", "org", "")]
    pages = [(i, f"http://{r.choice(['', 'www.'])}{r.choice(hosts)}{r.choice(['', '/', '/en/', '/xy'])}") for i in range(400)]
    assert judged(spark, pages, rules) == sorted(((i, *brute(u, rules)) for i, u in pages), key=str)


def test_empty_tables(spark):
    assert judged(spark, [], URL_RULES) == []
    assert judged(spark, [(1, "http://a.com/")], []) == [(1, "a.com", "/", None, "allow")]


def test_cascade_is_exact_and_bounded(spark):
    keys = [f"k{i}" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    listed = universe.limit(700)
    held = {r["key"] for r in listed.collect()}
    cascade = urls.Cascade(listed, universe)
    assert len(cascade.levels) > 1
    got = {r["key"] for r in universe.filter(cascade.contains(universe["key"])).collect()}
    assert got == held
    try:
        urls.Cascade(listed, universe, max_bits=100)
    except ValueError:
        return
    raise AssertionError("the bound isn't kept")


def test_plan_is_native(spark):
    plan = urls.url_filter(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"), URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Join" not in plan
