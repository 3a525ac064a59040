import random

import pytest

from lychgate.llm import url_rules
from lychgate.llm.url_rules import ALLOW, BLOCK

URLS = [
    None, "", "no scheme/at all", "://", "http://", "http://Example.COM", "http://example.com/en/", "http://example.com/en", "https://a.b.example.com/en/x?q=/fr/#t",
    "https://www.example.com/en/1", "https://x.www.example.com/en/1#", "https://wwwexample.com/en/1", "ftp://net/es/", "http://a.net/fr/x", "http://a.net?x=://b.com/", "http://u@a.com:80/x",
    "http://a.com./x", "http://.com/x", "http://com/", "http://É.com/Ünï", "x://com/a://net/es/", "http://a-b.net/es/", "http://a\nb.com/\n/", "http://net/fr//es/" + "z" * 100_000,
]


def plain(url, rules, default):
    """Host, path, rule and verdict by trying every rule."""
    rest = url.partition("://")[2] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end].translate(str.maketrans(url_rules.UPPER, url_rules.LOWER)), rest[end:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [(len(h) + len(p), len(h), v, h + p) for v, h, p in rules if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[2] if best else default


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "x", "k", 1, "v") for i, u in enumerate(urls)], "page_id long, url string, html string, key string, part int, verdict string")


def check(spark, urls, rules, default=ALLOW, parts=None):
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judged(pages_of(spark, urls), url_rules.rule_table(spark, rules), default, parts).collect()}
    assert got == {i: plain(u, [r for r in rules if None not in r], default) for i, u in enumerate(urls)}


@pytest.mark.parametrize("parts", [1, 2, 50])
def test_against_every_rule(spark, parts):
    check(spark, URLS, url_rules.RULES, parts=parts)
    check(spark, URLS, url_rules.RULES, BLOCK, parts)


def test_nested_rules_and_many_hosts(spark):
    rng = random.Random(3)
    labels = ["a", "b", "ab", "a-b", "c", "z"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join("/" + rng.choice(labels) for _ in range(rng.randint(0, 3)))
    rules = list({(h, p): (rng.choice([ALLOW, BLOCK]), h, p) for h, p in ((host(), path()) for _ in range(300))}.values())
    rules += [(BLOCK, "", "/z"), (None, "a", "/"), (ALLOW, None, "/"), (ALLOW, "a", None)]
    urls = [f"http://{host()}{path()}" for _ in range(1500)] + ["http://b.a/a/b"] * 1500
    check(spark, urls, rules, parts=40)
    check(spark, urls, [], BLOCK, 7)


def test_block_wins_and_one_rule_twice(spark):
    pages = pages_of(spark, ["http://a.com/x", "http://b.com/x"])
    rules = url_rules.rule_table(spark, [(ALLOW, "A.com", "/"), (BLOCK, "a.com", "/"), (BLOCK, "a.com", "/")])
    assert sorted((r["rule"], r["verdict"]) for r in url_rules.judged(pages, rules).collect() if r["page_id"] == 0) == [("a.com/", BLOCK)]
    with pytest.raises(ValueError):
        url_rules.judged(pages, rules, "maybe")


def test_empty_and_repeated_rows(spark):
    rules = url_rules.rule_table(spark)
    assert url_rules.judged(pages_of(spark, URLS).limit(0), rules).count() == 0
    twice = pages_of(spark, URLS).selectExpr("cast(null as long) as page_id", "url").union(pages_of(spark, URLS).selectExpr("page_id", "url"))
    got = url_rules.judged(twice.union(twice), rules)
    assert got.count() == 4 * len(URLS) and got.where("page_id is null").count() == 2 * len(URLS)


def test_a_common_host_is_spread_over_parts(spark):
    rows = url_rules.addresses(spark.range(4000).selectExpr("id as page_id", "'http://one.com/same' as url"))
    cuts = url_rules.boundaries(rows, 20)
    sizes = [r["count"] for r in url_rules._dealt(rows.select("page_id", "key", "path", "salt", "host"), cuts, "page_id long, key string, path string, salt string, host string, part int").groupBy("part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 800
