"""URL verdicts against a plain version, over the table and hand-made rules."""

import random

import pytest

from tidemark.llm import url_rules
from tidemark.llm.queries import QUERIES, URL_RULES

FOLDER = "/root/testdata/sf0.01"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    ends = [i for i, c in enumerate(rest) if c in "/?#"]
    host = rest[: ends[0]] if ends else rest
    rest = rest[len(host) :]
    stops = [i for i, c in enumerate(rest) if c in "?#"]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[: stops[0]] if stops else rest


def plain_judge(url, rules, default="allow"):
    host, path = plain_parts(url)
    fits = [
        (len(h) + len(p), len(h), v, h + p) for h, p, v in rules
        if v is not None and "/" not in h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, verdict, rule = max(fits, default=(0, 0, default, None))
    return host, path, rule, verdict


def judged(spark, rows, rules, **how):
    pages = spark.createDataFrame(rows, "page_id long, url string")
    return sorted(map(tuple, url_rules.judge(pages, spark.createDataFrame(rules, url_rules.RULE), **how).collect()), key=str)


def expected(rows, rules, **how):
    clean = [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in h or ""), p or "", v) for h, p, v in rules]
    return sorted(((i, *plain_judge(u, clean, **how)) for i, u in rows), key=str)


def test_query_agrees_with_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()]
    got = QUERIES["op11_url_filters"](spark, FOLDER)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, URL_RULES)
    assert {r[3] for r in expected(rows, URL_RULES)} == {None, "net/", "example.net/en/", "example.com/de/", "org/fr/"}


@pytest.mark.parametrize("seed", range(3))
def test_nested_rules_over_many_slices(spark, seed):
    rng = random.Random(seed)
    part = lambda names, most: [rng.choice(names) for _ in range(rng.randrange(most + 1))]
    hosts = lambda: ".".join([*part("abc", 3), rng.choice(["net", "n", "nets"])])
    paths = lambda: "/" + "".join(part(["a", "b/", "/", "é", "~", "-"], 5))
    rules = [(hosts(), rng.choice(["", "/", paths(), paths()]), rng.choice(["block", "allow"])) for _ in range(120)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    rows = [(i, f"http://{hosts()}{rng.choice([paths(), '', paths() + '?q=/'])}") for i in range(900)]
    rows += [(1000 + i, "https://a.net/") for i in range(600)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert judged(spark, rows, rules, default="unsure") == expected(rows, rules, default="unsure")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


ODD = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.Example.NET/en/x?y#z"), (5, "HTTP://WWW.Example.NET/en/x?y#z"),
    (None, "http://net"), (7, "http://net/"), (8, "x://y://net/a"), (9, "http://xnet/"), (10, "http://net./"), (11, "http://u@net:80/"),
    (12, "http://a.net#/en/"), (13, "http://" + "a." * 20000 + "net/" + "b/" * 50000), (14, "http://É.net/É"), (15, "http://a..net/\n/x"),
]


def test_odd_urls_and_rules(spark):
    rules = [
        ("NET", "/", "block"), ("net", "/", "allow"), (None, None, "allow"), ("example.net", "/en/", "allow"), ("a.net", None, "block"),
        ("y:", "//net", "block"), ("u", "/", None), ("a/b", "/", "block"), ("é.net", "/É", "allow"), (".net", "/", "allow"),
    ]
    strict = [r for r in rules if r[:3] != ("net", "/", "allow")]
    assert judged(spark, ODD, rules) == expected(ODD, strict)
    pages = spark.createDataFrame([(i, u, "x", 3, 1) for i, u in ODD], "page_id long, url string, host string, part int, key int")
    made = url_rules.judge(pages, spark.createDataFrame(rules, url_rules.RULE))
    assert made.columns == ["page_id", "host", "path", "rule", "verdict"] and made.count() == len(ODD)


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ODD, [], default="block") == expected(ODD, [], default="block")
    assert judged(spark, [], list(URL_RULES)) == []
    assert judged(spark, ODD, [("net", "/", None)]) == expected(ODD, [])
