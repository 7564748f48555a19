"""URL verdicts against a plain loop over all rules."""

import random
import re
import string

import pytest

from sentrylake.llm.queries import URL_RULES
from sentrylake.llm.urls import url_verdicts

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_hand(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(LOWER)
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    best = None
    for verdict, h, p in rules:
        h, p = (h or "").translate(LOWER), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), h.count("."), verdict == "block", h + p))
    if best is None:
        return host, path, None, default
    return host, path, best[3], "block" if best[2] else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://org", "https://org/", "HTTP://A.Example.ORG/es/x", "http://xorg/", "http://example.org/en/1", "http://m.example.org/en/19?x#y",
    "http://example.org/en/2", "ftp://u@a.b.com:80/fr/", "http://a.com?/fr/", "http://a.com#/de/", "http://a.com/de", "http://a.com/de/#f", "http://..org//", "http://org./x",
    "http://x.com/fr/://y.org/", "http://É.com/fr/", "http://" + "a." * 3000 + "org/" + "p/" * 30_000, "http://com/de/", "http://com/de/",
]


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i if i % 7 else None, u, "h", "r", 1, "v") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, n int, rank string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    return pages, url_verdicts(pages, table, **options)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_contract_rules(spark, limit):
    got = judged(spark, URLS, URL_RULES, broadcast_rules=limit)[1]
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i if i % 7 else None, *by_hand(u, URL_RULES)) for i, u in enumerate(URLS)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_many_rules(spark, limit):
    draw = random.Random(3)
    part = lambda: draw.choice("abc")
    hosts = lambda: ".".join(part() for _ in range(draw.randint(1, 4)))
    paths = lambda: "".join(draw.choice(["/", "x", "y"]) for _ in range(draw.randint(0, 5)))
    rules = [(draw.choice(["allow", "block"]), hosts(), paths()) for _ in range(300)] + [("block", None, "/x"), ("allow", "", None)]
    urls = [f"http://{hosts()}/{paths()}" for _ in range(1500)]
    got = judged(spark, urls, rules, broadcast_rules=limit, default="block")[1]
    want = [(i if i % 7 else None, *by_hand(u, rules, "block")) for i, u in enumerate(urls)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_repeated_rows_and_empty_tables(spark):
    pages = spark.range(25_000).selectExpr("if(id < 24000, null, 1) AS page_id", "'http://a.org/' AS url")
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    got = url_verdicts(pages, rules)
    assert got.groupBy("page_id", "rule").count().orderBy("page_id").collect() == [(None, "org/", 24_000), (1, "org/", 1_000)]
    assert url_verdicts(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_verdicts(pages.limit(3), rules.limit(0), default="block").collect()} == {"block"}
