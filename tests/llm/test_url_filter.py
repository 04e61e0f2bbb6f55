from __future__ import annotations

import re

from tests.llm.helpers import LOWER, with_clashes
from tidewater.llm.queries import URL_LIST, URL_RULES
from tidewater.llm.url_filter import LISTING, judge

URLS = [None, "", "no scheme", "http://com/", "https://A.EXAMPLE.com/en/x?q#f", "http://www.example.com/en/1",
        "http://x.www.example.com/en/", "ftp://b.net/es/#", "http://net/fr/", "http://netx/fr/", "http://net/fr",
        "http://example.com", "a://b://c/d", "://x.org/p", "http://..net/es/a", "http://spam-farm.example.org/en/",
        "http://m.casino-win.example.net/de/1", "http://É.com/é", "http://h.com:80/x", "http://x.com\n/y",
        "http://" + "a." * 5000 + "net/es/" + "p/" * 5000, "http://free-bets.example.org?x"]


def brute(url, rules, listed):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOWER)
    fits = lambda h, p: (host == h or host.endswith("." + h)) and path.startswith(p)
    best = max(((len(h + p), h + p, v) for h, p, v in rules if fits(h, p)), default=None)
    if best:
        return host, path, best[1], best[2]
    return host, path, None, "block" if any(fits(h, "/") for h in listed) else "allow"


def listing(spark, rules, listed):
    return spark.createDataFrame([(h, p, h + p, v, 0) for h, p, v in rules]
                                 + [(h, "/", h + "/", "block", 1) for h in listed], LISTING)


def test_matches_brute_force(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(4, URLS[4])] * 50
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string"), "host", "path", "rule", "block")
    got = judge(pages, listing(spark, URL_RULES, URL_LIST), "page_id", "url").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == brute(URLS[r["page_id"]], URL_RULES, URL_LIST)


def test_false_positives_of_the_filter_are_removed(spark):
    listed = [f"h{k}.org" for k in range(0, 4000, 2)]
    pages = spark.createDataFrame([(k, f"http://h{k}.org/x") for k in range(4000)], "page_id long, url string")
    got = judge(pages, listing(spark, [], listed), "page_id", "url").collect()
    assert all(r["verdict"] == ("allow" if r["page_id"] % 2 else "block") for r in got)


def test_beyond_the_broadcast_bound_and_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://net/fr/")], "page_id long, url string")
    spark.conf.set("tidewater.broadcast.maxRows", "0")
    try:
        assert judge(pages, listing(spark, URL_RULES, []), "page_id", "url").first()["verdict"] == "block"
    finally:
        spark.conf.unset("tidewater.broadcast.maxRows")
    none = spark.createDataFrame([], LISTING)
    assert judge(pages, none, "page_id", "url").first()["verdict"] == "allow"
    assert judge(pages.limit(0), none, "page_id", "url").count() == 0
