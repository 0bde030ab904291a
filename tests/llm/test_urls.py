import re

import pytest
from pyspark.sql import functions as F

from veritally.llm import urls
from veritally.llm.queries import QUERIES

URLS = [
    "http://a.example.org/es/1", "https://Example.ORG/en/12?x=/fr/", "http://example.org", "http://x.org#top", "ftp://org/", "http://notexample.org/es/1",
    "http://shop.com/fr/a", "http://com/de/", "http://shop.com?/fr/", "x://y://z/p?q", "no scheme", "", None, "http://user@Host.co.uk:80/a/b", "http:///path", "http://ÄB.com/FR/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    labelled = spark.createDataFrame([], "host string, bad int")
    got = {r["page_id"]: r for r in urls.judge(pages, labelled).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        rule, verdict = rule_of(*parts(u))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (*parts(u), rule)
        assert got[i]["verdict"] == (verdict or "allow")


def test_whole_table(spark, sf_dir):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    got = QUERIES["op7_url_filter"](spark, sf_dir).collect()
    assert sorted(r["page_id"] for r in got) == sorted(pages)
    for r in got:
        rule, verdict = rule_of(*parts(pages[r["page_id"]]))
        assert (r["host"], r["path"], r["rule"]) == (*parts(pages[r["page_id"]]), rule)
        assert r["verdict"] == verdict or (verdict is None and r["verdict"] in ("allow", "block"))


def posterior(groups, prior, doubt):
    """(mean, variance) of groups {name: (n, bad)} around {name: prior}, of which {name: doubt} is the variance."""
    inside = {g: (n, b, prior[g]) for g, (n, b) in groups.items() if 0 < prior[g] < 1}
    spread = sum(n * (b / n - m) ** 2 / (m * (1 - m)) - 1 for n, b, m in inside.values())
    room = sum(n - 1 for n, _, _ in inside.values())
    low, high = 1 / (urls.STRENGTHS[1] + 1), 1 / (urls.STRENGTHS[0] + 1)
    k = 1 / (min(max(spread / room, low), high) if room else low) - 1
    out = {}
    for g, (n, b) in groups.items():
        mean = (k * prior[g] + b) / (k + n)
        out[g] = mean, mean * (1 - mean) / (k + n + 1) + (k / (k + n)) ** 2 * doubt[g]
    return out


def test_reputation(spark):
    data = [(f"h{i % 7}.d{i % 3}.{'com' if i % 3 else 'co.uk'}", int(i % 7 in (0, 1) or i % 11 == 0)) for i in range(300)]
    by_host, domains, suffixes, overall = urls.host_reputation(spark.createDataFrame(data, "host string, bad int"))
    levels = [
        lambda h: "co.uk" if h.endswith("co.uk") else "com",
        lambda h: ".".join(h.split(".")[(-3 if h.endswith("co.uk") else -2) :]),
        lambda h: h,
    ]
    mean = {None: sum(b for _, b in data) / len(data)}
    variance = {None: mean[None] * (1 - mean[None]) / (len(data) + 1)}
    assert overall == pytest.approx(mean[None])
    above = lambda h: None
    for level, frame in zip(levels, (suffixes, domains, by_host)):
        groups, prior, doubt = {}, {}, {}
        for h, b in data:
            n, s = groups.get(level(h), (0, 0))
            groups[level(h)] = n + 1, s + b
            prior[level(h)], doubt[level(h)] = mean[above(h)], variance[above(h)]
        expected = posterior(groups, prior, doubt)
        got = {r[0]: (r["mean"], r["variance"]) for r in frame.collect()}
        assert got.keys() == expected.keys()
        for g in got:
            assert got[g] == pytest.approx(expected[g])
        mean, variance = ({g: e[i] for g, e in expected.items()} for i in (0, 1))
        above = level


def test_bad_hosts_are_blocked(spark):
    data = [("bad.net", 1)] * 40 + [(f"good{i}.net", 0) for i in range(200)] + [("once.net", 1)]
    labelled = spark.createDataFrame(data, "host string, bad int")
    pages = spark.createDataFrame([(1, "http://bad.net/x"), (2, "http://once.net/"), (3, "http://good3.net/"), (4, "http://new.net/"), (4, "http://new.net/"), (5, None)], "page_id long, url string")
    got = sorted((r["page_id"], r["verdict"]) for r in urls.judge(pages, labelled).collect())
    assert got == [(1, "block"), (2, "allow"), (3, "allow"), (4, "allow"), (4, "allow"), (5, "allow")]
    assert urls.judge(pages.where("false"), labelled).count() == 0


def test_outcomes(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/7.html"), (2, "http://b.com/x"), (3, None), (4, "http://a.com/en/7")], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1, 0), (7, None, 1), (8, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, urls.page_outcomes(pages, labels).collect())) == [("a.com", 1), ("a.com", 1)]
    assert urls.page_verdicts(pages, labels.where("false")).where(F.col("verdict") == "block").count() == 0
