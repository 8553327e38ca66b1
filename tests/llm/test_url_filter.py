"""Rules against plain Python; the trees on held-out labels."""

import re

import pytest

from reelrank.llm import url_filter
from reelrank.llm.url_filter import RULES, Rule

URLS = [None, "", "no scheme", "http://", "http://org", "http://org/", "http://a.org/x", "http://A.Example.ORG/es/1",
        "https://example.org/en/1", "https://www.example.org/en/12?x=1", "http://example.org/en/2", "http://notexample.org/es/",
        "http://x.com/fr/1", "http://x.com/fr", "http://x.com/de/#top", "http://com/de/", "ftp://x.com:80/de/", "http://x.net/a/b/c",
        "http://É.Com/de/1", "http://x.com?/de/", "http://x.com#/de/", "a://b://c.com/fr/", "http://x.com/DE/1",
        "http://x.org\n/es/", "http://example.org/es/" + "p" * 50_000]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.pattern), default=None)
    return host, path, best and best.pattern, best and best.verdict


def test_rules_hosts_and_paths(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[6], "y"), (6, URLS[6], "z")],
                                  "page_id long, url string, host string")
    model = url_filter.UrlModel(None, None, "allow")
    got = url_filter.judge(pages, model).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r["page_id"] is not None:
            host, path, rule, verdict = brute(URLS[r["page_id"]])
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
            assert r["decided_by"] == ("rule" if rule else "model")


def test_a_rule_splits_into_host_and_path():
    assert (Rule("allow", "a.b/c/d").host, Rule("allow", "a.b/c/d").path) == ("a.b", "/c/d")


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def test_trees_learn_lexical_features(spark, pages):
    labelled = url_filter.weak_labels(pages).distinct()
    train = labelled.filter("crc32(url) % 4 <> 2")
    test = labelled.filter("crc32(url) % 4 = 2")
    model = url_filter.fit(train)
    judged = model.verdicts(test.withColumns({"host": url_filter.host_of("url"), "path": url_filter.path_of("url")}), "v")
    right = judged.filter("(v = 'block') = (label = 1)").count()
    assert right / test.count() >= 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "http://" + "a-" * 5000 + ".net/")], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(odd, model).collect()} <= {"allow", "block"}


def test_one_class_or_no_label_is_constant(spark):
    ddl = "url string, label int"
    for rows, want in (([], "allow"), ([("http://a.net/", 0)], "allow"), ([("http://a.net/", 1), (None, 0)], "block")):
        model = url_filter.fit(spark.createDataFrame(rows, ddl))
        assert model.trees is None and model.constant == want
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), model).count() == 0
