"""URL filters: rules by brute force, scores by hand, accuracy on held-out urls, awkward rows."""

import math
import re

import pytest
from pyspark.sql import functions as F

from almanac.llm import url_filter

URLS = [
    "http://example.net/en/1", "https://sub.example.net/en", "https://sub.example.net/en/", "http://NET/", "http://net",
    "http://planet/", "http://a.b.net?x=/", "http://example.com/de/1#top", "http://xexample.com/de/1",
    "http://EXAMPLE.org/fr/", "http://example.org/FR/", "no scheme", "", None, "a://b://c/d", "http://user@h.net:80/en/",
    "http://x.example.net/en/?a=://b/", "://", "http:///path", "http://ä.net/\nx", "http://example.com/de/" + "a" * 100_000,
]


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.default_labels(spark))


def parts(url):
    if not url or "://" not in url:
        return "", ""
    found = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]


def rule(host, path):
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def grams(host, path):
    out = set()
    for mark, text in (("h", f"^{host}$"), ("p", path.lower())):
        out |= {mark + text[i : i + n] for n in (3, 4, 5) for i in range(len(text) - n + 1)}
    return out


def test_rules_and_scores(spark, model):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id int, url string, Host string, rule string")
    rows = url_filter.judge_urls(df, model).collect()
    hashing, regression = model.stages
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = parts(r["url"])
        assert (r["host"], r["path"]) == (host, path)
        want, verdict = rule(host, path)
        assert r["rule"] == want
        places = {hashing.indexOf(g) for g in grams(host, path)}
        raw = regression.intercept + sum(regression.coefficients[p] for p in places)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-raw)), rel_tol=1e-9)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))


def test_held_out_accuracy(spark):
    labelled = url_filter.default_labels(spark).withColumn("fold", F.crc32(F.col("url").cast("binary")) % 3)
    right = total = 0
    for k in range(3):
        fitted = url_filter.train(labelled.where(F.col("fold") != k))
        held = url_filter.judge_urls(labelled.where(F.col("fold") == k), fitted, rules=[])
        right += held.where((F.col("verdict") == "block") == (F.col("label") == 1)).count()
        total += held.count()
    assert right / total > 0.75


def test_training_is_repeatable(spark, model):
    again = url_filter.train(url_filter.default_labels(spark).repartition(7))
    assert again.stages[1].coefficients == model.stages[1].coefficients


def test_awkward_tables(spark, model):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id int, url string"), model).count() == 0
    twice = spark.createDataFrame([(1, URLS[0])] * 3, "page_id int, url string")
    assert url_filter.judge_urls(twice, model).count() == 3
    only = url_filter.default_labels(spark).where("label = 1")
    with pytest.raises(ValueError):
        url_filter.train(only)
