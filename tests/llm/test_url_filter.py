"""URL filter: splitting and rules by hand, the model on held-out addresses."""

import random

import pytest

from catalink.llm.url_filter import filter_urls, labelled_urls, op9_url_filter, train
from catalink.llm.url_labels import LABELLED_URLS


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled_urls(spark))


CASES = [
    ("https://Blog.Example.NET/en/25#top", "blog.example.net", "/en/25", "example.net/en/", "allow"),
    ("https://example.net/de/1", "example.net", "/de/1", "net/", "block"),
    ("http://a.example.com/de/x?y=/fr/", "a.example.com", "/de/x", "example.com/de/", "block"),
    ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://x.org?/fr/", "x.org", "", None, None),
    ("http://org/fr/1", "org", "/fr/1", "org/fr/", "allow"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None),
    ("http://net", "net", "", None, None),
    ("ftp://h#a://b/c", "h", "", None, None),
    ("no scheme/de/", "", "", None, None),
    ("://", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://ÄB.net/En/x", "Äb.net", "/En/x", "net/", "block"),
]


def test_split_and_rules(spark, model):
    df = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(CASES)], "page_id long, url string, host string")
    got = {r.page_id: r for r in filter_urls(df, model).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), CASES[i]
        assert got[i].verdict in ("allow", "block")
        if verdict:
            assert got[i].verdict == verdict


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    rows = list(LABELLED_URLS)
    rng.shuffle(rows)
    hosts = sorted({u.split("/")[2].removeprefix("www.") for u, _ in rows})
    held = set(rng.sample(hosts, len(hosts) // 4))  # whole hosts are held out
    is_held = lambda u: u.split("/")[2].removeprefix("www.") in held
    fit = train(spark.createDataFrame([r for r in rows if not is_held(r[0])], "url string, blocked int"))
    test = [r for r in rows if is_held(r[0])]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(test)], "page_id long, url string")
    scores = {r.page_id: r.score for r in filter_urls(df, fit).collect()}
    right = sum((scores[i] > 0.5) == bool(y) for i, (_, y) in enumerate(test))
    assert right / len(test) >= 0.7


def test_query(spark, sf_dir):
    rows = op9_url_filter(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    free = [r for r in rows if r.rule is None]
    bad = [r for r in free if "spam" in r.host or "pills" in r.host]
    assert all(r.verdict == "block" for r in bad)
    assert sum(r.verdict == "allow" for r in free if r not in bad) >= 0.95 * (len(free) - len(bad))


def test_empty_table(spark, model):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), model).collect() == []
