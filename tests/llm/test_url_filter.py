import re

import pytest

from vouchwell.llm import url_filter
from vouchwell.llm.queries import URL_RULES

URLS = [
    "http://A.Example.ORG/es/1?x=1", "https://example.org/en/12#top", "http://www.example.org/en/2", "http://org/", "http://org",
    "http://b.com/fr/", "http://b.com/de/x.html", "http://bcom/fr/1", "http://c.net/es/1", "no scheme/at/all", "http://x.org?y=/es/", "",
    "ftp://d.example.net://e/f", "http://é.com/fr/ü", "http://a.org/\n", None,
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(n, u) for n, u in enumerate(URLS)]
    rows += [(100 + n, f"http://{'spam' if n % 2 else 'm'}.example.{'org' if n % 3 else 'com'}/{'es' if n % 2 else 'fr'}/{n}") for n in range(200)]
    rows += [(400 + n, f"http://spam.example.net/es/{n}") for n in range(20)] + [(7, "http://c.net/es/1"), (None, "http://c.net/es/1")]
    return spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "page_id long, url string, host string, label double"), rows


def test_rules_match_brute_force_and_trees_judge_the_rest(pages):
    frame, rows = pages
    found = url_filter.judge(frame, URL_RULES).collect()
    assert len(found) == len(rows)
    expected = [(i, *brute(url)) for i, url in rows]
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in found), key=str) == sorted((e[:4] for e in expected), key=str)
    ruled = {e[:4]: e[4] for e in expected}
    by_place = {}
    for r in found:
        verdict = ruled[r.page_id, r.host, r.path, r.rule]
        assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))
        by_place.setdefault((r.host, r.path), set()).add(r.verdict)
    assert len(by_place["c.net", "/es/1"]) == 1  # repeated URLs agree
    assert {r.verdict for r in found if r.host == "spam.example.net"} == {"block"}  # as the labelled spam hosts


def test_held_out_accuracy_on_given_labels(spark, pages):
    frame, _ = pages
    labelled = spark.createDataFrame([(f"http://h{n}.site/{'x' * (n % 5)}{'9' * 12 if n % 2 else 'abc'}", n % 2) for n in range(300)], "url string, label int")
    fresh = spark.createDataFrame([(n, f"http://k{n}.site/{'y' * (n % 5)}{'7' * 12 if n % 2 else 'def'}") for n in range(100)], "page_id long, url string")
    found = url_filter.judge(fresh, [], fit_rows=200, labelled=labelled).collect()
    assert sum((r.verdict == "block") == (r.page_id % 2 == 1) for r in found) >= 95


def _fresh(spark, hosts):
    return spark.createDataFrame([(n, f"http://{h}/new{n % 10}") for n, h in enumerate(hosts)], "page_id long, url string")


def test_host_rates_come_from_all_labelled_urls(spark):
    """A sample of 200 of 4,000 holds about one URL of each host."""
    hosts = [(f"h{(n * 7919) % 1000:03}.net", n % 2) for n in range(200)]
    labelled = [(f"http://{h}/p{k % 10}", bad) for h, bad in hosts for k in range(20)]
    frame = spark.createDataFrame(labelled, "url string, label int")
    found = url_filter.judge(_fresh(spark, [h for h, _ in hosts]), [], fit_rows=200, labelled=frame).collect()
    assert sum((r.verdict == "block") == bool(hosts[r.page_id][1]) for r in found) == len(hosts)


def test_a_rare_class_and_a_frequent_url_enter_the_fit(spark):
    labelled = [(f"http://good{n % 50}.org/a{n}", 0) for n in range(2000)] + [("http://good.org/a", 0)] * 1000
    labelled += [(f"http://bad.net/{'9' * 30}{n}", 1) for n in range(4)]
    frame = spark.createDataFrame(labelled, "url string, label int")
    fresh = spark.createDataFrame([(1, f"http://bad.net/{'9' * 30}x"), (2, "http://good7.org/new"), (3, "http://good.org/a")], "page_id long, url string")
    found = url_filter.judge(fresh, [], fit_rows=100, labelled=frame).collect()
    assert {r.page_id: r.verdict for r in found} == {1: "block", 2: "allow", 3: "allow"}
    host, path = url_filter.parts(url_filter.F.col("url"))
    rows = frame.select("url", host.alias("host"), path.alias("path"), url_filter.F.col("label").cast("double").alias("label"))
    sample = url_filter._sampled(rows, 3004, 4.0, 100).collect()
    assert len(sample) <= 100
    weights = {r.url: r.weight for r in sample}
    assert sum(w for u, w in weights.items() if "bad" in u) == 4.0
    assert abs(weights["http://good.org/a"] - 1000) <= 32 and abs(sum(weights.values()) - 3004) < 600


def test_one_class_and_empty_tables(pages):
    frame, _ = pages
    assert {r.verdict for r in url_filter.judge(frame, []).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(frame, [("block", "com", "/fr/")]).collect()} == {"block"}
    assert url_filter.judge(frame.where("false"), URL_RULES).count() == 0
