"""URL filter: rules, splitting, scores against brute force, calibration."""

from __future__ import annotations

import random

import brute
import pytest

from strata.llm import urls
from strata.llm.queries import URL_RULES

ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/EN/x", "http://a.net", "http://a.net/", "ftp://example.org?x", "x://xorg/fr/", "x://org/fr/1#f",
       "http://www.example.com/de/?q", "http://example.com:80/de/", "http://İ.net/a", "a://b://c.net/d", "http://notexample.net/en/x", "http://e.org/fr/\nx"]


def table_of(n=250):
    rng = random.Random(4)
    out = []
    for i in range(n):
        host = rng.choice(["www.", "", "m."]) + rng.choice(["example.net", "example.com", "example.org", "shop.net", "site.org"])
        out.append(f"http://{host}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.choice(['news', 'buy', 'cheap'])}{rng.randint(0, 60)}?x={i % 3}")
    return out + ODD + out[:5]


def test_split_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(table_of())]
    out = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    assert len(out) == len(rows)
    for i, u in rows:
        host, path = brute.split_url(u)
        rule = brute.url_rule(host, path, URL_RULES)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule.name if rule else None)
        if rule:
            assert out[i].verdict == rule.verdict
        else:
            assert out[i].verdict == ("allow" if out[i].score >= out[i].threshold else "block")


def test_scores_equal_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(table_of())]
    want = brute.url_scores([u for _, u in rows], URL_RULES, 5, 2.0)
    for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect():
        assert r.score == pytest.approx(want[r.host, r.path], abs=1e-6)


def test_the_model_tells_what_rules_did_not_see(spark):
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(f"http://{name()}.net/casino-{name()}",) for _ in range(150)] + [(f"http://{name()}.org/fr/library-{name()}",) for _ in range(150)]
    test = [(f"http://{name()}.example/casino-{name()}",) for _ in range(30)] + [(f"http://{name()}.example/library-{name()}",) for _ in range(30)]
    out = {r.url: r.verdict for r in urls.filter_urls(spark.createDataFrame(rows + test, "url string"), URL_RULES).collect()}
    right = sum(out[u] == ("block" if "casino" in u else "allow") for (u,) in test)
    assert right >= 55


def test_empty_one_class_and_extra_columns(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []
    one = spark.createDataFrame([("http://a.net/x", "mine", 1)], "url string, verdict string, other long")
    r = urls.filter_urls(one, URL_RULES).collect()[0]
    assert (r.verdict, r.other, r.threshold) == ("block", 1, 0.0)


def test_no_table_is_broadcast(spark, monkeypatch):
    """Small files may hold tables that are large in memory: no join may send one through the driver."""
    plans, save = [], urls.Scratch.save

    def seen(self, df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save(self, df, *args)

    monkeypatch.setattr(urls.Scratch, "save", seen)
    out = urls.filter_urls(spark.createDataFrame([(i, u) for i, u in enumerate(table_of())], "page_id long, url string"), URL_RULES)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
