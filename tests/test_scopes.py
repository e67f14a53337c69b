"""Scopes of queries and searches on small rows."""

import datetime

from pyspark.sql import functions as F

from wordtide.operators import scopes

BASE = "https://t.example/explore?geo=US&date=2026-01-01%202026-01-30&q="


def test_scope_problems(spark):
    cases = {
        BASE + "logo+maker,pdf": [], BASE + "%20LOGO%20maker%20,PDF&gprop=&cat=0": [], BASE + "logo+maker,pdf#x&geo=GB": [], BASE + "pdf,logo+maker": ["terms"], BASE + "logo%2Bmaker,pdf": ["terms"],
        BASE + "logo%2520maker,pdf": ["terms"], BASE + "logo+maker": ["terms"], BASE + "logo+maker,pdf&geo=US": ["geo"], BASE + "logo+maker,pdf&gprop=news&cat=5": ["gprop", "cat"],
        BASE.replace("geo=US&", "") + "logo+maker,pdf": ["geo"], BASE.replace("01-30", "01-29") + "logo+maker,pdf": ["date"], "no address": ["geo", "date", "terms"], None: ["geo", "date", "terms"],
        BASE + "logo+maker,pdf&q=other": [], BASE + "%ZZ": ["terms"],
    }
    df = spark.createDataFrame([(u, i) for i, u in enumerate(cases)], "u string, i int")
    p = scopes.scope_problems(F.col("u"), F.array(F.lit("Logo maker"), F.lit("pdf")), F.lit("2026-01-01").cast("date"), F.lit("2026-01-30").cast("date"))
    assert [r["p"] for r in df.select("i", p.alias("p")).orderBy("i").collect()] == list(cases.values())
    w = spark.range(1).select(scopes.next_window(F.lit("2026-03-01").cast("date")).alias("w")).first()["w"]
    assert tuple(w) == (datetime.date(2026, 1, 30), datetime.date(2026, 2, 28))


def test_searches(spark):
    rows = spark.createDataFrame([(1, "logo.com", None, None, "a"), (2, "x.com", "My LOGO", [], "b"), (3, "y.com", "t", ["big Logo", None], "a"), (4, None, None, ["z"], "a"), (5, "%.com", "", None, None)], "i int, domain string, title string, keywords array<string>, registration string")
    found = lambda *a: sorted(r["i"] for r in scopes.domain_search(rows, *a).collect())
    assert found("logo") == [1, 2, 3] and found("logo", "a") == [1, 3] and found("") == [1, 2, 3, 4, 5] and found("%") == [5] and found("nothing") == []
    months = spark.createDataFrame([("A one", "c1", None, "ok"), ("b ONE", "c1", True, "ok"), ("c one", "c2", False, "bad"), ("two", "c1", False, None)], "search string, channel string, excluded boolean, verdict string")
    base = scopes.scoped(months, " One ", "research")
    assert {(r["verdict"], r["n"]) for r in scopes.verdict_facets(base).collect()} == {("ok", 1), ("bad", 1), ("all", 2)}
    assert scopes.of_verdict(base, "bad").count() == 1 and scopes.of_verdict(base).count() == 2 and scopes.scoped(months, channel="c1").count() == 3
    assert {(r["verdict"], r["n"]) for r in scopes.verdict_facets(months.where("false")).collect()} == {("all", 0)}


def test_terms_and_what_belongs_to_them(spark):
    terms = spark.createDataFrame([("Logo",), (" pdf ",), (None,)], "keyword string")
    back = spark.createDataFrame([("logo ", 1, "old"), ("LOGO", 3, "new"), ("other", 9, "x"), (None, 2, "n")], "keyword string, at int, reason string")
    got = {r["keyword"]: r["background"] for r in scopes.with_background(terms, back, "at").collect()}
    assert got["Logo"]["reason"] == "new" and got[" pdf "] is None and got[None] is None and len(got) == 3
    assert {r["keyword"] for r in scopes.without_term(terms, back).collect()} == {"other", None}
    requests = spark.createDataFrame([("a", "robots"), ("a", "homepage"), ("b", "robots"), ("c", None)], "k string, stage string")
    assert tuple(scopes.stage_totals(requests, "k").first()) == (1, 2) and tuple(scopes.stage_totals(requests.where("false"), "k").first()) == (0, 0)
    sources = spark.createDataFrame([("t", "d1", True), ("t", "d2", True), ("u", "d2", False), ("u", "d2", False), ("v", "d3", False)], "term string, domain string, queried boolean")
    assert tuple(scopes.source_totals(sources).first()) == (3, 4, 3, 2, 1)
