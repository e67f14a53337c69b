"""Lookups and guards on small rows: nulls, ties, repeats and empty tables."""

import datetime

from pyspark.sql import functions as F

from wordtide.operators import lookups


def test_missing_keys(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x long"), spark.createDataFrame([(2,), (3,)], "y long")
    rows = lookups.missing_keys(a=a, b=b).collect()
    assert sorted((r.key, r.missing) for r in rows) == [(1, "b"), (2, ""), (3, "a")]
    assert lookups.missing_keys(a=a.limit(0), b=b.limit(0)).count() == 0


def test_lines_at(spark):
    texts = spark.createDataFrame([(1, "a\n\nc"), (2, None)], "k long, text string")
    wanted = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 1), (9, 1)], "k long, line int")
    assert sorted((r.k, r.line, r.content) for r in lookups.lines_at(texts, wanted, "k").collect()) == [(1, 2, ""), (1, 3, "c")]


def test_quoted_terms(spark):
    texts = spark.createDataFrame([(1, "Blue Sky blue"), (2, None)], "k long, text string")
    terms = spark.createDataFrame(
        [(1, "Blue", "Blue", 0), (1, "blue ", "blue", 1), (1, "x", "x", 0), (1, "Sky", "Sky", 0), (2, "y", "y", 0)], "k long, keyword string, quote string, part int"
    )
    merged, bad = lookups.quoted_terms(terms, texts, "k")
    assert sorted(tuple(r) for r in merged.collect()) == [("blue", "Blue", 2, 1), ("sky", "Sky", 1, 1)]
    assert sorted(tuple(r) for r in bad.collect()) == [(1, "quote_not_found", 1), (1, "too_many_terms", 3), (2, "quote_not_found", 1)]


def test_guards(spark):
    now = datetime.datetime(2026, 1, 1, 12)
    old = now - datetime.timedelta(seconds=301)
    rows = [("domains_complete", 0, old), ("domains_complete", 1, now), ("paused", 0, now), ("running", 0, old), (None, None, None)]
    df = spark.createDataFrame(rows, "s string, p int, t timestamp").withColumn("now", F.lit(now))
    steps = [r[0] for r in df.select(lookups.barrier(F.col("s"), F.col("p"), F.col("t"), F.col("now"))).collect()]
    assert steps == ["start", "wait", "pause", "pause", "wait"]
    df = spark.createDataFrame([("no_data", "m", 0), ("no_data", " ", 0), ("no_data", "m", 2), ("chart", None, 3), (None, "m", 0)], "s string, m string, n int")
    problems = [r[0] for r in df.select(lookups.no_data_problem(F.col("s"), F.col("m"), F.col("n"))).collect()]
    assert problems == [None, "message_missing", "synthetic_series", None, "unknown_status"]
