"""Totals with examples, lookups between key sets and guards of captures
(G1, G9, F13, F16, F17, E10, K10, L5, TS13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds without a heartbeat after which a stage pauses, and the states of a run; fixed values.
STALE_SECONDS = 300
COMPLETE, STOPPED = "domains_complete", ("paused", "interrupted")
#: Most manual terms of a domain; fixed value.
MOST_TERMS = 2


def run_totals(rows: DataFrame, name: Column, error: Column) -> DataFrame:
    """G1: raw, valid, unique, duplicate and invalid rows of a list, in one row. Names are counted after
    partial aggregation by name, so a name that fills the list costs one row a task."""
    by_name = rows.groupBy(F.when(error.isNull(), name).alias("n"), error.isNull().alias("ok")).agg(F.count("*").alias("c"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    valid, unique = total(F.when(F.col("ok"), F.col("c"))), F.count(F.when(F.col("ok"), 1))
    return by_name.agg(
        total("c").alias("raw"), valid.alias("valid"), unique.alias("unique"), (valid - unique).alias("duplicate"),
        total(F.when(~F.col("ok"), F.col("c"))).alias("invalid"),
    )


def examples(rows: DataFrame, group: str, value: str, most: int = 5) -> DataFrame:
    """The first ``most`` distinct values of each group. The row filter is a group limit, which Spark
    applies before the shuffle too."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(value))
    return rows.select(group, value).distinct().withColumn("position", nth).where(F.col("position") <= most)


def missing_keys(**sets: DataFrame) -> DataFrame:
    """of one-column key sets, each key with the names of the sets that lack it, joined by commas and
    empty where the key is in all. One shuffle; equality of the sets means that no name is there."""
    marked = [df.toDF("key").withColumn("set_name", F.lit(name)) for name, df in sets.items()]
    union = marked[0]
    for other in marked[1:]:
        union = union.unionByName(other)
    lacks = [F.when(~F.max(F.col("set_name") == name), name) for name in sets]
    return union.where("key is not null").groupBy("key").agg(F.concat_ws(",", *lacks).alias("missing"))


def lines_at(texts: DataFrame, wanted: DataFrame, key: str, text: str = "text", line: str = "line") -> DataFrame:
    """F16: line number ``line`` (from 1) of the text of each wanted key; numbers beyond the end give no
    row. Texts meet the wanted keys before they are split, and are not exploded."""
    both = texts.select(key, text).join(wanted.select(key, line), key)
    found = both.select(key, line, F.get(F.split(text, "\n", -1), F.col(line) - 1).alias("content"))
    return found.where("content is not null")


def navigation(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """the distinct pairs with the number of partners of either end."""
    pairs = pairs.select(left, right).where(f"{left} is not null and {right} is not null").distinct()
    by_left = pairs.groupBy(left).agg(F.count("*").alias(f"of_{left}"))
    by_right = pairs.groupBy(right).agg(F.count("*").alias(f"of_{right}"))
    return pairs.join(by_left, left).join(by_right, right)


def quoted_terms(terms: DataFrame, texts: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Of ``terms(key, keyword, quote, part)``, part 0 being manual terms and later ones variants, the
    union by folded keyword with the spelling seen first, and the problems: quotes that the text of
    their key lacks, and keys with more than ``MOST_TERMS`` manual terms."""
    seen = terms.join(texts.select(key, F.col(text).alias("quoted_text")), key, "left")
    holds = F.coalesce(F.contains("quoted_text", "quote"), F.lit(False))
    seen = seen.select(key, "keyword", "part", holds.alias("holds"))
    first = F.min(F.struct("part", key, "keyword"))["keyword"]
    merged = (
        seen.where("holds").groupBy(F.lower(F.trim("keyword")).alias("term_key"))
        .agg(first.alias("keyword"), F.count("*").alias("sources"), F.countDistinct(key).alias("domains"))
    )
    many = terms.where("part = 0").groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > MOST_TERMS)
    bad = seen.where("not holds").groupBy(key).agg(F.count("*").alias("n")).select(key, F.lit("quote_not_found").alias("problem"), "n")
    return merged, bad.unionByName(many.select(key, F.lit("too_many_terms").alias("problem"), "n"))


def no_data_problem(status: Column, message: Column, series_size: Column) -> Column:
    """What is wrong with a capture; null where nothing is."""
    bare = status == "no_data"
    return (
        F.when(~status.isin("no_data", "chart") | status.isNull(), "unknown_status")
        .when(bare & (F.trim(F.coalesce(message, F.lit(""))) == ""), "message_missing")
        .when(bare & (F.coalesce(series_size, F.lit(0)) > 0), "synthetic_series")
    )


def barrier(status: Column, pending: Column, heartbeat: Column, now: Column) -> Column:
    """Whether the next stage may start, must pause or has to wait, by the latest summary of a run."""
    stale = heartbeat < now - F.expr(f"interval {STALE_SECONDS} seconds")
    return F.when((status == COMPLETE) & (pending == 0), "start").when(status.isin(*STOPPED) | stale, "pause").otherwise("wait")


def same_chart_ratio(values: DataFrame, chart: str, term: str, value: str, base: str) -> DataFrame:
    """TS13: each term's value against that of ``base`` in the same chart, never across charts; null where
    the chart has no such term or it is 0."""
    of_base = values.where(F.col(term) == base).groupBy(chart).agg(F.max(value).alias("base_value"))
    ratio = F.when(F.col("base_value") > 0, F.col(value) / F.col("base_value"))
    return values.select(chart, term, value).join(of_base, chart, "left").withColumn("ratio", ratio)
