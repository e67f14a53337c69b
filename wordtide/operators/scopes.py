"""Scopes of queries and searches, and small joins of terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions import text as T


def next_window(run: Column, days: int = 30) -> Column:
    """struct(first, last) of the days before a run that its query covers."""
    return F.struct(F.date_sub(run, days).alias("first"), F.date_sub(run, 1).alias("last"))


def query_values(url: Column, name: str) -> Column:
    """The values of a query parameter, decoded once, in order; blank ones do not count. Empty without a query."""
    pairs = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1), "[&]")
    named = F.filter(pairs, lambda p: F.try_url_decode(F.substring_index(p, "=", 1)) == name)
    values = F.transform(named, lambda p: F.try_url_decode(F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")))
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def scope_problems(url: Column, terms: Column, first: Column, last: Column, geo: str = "US") -> Column:
    """K9: which parts of a capture's address differ from its record: ``geo``, ``date``, ``gprop``, ``cat``, ``terms``.

    Place and dates must be there exactly once; property and category may be absent or must be the default; the terms of the first q
    must be the record's, in order, by keyword. Encoded twice is different."""
    dates = F.concat_ws(" ", first.cast("string"), last.cast("string"))
    asked = F.transform(F.split(F.coalesce(F.get(query_values(url, "q"), F.lit(0)), F.lit("")), ","), lambda w: T.keyword_key(w))
    meant = F.transform(terms, lambda w: T.keyword_key(w))
    category = query_values(url, "cat")
    return T.listed(
        (query_values(url, "geo") != F.array(F.lit(geo)), "geo"),
        (query_values(url, "date") != F.array(dates), "date"),
        (F.size(query_values(url, "gprop")) > 0, "gprop"),
        ((F.size(category) > 0) & (category != F.array(F.lit("0"))), "cat"),
        (F.coalesce(asked != meant, F.lit(True)), "terms"),
    )


def domain_search(rows: DataFrame, text: str, registration: str = "all") -> DataFrame:
    """M2: rows whose domain, title or any keyword holds the text, whatever its case, and that have the registration status."""
    held = lambda c: F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    hit = held(F.col("domain")) | held(F.col("title")) | F.coalesce(F.exists("keywords", held), F.lit(False))
    return rows.where(hit if registration == "all" else hit & (F.col("registration") == registration))


def scoped(rows: DataFrame, text: str = "", scope: str = "all", channel: str = "all") -> DataFrame:
    """M3 before its last filter: rows inside the research scope, of the channel, whose ``search`` column holds the text."""
    keep = F.contains(F.lower("search"), F.lit(text.strip().lower())) if text.strip() else F.lit(True)
    if scope != "all":
        keep = keep & ~F.coalesce("excluded", F.lit(False))
    if channel != "all":
        keep = keep & (F.col("channel") == channel)
    return rows.where(keep)


def verdict_facets(base: DataFrame) -> DataFrame:
    """M3: counts per verdict and of all, taken before a verdict is chosen."""
    return base.groupBy("verdict").count().select("verdict", F.col("count").alias("n")).unionByName(base.agg(F.lit("all").alias("verdict"), F.count("*").alias("n")))


def of_verdict(base: DataFrame, verdict: str = "all") -> DataFrame:
    return base if verdict == "all" else base.where(F.col("verdict") == verdict)


def with_background(terms: DataFrame, backgrounds: DataFrame, *order: str) -> DataFrame:
    """every term with its last background (null without one), both by keyword. ``backgrounds(keyword, ...)`` are reduced by
    key before they are joined."""
    rest = [c for c in backgrounds.columns if c != "keyword"]
    last = backgrounds.groupBy(T.keyword_key(F.col("keyword")).alias("_key")).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("background"))
    return terms.withColumn("_key", T.keyword_key(F.col("keyword"))).join(last, "_key", "left").drop("_key")


def without_term(terms: DataFrame, backgrounds: DataFrame) -> DataFrame:
    """Backgrounds whose keyword no term has."""
    known = terms.select(T.keyword_key(F.col("keyword")).alias("_key")).distinct()
    return backgrounds.withColumn("_key", T.keyword_key(F.col("keyword"))).join(known, "_key", "left_anti").drop("_key")


def stage_totals(requests: DataFrame, key: str, stage: str = "homepage") -> DataFrame:
    """One row with how many keys have, and have not, a request of the stage. ``requests(key, stage)``; a key without any
    request has a row with a null stage."""
    seen = requests.groupBy(key).agg(F.coalesce(F.max(F.col("stage") == stage), F.lit(False)).alias("seen"))
    return seen.agg(F.count_if("seen").alias("recorded"), F.count_if(~F.col("seen")).alias("not_recorded"))


def source_totals(sources: DataFrame) -> DataFrame:
    """G20 over ``sources(term, domain, queried)``: domains with terms, pairs, terms, and those of queried terms."""
    return sources.select("term", "domain", "queried").distinct().agg(
        F.countDistinct("domain").alias("domains_with_terms"), F.count("*").alias("pairs"), F.countDistinct("term").alias("terms"),
        F.countDistinct(F.when(F.col("queried"), F.col("domain"))).alias("queried_domains"), F.countDistinct(F.when(F.col("queried"), F.col("term"))).alias("queried_terms"),
    )
