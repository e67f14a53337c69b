"""Coverage partitions, policies and orders over ledgers of requests, captures and terms
(P9, P14, P18-P21, F5, F12-F15, G6, G8, G13-G14, G17, G20-G23, H11-H12, K13, K15, TS11, M3-M5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions import text as T

#: Reasons of rechecks whose page still has usable fields; fixed values.
USABLE_RECHECKS = ("javascript_or_thin", "thin_or_empty", "homepage_too_large")
#: Answers that are not asked again; fixed values.
FINAL_STATUS = (401, 403, 404, 410, 429)


def redirect_problems(requests: DataFrame, key: str, url: str, most_hops: int = 2) -> DataFrame:
    """P9 over ordered requests of a walk: keys that visit a URL twice or hop more than allowed."""
    walks = requests.groupBy(key).agg(F.count("*").alias("requests"), F.countDistinct(url).alias("urls"))
    problem = F.when(F.col("urls") < F.col("requests"), "loop").when(F.col("requests") - 1 > most_hops, "too_many_hops")
    return walks.withColumn("problem", problem).where("problem is not null").select(key, "problem")


def usable(decision: Column, reason: Column) -> Column:
    """P14."""
    return (decision == "pass") | reason.isin(*USABLE_RECHECKS)


def sensitive(columns: Sequence[str], pattern: str, tag: Column | None = None) -> Column:
    """Untagged rows whose text matches the guard's pattern."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).rlike(f"(?i){pattern}"), F.lit(False))
    return hit & (tag.isNull() if tag is not None else F.lit(True))


def retry_split(ok: Column, status: Column, supported: Column) -> Column:
    """Old rows that failed in a way that may pass are tried again, all others reused."""
    return F.when(~ok & ~F.coalesce(status.isin(*FINAL_STATUS), F.lit(False)) & supported, "retry").otherwise("reuse")


def demoted(state: Column, registration: Column) -> Column:
    """P21."""
    return F.when((state == "candidate") & F.coalesce(registration != "verified_recent", F.lit(True)), "observe").otherwise(state)


def universe(rows: DataFrame, pilot: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """each key is covered once: by the pilot, else by history (reuse or retry), else never.
    ``pilot(key)``; ``history(key, action)`` with action reuse or retry."""
    p = pilot.select(key).distinct().withColumn("_p", F.lit("reuse"))
    h = history.groupBy(key).agg(F.max("action").alias("_h"))
    joined = rows.select(key).distinct().join(p, key, "left").join(h, key, "left")
    return joined.select(key, F.coalesce("_p", "_h", F.lit("never")).alias("action"))


def first_capture(terms: DataFrame, captures: DataFrame) -> DataFrame:
    """the first capture (by time, then name) that holds each term; null where none does."""
    each = captures.select("capture", "at", F.explode("terms").alias("term"))
    first = each.groupBy("term").agg(F.min(F.struct("at", "capture")).alias("f"))
    return terms.select("term").distinct().join(first, "term", "left").select("term", F.col("f.capture").alias("capture"))


def queue_coverage(queue: DataFrame, captures: DataFrame) -> DataFrame:
    """Queued groups, those captured with just these terms in this order, and the rest.
    Both sides hold (group_id, terms)."""
    c = captures.select("group_id", F.col("terms").alias("_terms"))
    joined = queue.join(c, "group_id", "left")
    same = F.coalesce(F.col("terms") == F.col("_terms"), F.lit(False))
    state = F.when(F.col("_terms").isNull(), "open").when(same, "covered").otherwise("terms_differ")
    return joined.select("group_id", state.alias("state"), F.size("terms").alias("terms"))


def term_diagnostics(names: DataFrame, terms: Sequence[str]) -> DataFrame:
    """G6 over ``names(name, name_matches)``: rows per term, with and without a listed match beside it."""
    hits = names.select(F.explode(T.contained(F.col("name"), terms)).alias("term"), (F.size("name_matches") > 0).alias("_listed"))
    return hits.groupBy("term").agg(F.count("*").alias("any_rows"), F.count_if("_listed").alias("with_listed"), F.count_if(~F.col("_listed")).alias("without_listed"))


def execution_mix(rows: DataFrame, key: str, mode: str) -> DataFrame:
    """The single mode of each key, or ``mixed``."""
    g = rows.groupBy(key).agg(F.countDistinct(mode).alias("_n"), F.min(mode).alias("_m"))
    return g.select(key, F.when(F.col("_n") > 1, "mixed").otherwise(F.col("_m")).alias("mode"))


def over_cardinality(rows: DataFrame, key: str, member: str, most: int) -> DataFrame:
    """Keys with more than ``most`` different members."""
    return rows.groupBy(key).agg(F.countDistinct(member).alias("members")).where(F.col("members") > most)


def several_versions(rows: DataFrame, batch: str, version: str) -> DataFrame:
    """Batches that mix versions."""
    return over_cardinality(rows, batch, version, 1)


def anchor_crosscheck(predicted: Column, independent: Column) -> Column:
    """TS11: relative error in percent."""
    return F.try_divide(100.0 * (predicted - independent), independent)


def priority_order(forced: Column, reviewed: Column, ready: Column) -> Column:
    """Forced first, then reviewed, then ready, then the rest; ties keep the input's order."""
    return F.when(forced, -1).when(reviewed, 0).when(ready, 1).otherwise(2)


def pinned_order(status: Column, queried: Column) -> Column:
    """Rising and emerging first, then queried ones."""
    return F.when(status.isin("rising", "emerging"), 0).when(queried, 1).otherwise(2)


def with_member(rows: DataFrame, column: str, member: str, text_columns: Sequence[str] = (), text: str = "") -> DataFrame:
    """M4: rows with a list member, and a text in one of the columns if one is given."""
    out = rows.where(F.array_contains(column, member))
    hit = F.lit(not text)
    for c in text_columns:
        hit = hit | F.contains(F.lower(F.col(c)), F.lit(text.lower()))
    return out.where(hit)


def query_url(base: str, term: Column, start: str, end: str, geo: str = "US") -> Column:
    """Every part encoded exactly once."""
    return F.concat(F.lit(base + "?date="), F.url_encode(F.lit(f"{start} {end}")), F.lit(f"&geo={geo}&q="), F.url_encode(term))


def window_bounds(run: Column) -> tuple[Column, Column, Column]:
    """End (the day before), start (29 days earlier) and background start (six months before
    the end, clamped to the month's length)."""
    end = F.date_sub(run, 1)
    return end, F.date_sub(end, 29), F.add_months(end, -6)
