"""Counts, coverage, funnels and constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Outcome group of each access reason; fixed values.
ACCESS_GROUPS = {
    "access_restriction": ("http_blocked", "challenge", "rate_limited"),
    "dns": ("dns",),
    "tls": ("tls_handshake", "certificate", "local_ca"),
    "network": ("connect", "timeout", "transport"),
    "limited_content": ("javascript_or_thin", "thin_or_empty", "missing_keyword_evidence"),
    "unusable_page": ("soft_404", "parking_page", "placeholder_page", "homepage_missing"),
    "page_candidate": ("html_with_content",),
}


def histogram(rows: DataFrame, *by: str, name: str = "n") -> DataFrame:
    """Rows per combination; partial aggregation bounds what a hot value moves."""
    return rows.groupBy(*by).agg(F.count("*").alias(name))


def access_outcomes(rows: DataFrame, key: str, reason: str, groups: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Distinct keys and percent of all, per group; reasons without a group show as ``unmapped``."""
    table = [(r, g) for g, reasons in (groups or ACCESS_GROUPS).items() for r in reasons]
    dim = rows.sparkSession.createDataFrame(table, "_reason string, outcome string")
    joined = rows.join(F.broadcast(dim), rows[reason] == dim["_reason"], "left")
    counts = joined.groupBy(F.coalesce("outcome", F.lit("unmapped")).alias("outcome")).agg(F.countDistinct(key).alias("n"))
    every = rows.agg(F.countDistinct(key).alias("_all"))
    return counts.join(F.broadcast(every)).select("outcome", "n", F.round(100.0 * F.col("n") / F.col("_all"), 2).alias("percent"))


def unmapped(rows: DataFrame, reason: str, groups: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """K1: reasons that are in no group or in several; must be empty."""
    table = [(r,) for reasons in (groups or ACCESS_GROUPS).values() for r in reasons]
    dim = rows.sparkSession.createDataFrame(table, f"{reason} string").groupBy(reason).count()
    return rows.select(reason).distinct().join(F.broadcast(dim), reason, "left").where(F.coalesce("count", F.lit(0)) != 1).select(reason)


def request_totals(rows: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """Known totals and rows whose count is unknown."""
    return rows.groupBy(*by).agg(
        F.sum(F.coalesce(F.col(count), F.lit(0))).alias("known_requests"), F.count_if(F.col(count).isNull()).alias("unknown_rows"), F.count("*").alias("all_rows")
    )


def funnel(rows: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each condition in turn, and how many it took; one scan."""
    total, passed = [F.count("*").alias("s0")], F.lit(True)
    for i, (_, cond) in enumerate(steps, 1):
        passed = passed & F.coalesce(cond, F.lit(False))
        total.append(F.count_if(passed).alias(f"s{i}"))
    names = ["all", *(n for n, _ in steps)]
    one = rows.agg(*total)
    kept = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(f"s{i}").alias("kept"), (F.col(f"s{max(i - 1, 0)}") - F.col(f"s{i}")).alias("removed")) for i, n in enumerate(names)])).alias("x")
    return one.select(kept).select("x.*")


def not_unique(rows: DataFrame, *key: str) -> DataFrame:
    """K2."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def outside(rows: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Keys that are not among the allowed ones."""
    return rows.select(key).distinct().join(allowed.select(key), key, "left_anti")


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (with multiplicity) of one side only."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def series_violations(rows: DataFrame, key: str, values: str, plain: str, weighted: str, days: int = 30) -> DataFrame:
    """K8: series of a wrong length, out of 0..100, or with sums that differ from the saved ones."""
    v = F.col(values)
    total = F.aggregate(v, F.lit(0).cast("long"), lambda a, x: a + x)
    moment = F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
    problem = (
        F.when(F.size(v) != days, "length")
        .when(~F.forall(v, lambda x: x.isNotNull() & x.between(0, 100)), "range")
        .when((total != F.col(plain)) | (moment != F.col(weighted)), "checksum")
    )
    return rows.withColumn("problem", problem).where("problem is not null").select(key, "problem")


def capture_coverage(captures: DataFrame) -> DataFrame:
    """G15 over ``captures(capture, at, terms)``: terms in captures of several terms, of one term,
    and single ones that came after a capture of several (rechecks)."""
    each = captures.select("capture", "at", (F.size("terms") > 1).alias("many"), F.explode("terms").alias("term"))
    before = Window.partitionBy("term").orderBy("at", "capture").rowsBetween(Window.unboundedPreceding, -1)
    seen = each.withColumn("again", ~F.col("many") & F.coalesce(F.max("many").over(before), F.lit(False)))
    kinds = seen.groupBy("term").agg(F.max("many").alias("multi"), F.max(~F.col("many")).alias("single"), F.max("again").alias("recheck"))
    return kinds.agg(
        F.count_if("multi").alias("multi_terms"), F.count_if("single").alias("single_terms"), F.count_if("recheck").alias("recheck_terms"),
        F.count_if(F.col("multi") & ~F.col("single")).alias("comparison_only"),
    )


def spacing_violations(rows: DataFrame, ts: str, seconds: float, keys: Sequence[str], key: str, segment: Column | None = None) -> DataFrame:
    """Rows that follow their predecessor of the same keys too soon.

    With a ``segment`` that never falls over time (such as the day), rows are ordered per segment
    and the last time of the segment before comes from one summary row each. Rows without a key
    are left out.
    """
    timed = rows.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_s", F.lit(0) if segment is None else segment)
    part = [*keys, "_s"]
    last = timed.groupBy(*part).agg(F.max("_at").alias("_end"))
    last = last.withColumn("_before", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_s"))).select(*part, "_before")
    inside = F.lag("_at").over(Window.partitionBy(*part).orderBy("_at", key))
    joined = timed.withColumn("_prev", inside).join(last, part)
    gap = (F.col("_at") - F.coalesce("_prev", "_before")) / F.lit(1e6)
    return joined.withColumn("gap", gap).where(F.col("gap") < seconds).select(key, *keys, "gap")


def latest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; ``max_by`` combines before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def search(rows: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """M1 and M6: rows that hold the text in any of the columns, whatever its case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(text.lower())), F.lit(False))
    return rows.where(hit)


def page_of(rows: DataFrame, order: Sequence[str], page: int, size: int = 50) -> DataFrame:
    """One page of an ordered result; limit and offset need no global numbering."""
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)
