"""Rules over daily series (TS1-TS13, E11-E13, G15-G16).

Series are arrays of 30 whole numbers, oldest first, one row per key. The long form (key, day, value)
is reduced with partial aggregation before the arrays are built, so a key with very many events
moves one row per day and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAYS = 30


def daily_series(events: DataFrame, keys: list[str], ts: str = "ts", days: int = DAYS, cap: int = 100) -> DataFrame:
    """Dense daily counts, capped, over ``days`` days from the first day of the table (TS2): keys,
    start (date), values."""
    day = F.to_date(F.col(ts))
    first = events.agg(F.min(day).alias("start"))  # one row
    counts = (
        events.where(F.col(ts).isNotNull()).groupBy(*keys, day.alias("day")).agg(F.least(F.count("*"), F.lit(cap)).alias("v"))
        .join(F.broadcast(first))
        .withColumn("i", F.datediff("day", "start"))
        .where(f"i between 0 and {days - 1}")
    )
    found = counts.groupBy(*keys, "start").agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    return found.select(*keys, "start", dense(F.col("m"), days).alias("values"))


def dense(sparse: Column, days: int = DAYS) -> Column:
    """Array from a map of day numbers; days that are missing are observed zeros."""
    return F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.coalesce(F.try_element_at(sparse, i), F.lit(0).cast("long")))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)


def nonzero(values: Column) -> Column:
    return F.size(F.filter(values, lambda v: v > 0))


def part(values: Column, lo: int, hi: int) -> Column:
    return F.slice(values, lo + 1, hi - lo)


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def growth_rule(series: DataFrame) -> DataFrame:
    """TS1. Adds status, eligible, the two weekly means, ratio, active days, share of the largest
    day and the date of the first signal."""
    v = F.col("values")
    last, before = part(v, 23, 30), part(v, 16, 23)
    out = (
        series.withColumn("total", total(v))
        .withColumn("previous7_mean", total(before) / F.lit(7.0))
        .withColumn("last7_mean", total(last) / F.lit(7.0))
        .withColumn("last7_nonzero_days", nonzero(last))
        .withColumn("last7_largest_day_share", ratio(F.array_max(last), total(last)))
        .withColumn("ratio", ratio(total(last), total(before)))
        .withColumn("first_nonzero", F.expr("date_add(start, cast(array_position(transform(values, x -> x > 0), true) - 1 as int))"))
    )
    strong = (F.col("last7_nonzero_days") >= 5) & (F.col("last7_largest_day_share") <= 0.4)
    fits = F.coalesce(strong & ((F.col("previous7_mean") == 0) | (F.col("ratio") >= 2)), F.lit(False))
    whole = (F.size("values") == DAYS) & F.forall("values", lambda x: x.isNotNull())
    status = (
        F.when(~whole, "incomplete_or_non_daily")
        .when(F.col("total") == 0, "below_reporting_threshold")
        .when(~fits, "growth_rule_not_met")
        .when(F.col("previous7_mean") == 0, "zero_baseline_emerging")
        .otherwise("rapid_growth")
    )
    out = out.withColumn("status", status).withColumn("eligible", F.col("status").isin("zero_baseline_emerging", "rapid_growth"))
    return out.withColumn("first_nonzero", F.when(F.col("total") > 0, F.col("first_nonzero")))


def persistence(series: DataFrame) -> DataFrame:
    """TS4 and TS5: status by whole-number comparisons, and the measures behind it."""
    v = F.col("values")
    early, prev, recent = part(v, 0, 16), part(v, 16, 23), part(v, 23, 30)
    tail, prior = part(v, 27, 30), part(v, 23, 27)
    out = series.withColumns(
        {
            "total": total(v), "early_sum": total(early), "previous_sum": total(prev), "recent_sum": total(recent),
            "tail_sum": total(tail), "prior_sum": total(prior), "nonzero_days": nonzero(v), "early_nonzero": nonzero(early),
            "previous_nonzero": nonzero(prev), "recent_nonzero": nonzero(recent), "peak": F.array_max(v), "recent_peak": F.array_max(recent),
        }
    )
    steady = F.expr(
        "previous_nonzero >= 4 and recent_nonzero >= 5 and recent_sum > 0 and 20 * recent_peak <= 7 * recent_sum and 40 * tail_sum >= 21 * prior_sum"
    )
    up = steady & F.expr("previous_sum > 0 and 5 * recent_sum >= 6 * previous_sum and 40 * recent_sum >= 21 * early_sum")
    down = F.expr("(previous_sum > 0 and 5 * recent_sum <= 4 * previous_sum) or (prior_sum > 0 and 40 * tail_sum < 21 * prior_sum)")
    status = (
        F.when(F.col("total") == 0, "zero")
        .when(F.expr("nonzero_days < 5 or 2 * peak > total"), "sparse")
        .when(up & (F.col("early_nonzero") <= 2), "emerging")
        .when(up, "rising")
        .when(down, "cooling")
        .otherwise("other")
    )
    return out.withColumns(
        {
            "status": status,
            "peak_share": ratio(F.col("peak"), F.col("total")),
            "recent_peak_share": ratio(F.col("recent_peak"), F.col("recent_sum")),
            "recent_ratio": ratio(F.col("recent_sum"), F.col("previous_sum")),
            "recently_visible": F.expr("early_nonzero <= 2 and previous_nonzero >= 4 and recent_nonzero >= 5"),
        }
    )


def background(points: DataFrame, keys: list[str], window_start: Column, background_start: Column, background_end: Column) -> DataFrame:
    """TS3 over ``points(keys, day, value, partial)``: status of the time before the window.

    The last point of a key proves nothing; an interval counts as earlier only if the next point
    lies at or before the window's start and it is not partial.
    """
    order = Window.partitionBy(*keys).orderBy("day")
    p = points.withColumn("next_day", F.lead("day").over(order)).withColumn("gap", F.datediff("next_day", "day"))
    earlier = (F.col("next_day") <= window_start) & ~F.coalesce(F.col("partial"), F.lit(False))
    g = p.groupBy(*keys).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.sum(F.when(earlier, 1).otherwise(0)).alias("intervals"),
        F.sum(F.when(earlier & (F.col("value") > 0), 1).otherwise(0)).alias("earlier_nonzero"),
        F.min(F.when(earlier & (F.col("value") > 0), F.col("day"))).alias("first_earlier"),
        F.sum(F.when(~F.col("gap").between(1, 7), 1).otherwise(0)).alias("bad_gaps"),
        F.sum(F.when(F.col("value") > 0, 1).otherwise(0)).alias("any_nonzero"),
    )
    covered = (
        (F.col("first_day") <= F.date_add(background_start, 7))
        & (F.col("last_day") >= F.date_sub(background_end, 7))
        & (F.col("last_day") <= background_end)
        & (F.col("bad_gaps") == 0)
        & (F.col("intervals") >= 1)
    )
    status = (
        F.when(~covered, "background_incomplete")
        .when(F.col("earlier_nonzero") > 0, "earlier_signal_requires_review")
        .when(F.col("any_nonzero") == 0, "background_below_threshold")
        .otherwise("no_earlier_reported_signal")
    )
    return g.withColumn("status", status).withColumn("eligible", F.col("status") == "no_earlier_reported_signal")


def checksums(values: Column) -> tuple[Column, Column]:
    """TS6: plain and position-weighted sums."""
    weighted = F.transform(values, lambda v, i: v * (i + 1))
    return total(values), total(weighted)


def rle_encode(values: Column) -> Column:
    """Runs as ``value`` or ``valuexcount``, comma-joined."""
    empty = F.array().cast("array<struct<v:bigint,n:int>>")

    def safe(acc, v):
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.array_append(F.slice(acc, 1, F.greatest(F.lit(0), F.size(acc) - 1)), F.struct(v.alias("v"), (last["n"] + 1).alias("n")))
        return F.when((F.size(acc) > 0) & (last["v"] == v), grown).otherwise(F.array_append(acc, F.struct(v.alias("v"), F.lit(1).alias("n"))))

    runs = F.aggregate(values, empty, safe)
    return F.array_join(F.transform(runs, lambda r: F.when(r["n"] > 1, F.concat(r["v"].cast("string"), F.lit("x"), r["n"].cast("string"))).otherwise(r["v"].cast("string"))), ",")


def rle_decode(text: Column) -> Column:
    """``3x5,0`` is five threes and a zero."""
    runs = F.transform(
        F.split(text, ","),
        lambda t: F.array_repeat(F.substring_index(t, "x", 1).cast("long"), F.when(t.contains("x"), F.substring_index(t, "x", -1).cast("int")).otherwise(1)),
    )
    return F.flatten(runs)


def stage_gate(growth: Column, back: Column, repeat: Column) -> Column:
    """TS7: the stage that is due, by the eligibility of the three assessments (null: not done)."""
    return (
        F.when(growth.isNull(), "chart")
        .when(~growth, "ended_at_chart")
        .when(back.isNull(), "background")
        .when(~back, "ended_at_background")
        .when(repeat.isNull(), "repeat")
        .when(~repeat, "ended_at_repeat")
        .otherwise("done")
    )


def auto_match(growth: Column, back: Column, repeat: Column) -> Column:
    """TS8: all three assessments are eligible."""
    return F.coalesce(growth & back & repeat, F.lit(False))


def summary(series: DataFrame) -> DataFrame:
    """TS9: without the last, incomplete day: mean, active days, means of the last and previous 14."""
    v = F.expr("slice(values, 1, size(values) - 1)")
    out = series.withColumn("complete", v)
    c = F.col("complete")
    return out.select(
        *[x for x in series.columns if x != "values"],
        ratio(total(c), F.size(c)).alias("mean_value"),
        nonzero(c).alias("nonzero_days"),
        ratio(total(F.slice(c, -14, 14)), F.lit(14)).alias("recent14_mean"),
        F.when(F.size(c) >= 28, ratio(total(F.slice(c, -28, 14)), F.lit(14))).alias("previous14_mean"),
    )


def anchor_estimates(series: DataFrame, anchors: DataFrame) -> DataFrame:
    """TS10 with F11: ``series(capture, term, values)`` joined with ``anchors(term, volume)`` within
    the same capture only (TS13): conditional estimates, with and without the edge points."""
    mean = lambda v: ratio(total(v), F.size(v))
    edge = F.expr("slice(values, 2, greatest(size(values) - 2, 0))")
    s = series.select("capture", "term", mean(F.col("values")).alias("mean_all"), mean(edge).alias("mean_inner"))
    a = s.join(F.broadcast(anchors.select(F.col("term").alias("anchor"), "volume")), F.col("term") == F.col("anchor"))
    a = a.select("capture", "anchor", "volume", F.col("mean_all").alias("anchor_mean"), F.col("mean_inner").alias("anchor_inner"))
    return s.join(a, "capture").where("term <> anchor").select(
        "capture", "term", "anchor", F.col("mean_all").alias("target_mean"), "anchor_mean",
        F.try_divide(F.col("volume") * F.col("mean_all"), F.col("anchor_mean")).alias("estimate"),
        F.try_divide(F.col("volume") * F.col("mean_inner"), F.col("anchor_inner")).alias("edge_estimate"),
    )


def recent_against_before(series: DataFrame, recent: int = 4, before: int = 13) -> DataFrame:
    """TS12: mean of the last complete points, of those before, and the peak with its position."""
    v = F.col("values")
    return series.select(
        *[x for x in series.columns if x != "values"],
        ratio(total(F.slice(v, -recent, recent)), F.lit(recent)).alias("recent_mean"),
        ratio(total(F.slice(v, -(recent + before), before)), F.lit(before)).alias("before_mean"),
        F.array_max(v).alias("peak"),
        (F.array_position(v, F.array_max(v)) - 1).cast("int").alias("peak_index"),
    )
