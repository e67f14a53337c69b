"""Reproducible sampling: quotas, top-k by hash, lanes, representatives."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.functions import vocab as V


def quotas(limit: int, shares: Sequence[tuple[str, int]] = V.CHANNELS) -> list[tuple[str, int, int]]:
    """H3: (group, order, quota) by largest remainder; ties go to the earlier group."""
    rows = [[g, i, limit * s // 100, limit * s % 100] for i, (g, s) in enumerate(shares)]
    left = limit - sum(r[2] for r in rows)
    for r in sorted(rows, key=lambda r: (-r[3], r[1]))[:left]:
        r[2] += 1
    return [(g, i, q) for g, i, q, _ in rows]


def top_by_hash(rows: DataFrame, group: str, key: str, k: int, seed: str = T.SEED) -> DataFrame:
    """H2: the k rows of each group with the smallest hashes, ranked.

    A row-number filter, which Spark turns into a group limit before the shuffle: each task sends at
    most k rows a group.
    """
    hashed = rows.withColumn("sampling_hash", T.stable_hash(F.col(key), seed))
    order = Window.partitionBy(group).orderBy("sampling_hash", key)
    return hashed.withColumn("rank_within_group", F.row_number().over(order)).where(F.col("rank_within_group") <= k)


def quota_sample(rows: DataFrame, group: str, key: str, limit: int, shares=V.CHANNELS, seed: str = T.SEED) -> DataFrame:
    """H2-H5: at most ``limit`` rows by quota, shortages refilled one by one in group order.

    Only ``limit`` rows a group can matter, so groups are cut first. Position in the queue of all
    rows is (0 for rows within quota, else how far beyond it, group order, rank); the first
    ``limit`` positions are the sample, in one final sort of at most groups x limit rows.
    """
    table = rows.sparkSession.createDataFrame(quotas(limit, shares), f"{group} string, group_order int, quota int")
    cut = top_by_hash(rows, group, key, limit, seed).join(F.broadcast(table), group)
    over = F.greatest(F.lit(0), F.col("rank_within_group") - F.col("quota"))
    place = Window.orderBy(over, "group_order", "rank_within_group")
    chosen = cut.withColumn("place", F.row_number().over(place)).where(F.col("place") <= limit)
    final = Window.orderBy("group_order", "rank_within_group")
    return chosen.withColumn("queue_rank", F.row_number().over(final)).drop("place")


def boundaries(sample: DataFrame, group: str, key: str) -> DataFrame:
    """H5: size and last row of each group in a sample."""
    return sample.groupBy(group).agg(F.count("*").alias("selected"), F.max_by(key, "rank_within_group").alias("last_key"))


def representatives(rows: DataFrame, label: str, key: str, seed: str = T.SEED) -> DataFrame:
    """H7: per label the row with the smallest hash; the others are listed, in hash order."""
    pair = F.struct(T.stable_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    grouped = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(pair).alias("best"), F.count("*").alias("n"))
    return grouped.select(label, F.col("best.k").alias("representative"), (F.col("n") - 1).alias("alternatives"))


def alternatives(rows: DataFrame, label: str, key: str, seed: str = T.SEED) -> DataFrame:
    """The rows of H7 that are not representatives, one row each (no list to outgrow a row)."""
    chosen = representatives(rows, label, key, seed)
    return rows.join(chosen, label).where(F.col(key) != F.col("representative")).select(label, "representative", key)


def interleave(rows: DataFrame, lane: str, order: Sequence[str], first: int = 4) -> DataFrame:
    """H8: ``first`` priority rows, then one exploration row, and so on.

    ``rows`` is a queue (already cut to a limit), so the final numbering is one small sort.
    """
    nth = F.row_number().over(Window.partitionBy(lane).orderBy(*order)) - 1
    block = F.when(F.col(lane) == "priority", F.floor(nth / first)).otherwise(nth)
    side = F.when(F.col(lane) == "priority", 0).otherwise(1)
    placed = rows.withColumn("_n", nth).withColumn("_block", block).withColumn("_side", side)
    return placed.withColumn("queue_rank", F.row_number().over(Window.orderBy("_block", "_side", "_n"))).drop("_n", "_block", "_side")


def root_round_robin(rows: DataFrame, roots: Sequence[str], key: str, count: int, seed: str = T.SEED) -> DataFrame:
    """H6 over ``rows(key, roots)``: roots in turn each take their next free row in hash order.

    At most ``count - 1`` rows are taken before any pick, so the ``count`` first rows of each root
    are all that can matter; the greedy pass sees at most roots x count rows, in one group.
    """
    vocabulary = T.strings(roots)
    ranked = rows.select(F.col(key).alias("key"), F.explode(F.array_intersect("roots", vocabulary)).alias("root")).distinct()
    cut = top_by_hash(ranked, "root", "key", count, seed).select("key", "root", "sampling_hash", F.lit(1).alias("one"))
    names = list(roots)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pools = {r: iter(pdf[pdf["root"] == r].sort_values(["sampling_hash", "key"])["key"].tolist()) for r in names}
        out: list[tuple[str, str, int]] = []
        seen: set[str] = set()
        before = -1
        while len(out) < count and len(out) != before:
            before = len(out)
            for root in names:
                got = next((k for k in pools[root] if k not in seen), None)
                if got is not None:
                    seen.add(got)
                    out.append((got, root, len(out) + 1))
                if len(out) == count:
                    break
        return pd.DataFrame(out, columns=["key", "sampling_root", "queue_rank"])

    return cut.groupBy("one").applyInPandas(pick, "key string, sampling_root string, queue_rank int")


def runs(rows: DataFrame, keys: Sequence[str], order: Sequence[str], hit: Column, segment: Column | None = None) -> DataFrame:
    """Length of the current run of hits at each row, by gaps and islands within ``keys``.

    With a ``segment`` (a column that never falls in the given order, such as the day), a key is cut
    into segments that are ordered apart; what runs on from earlier segments comes from one summary
    row each. A key with a third of all rows is then spread over as many tasks as it has segments; rows without
    a key are left out.
    """
    part = [*keys] if segment is None else [*keys, "_segment"]
    marked = rows.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    if segment is not None:
        marked = marked.withColumn("_segment", segment)
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = marked.withColumn("_island", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(upto))
    inside = Window.partitionBy(*part, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = islands.withColumn("run_length", F.sum(F.when(F.col("_hit"), 1).otherwise(0)).over(inside))
    if segment is None:
        return local.drop("_hit", "_island")
    # per segment: its misses, its rows, and the hits after its last miss
    misses = marked.groupBy(*part).agg(F.count_if(~F.col("_hit")).alias("_misses"), F.count("*").alias("_n"), F.max(F.when(~F.col("_hit"), F.struct(*order))).alias("_last"))
    after = marked.join(misses.select(*part, "_last"), part).where(F.col("_last").isNotNull() & (F.struct(*order) > F.col("_last")))
    tails = misses.join(after.groupBy(*part).agg(F.count("*").alias("_tail")), part, "left")
    tails = tails.withColumn("_tail", F.when(F.col("_misses") == 0, F.col("_n")).otherwise(F.coalesce("_tail", F.lit(0))))
    days = Window.partitionBy(*keys).orderBy("_segment")
    broken = F.sum(F.when(F.col("_misses") > 0, 1).otherwise(0)).over(days.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chain = Window.partitionBy(*keys, "_chain").orderBy("_segment")
    carried = tails.withColumn("_chain", broken).withColumn("_sum", F.sum("_tail").over(chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    carried = carried.withColumn("_carry", F.coalesce(F.lag("_sum").over(days), F.lit(0))).select(*part, "_carry")
    whole = F.col("run_length") + F.when(F.col("_hit") & (F.col("_island") == 0), F.col("_carry")).otherwise(0)
    return local.join(carried, part).withColumn("run_length", whole).drop("_hit", "_island", "_segment", "_carry")


def still_to_do(queue: DataFrame, done: DataFrame, key: str, order: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` rows that are not done."""
    return queue.join(done.select(key).distinct(), key, "left_anti").orderBy(*order).limit(limit)
