"""Whether saved results still are what their sources give (K5, K14), and digests of tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def digest(df: DataFrame) -> DataFrame:
    """One row (rows, low, high): the number of rows and two sums of row hashes, whatever the rows' order and partitions.

    Columns count by name, not by place. Sums are exact decimals, so equal tables have equal digests, and every repeated row
    counts; nulls and empty tables have digests as well. One pass, three partial sums a task.
    """
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    salted = lambda salt: F.coalesce(F.sum(F.xxhash64(F.lit(salt), *cols).cast("decimal(20,0)")), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), salted("a").alias("low"), salted("b").alias("high"))


def freshness(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """K14 by digests: (name, published_rows, recomputed_rows, fresh) per pair (published, recomputed)."""
    out = None
    for name, (published, recomputed) in pairs.items():
        a, b = digest(published), digest(recomputed)
        same = (F.col("p.rows") == F.col("r.rows")) & (F.col("p.low") == F.col("r.low")) & (F.col("p.high") == F.col("r.high"))
        same_names = sorted(published.columns) == sorted(recomputed.columns)
        row = a.alias("p").crossJoin(b.alias("r"))  # one row each
        row = row.select(F.lit(name).alias("name"), F.col("p.rows").alias("published_rows"), F.col("r.rows").alias("recomputed_rows"), (same & F.lit(same_names)).alias("fresh"))
        out = row if out is None else out.unionByName(row)
    return out


def differences(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Every row that one side has more often: the columns and (published, recomputed) counts."""
    cols = sorted(set(published.columns))
    if cols != sorted(set(recomputed.columns)):
        raise ValueError("the tables have different columns")
    sides = published.select(*cols, F.lit(1).alias("_p"), F.lit(0).alias("_r")).unionByName(recomputed.select(*cols, F.lit(0).alias("_p"), F.lit(1).alias("_r")))
    counts = sides.groupBy(*cols).agg(F.sum("_p").alias("published"), F.sum("_r").alias("recomputed"))
    return counts.where("published <> recomputed")


def stale(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Like ``freshness``, with the rows that are missing from and surplus in what is published. Tables are compared row by row
    only where their digests differ: a few numbers per table come to the driver, which then plans the comparisons needed."""
    found = freshness(pairs)
    spark = found.sparkSession
    rows = []
    for r in found.collect():
        missing = surplus = 0
        if not r["fresh"] and sorted(pairs[r["name"]][0].columns) == sorted(pairs[r["name"]][1].columns):
            gap = F.col("recomputed") - F.col("published")
            d = differences(*pairs[r["name"]]).agg(F.sum(F.greatest(gap, F.lit(0))).alias("m"), F.sum(F.greatest(-gap, F.lit(0))).alias("s")).first()
            missing, surplus = d["m"] or 0, d["s"] or 0
        rows.append((*r, missing, surplus))
    return spark.createDataFrame(rows, "name string, published_rows bigint, recomputed_rows bigint, fresh boolean, missing bigint, surplus bigint")


def histogram_problems(rows: DataFrame, column: str, saved: DataFrame) -> DataFrame:
    """K5: values whose count differs from a saved summary ``saved(value, n)``: (value, saved, counted), null where a side has none."""
    now = rows.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("counted"))
    then = saved.groupBy(F.col("value").cast("string").alias("v")).agg(F.sum("n").cast("bigint").alias("saved"))
    joined = now.join(then, F.col("value").eqNullSafe(F.col("v")), "full_outer")
    return joined.where(~F.col("saved").eqNullSafe(F.col("counted"))).select(F.coalesce("value", "v").alias("value"), "saved", "counted")
