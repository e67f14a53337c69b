"""Writers (B1-B11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.sources import published


def write_new(df: DataFrame, path: str) -> None:
    """Refuses a path that holds something already."""
    df.write.mode("errorifexists").parquet(path)


def replace_table(df: DataFrame, root: str) -> None:
    """B2: replaced as a whole, read with ``published.current``; a failed write leaves the old rows."""
    published.publish(df, root)


def append_rows(df: DataFrame, path: str) -> None:
    """B1: rows added to a log; a task that fails leaves nothing behind."""
    df.write.mode("append").json(path)


def write_by_group(df: DataFrame, group: str, column: str, path: str) -> None:
    """One folder of text lines per group. Rows stay in their partitions, so a large group is
    written by many tasks."""
    df.select(group, column).write.partitionBy(group).mode("errorifexists").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted cells that no spreadsheet takes for formulas, with a byte order mark in the first
    heading of each file."""
    cells = [T.guarded_cell(F.col(c).cast("string")).alias(c) for c in df.columns]
    out = df.select(*cells)
    out = out.withColumnRenamed(out.columns[0], "﻿" + out.columns[0])
    out.write.mode("errorifexists").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def content_addressed(df: DataFrame, body: str) -> DataFrame:
    """Distinct bodies by SHA-256; only hashes are grouped with their first body."""
    named = df.select(F.sha2(body, 256).alias("sha256"), F.col(body).alias("body")).where(F.col("body").isNotNull())
    return named.dropDuplicates(["sha256"])


def compact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chosen columns as one JSON text a row, with its hash."""
    return df.select(F.to_json(F.struct(*columns)).alias("json")).withColumn("sha256", F.sha2("json", 256))


def script_payload(df: DataFrame) -> DataFrame:
    """Rows as JSON that can stand inside a script element."""
    return df.select(T.script_safe(F.to_json(F.struct(*df.columns))).alias("json"))


def markdown_table(df: DataFrame, most: int = 200) -> str:
    """A small result as a table; more than ``most`` rows are refused, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("the result is too large for a report table")
    safe = lambda v: "" if v is None else str(v).replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(map(safe, df.columns)) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(safe, r)) + " |" for r in rows])


def redacted(df: DataFrame, key: str, hidden: Sequence[str], quarantine: DataFrame, seed: str = T.SEED) -> DataFrame:
    """Rows whose key is quarantined keep an alias (12 digits of a stable hash) and lose
    the hidden columns."""
    marked = df.join(quarantine.select(key).distinct().withColumn("_q", F.lit(True)), key, "left")
    off = F.coalesce(F.col("_q"), F.lit(False))
    cols = []
    for c in df.columns:
        if c == key:
            cols.append(F.when(off, F.concat(F.lit("alias-"), F.substring(T.stable_hash(F.col(key).cast("string"), seed), 1, 12))).otherwise(F.col(key).cast("string")).alias(key))
        elif c in hidden:
            cols.append(F.when(~off, F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return marked.select(*cols, off.alias("content_review"))
