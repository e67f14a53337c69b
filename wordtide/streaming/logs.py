"""Resumable and incremental tables (L1, L3-L5, L7) and daily counts as a stream."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordtide.operators.freshness import digest
from wordtide.operators.sampling import runs


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def append_once(stream: DataFrame, key: str, path: str, checkpoint: str) -> StreamingQuery:
    """L1: each key is written once, the first time it comes; a restart goes on where the checkpoint stands.

    What is written already is looked up in the log itself (its key column only), so the stream has no state that could grow,
    and a key is known however late it comes again. A micro-batch is a folder of the log that is written as a whole: one that failed
    half-way is written anew, and so is what a lost checkpoint makes the stream read again. Rows without a key are left out.
    """

    def write(batch: DataFrame, number: int) -> None:
        fresh = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        if _there(batch.sparkSession, path):
            log = batch.sparkSession.read.schema(batch.schema.add("batch", "long")).option("basePath", path).parquet(path)
            fresh = fresh.join(log.where(F.col("batch") != number).select(key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def require_manifest(queue: DataFrame, policy: dict, root: str) -> None:
    """The queue (its digest, whatever its order) and the policy of the log at ``root`` are saved at its first run; a later run with
    others is refused, since its results would not belong together."""
    now = digest(queue).withColumn("policy", F.lit(json.dumps(policy, sort_keys=True)))
    path = f"{root}/manifest"
    if not _there(queue.sparkSession, path):
        now.coalesce(1).write.mode("errorifexists").parquet(path)
        return
    saved, fresh = queue.sparkSession.read.parquet(path).first(), now.first()
    changed = [c for c in now.columns if saved[c] != fresh[c]]
    if changed:
        raise ValueError("the policy has changed" if changed == ["policy"] else "the queue has changed")


def resume(stream: DataFrame, queue: DataFrame, policy: dict, key: str, root: str, stopped: str | None = None) -> StreamingQuery:
    """A run, or the next one, of the log at ``root``: manifest checked, then every key once. Where ``stopped`` names a boolean
    column and the last batch written has a row with it set, the log is paused and is not resumed."""
    spark = queue.sparkSession
    require_manifest(queue, policy, root)
    if stopped and _there(spark, f"{root}/log"):
        log = spark.read.parquet(f"{root}/log")
        last = log.agg(F.max("batch")).first()[0]
        if last is not None and log.where((F.col("batch") == last) & F.col(stopped)).limit(1).count():
            raise ValueError("the last run was stopped; look at its results first")
    return append_once(stream, key, f"{root}/log", f"{root}/checkpoint")


def pending(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of a queue that the log does not hold yet."""
    return queue.join(done.select(key).distinct(), key, "left_anti")


def merge_latest(current: DataFrame, fresh: DataFrame, key: str, at: str) -> DataFrame:
    """L4: the later row of each key; at equal times the row already there stays, so merging the
    same file twice changes nothing."""
    both = current.withColumn("_old", F.lit(1)).unionByName(fresh.withColumn("_old", F.lit(0)))
    rest = [c for c in current.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, "_old")).alias("_r")).select(key, "_r.*")


def breaker(rows: DataFrame, keys: list[str], order: list[str], failed: Column, most: int, segment: Column | None = None) -> DataFrame:
    """L3: per ``keys`` the first row at which failures in a row reach ``most``."""
    hit = runs(rows, keys, order, failed, segment).where(F.col("run_length") >= most)
    return hit.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_o"), F.count("*").alias("rows_at_limit")).select(*keys, "_o.*", "rows_at_limit")


def daily_counts(stream: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Events per day and key over event time, with a watermark: the increment of a daily series."""
    day = F.window(ts, "1 day")
    return stream.withWatermark(ts, late).groupBy(day, *keys).agg(F.count("*").alias("n")).select(F.col("window.start").cast("date").alias("day"), *keys, "n")


def progress(query: StreamingQuery) -> dict:
    """Rows and batch of the last progress, and the rows that the query keeps as state."""
    last = query.lastProgress or {}
    state = sum(o.get("numRowsTotal", 0) for o in last.get("stateOperators", []))
    return {"batch": last.get("batchId"), "rows": last.get("numInputRows"), "rate": last.get("processedRowsPerSecond"), "state_rows": state}


def read_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
