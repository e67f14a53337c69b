"""Tables that are replaced as a whole (B2): written aside, then switched by one pointer row."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.sources import scratch

_POINTER = "sequence bigint, version string"


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/pointers")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_POINTER).json(f"{root}/pointers")


def _last(spark: SparkSession, root: str):
    rows = _pointers(spark, root)
    return None if rows is None else rows.where("version is not null").agg(F.max(F.struct("sequence", "version")).alias("p")).first()["p"]


def _switch(spark: SparkSession, root: str, sequence: int, version: str) -> None:
    """One row in one new file: it is there or it is not."""
    spark.createDataFrame([(sequence, version)], _POINTER).coalesce(1).write.mode("append").json(f"{root}/pointers")


def publish(df: DataFrame, root: str) -> str:
    """Replace the table at ``root``. Readers see the old rows until the new ones are written and pointed to; a write that fails
    or is killed, before or between both steps, leaves the old table. ``df`` may read the table that it replaces. Of two writers at
    once, both versions are whole, and the later pointer (ties: the greater name) counts."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    last = _last(spark, root)
    df.write.mode("errorifexists").parquet(f"{root}/versions/{version}")
    _switch(spark, root, (last["sequence"] if last else 0) + 1, version)
    return version


def current(spark: SparkSession, root: str) -> DataFrame:
    """The table's rows as of now. A plan keeps the version that it was made with."""
    last = _last(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing has been published at {root}")
    return spark.read.parquet(f"{root}/versions/{last['version']}")


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the files of all but the last ``keep`` versions, those that were never pointed to included; gives how many went.
    Not to be run while a table is being published."""
    rows = _pointers(spark, root)
    wanted = {r["version"] for r in rows.orderBy(F.desc("sequence"), F.desc("version")).limit(max(keep, 1)).collect()} if rows is not None else set()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in (fs.listStatus(path) if fs.exists(path) else []) if s.getPath().getName() not in wanted]
    for old in gone:
        scratch.delete(spark, old.toString())
    return len(gone)
