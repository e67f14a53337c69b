"""Shared helpers of the corpus operators: table access, shared scratch tables,
hashing and connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder, through Spark's own readers only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where it is unset (tests)."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="wordtide-")
    return _OWN_DIR[app]


def materialise(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the unfinished tasks, and what
    non-deterministic plans produced (partition ids, sampled ranges) is fixed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(parts) if parts else df).write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def forget(df: DataFrame | None) -> None:
    """Delete a table that ``materialise`` wrote, once nothing reads it any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


#: Rows that are sent to every executor at most (a few MB), after a count; and rows a task where there are few.
FEW, EACH = 200_000, 20_000


def components(edges: DataFrame, rounds: int = 60, most: int | None = None) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: one row ``(id, component)`` per
    vertex with an edge, ``component`` being the smallest id reachable.

    Min-label propagation with pointer jumping, one table per round, so that a path of
    length L closes in about log2(L) rounds. Labels move over two equi-joins whose other
    side is reduced by a partial ``min``, so a vertex with very many edges is combined
    before the shuffle. Self edges and nulls are ignored; an empty input gives no rows.
    ``most`` is a number that the edges do not exceed, where it is known: labels of few edges are
    sent to the executors, and the tables of a round are written by as many tasks as they need.
    Nothing is collected but the number of labels that changed.
    """
    both = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    parts = None if most is None else 2 * most // EACH + 1
    sent = F.broadcast if most is not None and 2 * most <= FEW else lambda df: df
    both = materialise(both, "cc-edges", parts)
    labels = materialise(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "cc-labels", parts
    )
    for _ in range(rounds):
        near = (
            both.join(sent(labels.select(F.col("id").alias("b"), "component")), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("c1"))
        )
        step = near.join(sent(labels), "id").select("id", F.col("component").alias("was"), F.least("component", "c1").alias("c"))
        jump = labels.select(F.col("id").alias("c"), F.col("component").alias("c2"))
        fresh = step.join(sent(jump), "c", "left").select("id", "was", F.least("c", F.coalesce("c2", "c")).alias("component"))
        table = materialise(fresh, "cc-labels", parts)
        changed = table.where("component <> was").limit(1).count()
        old, labels = labels, table.drop("was")
        labels._scratch_path = table._scratch_path
        forget(old)
        if not changed:
            break
    else:
        raise RuntimeError("components did not converge")
    forget(both)
    return labels


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, use, most: int) -> DataFrame:
    """At most ``most`` labelled documents as (text, y, half): those whose ids hash lowest.

    ``use`` is a condition on label rows. The ids of the sample are the only thing broadcast, at
    most ``most`` of them; ``half`` splits the sample by another part of the hash.
    """
    name = F.sha2(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")), 256)
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(use) if use is not None else rows
    ids = (
        rows.groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .withColumn("fit_hash", name)
        .orderBy("fit_hash")
        .limit(most)
        .select(F.col("doc_id").alias("fit_id"), "y", (F.conv(F.substring("fit_hash", 60, 4), 16, 10).cast("int") % 2).alias("half"))
    )
    ids = materialise(ids, "fit-ids", 1)
    return materialise(docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("fit_id")).select("text", "y", "half"), "fit-sample")


def text_id(name: str):
    """An id on its way through pandas: as text, since a batch with a null would reach pandas as doubles."""
    return F.col(name).cast("long").cast("string").alias(name)


def long_ids(df: DataFrame, *names: str) -> DataFrame:
    """Ids that went through pandas as text, as numbers again; the order of columns stays."""
    return df.select(*[F.col(c).cast("long").alias(c) if c in names else F.col(c) for c in df.columns])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def logistic(x: np.ndarray, y: np.ndarray, shrink: float = 0.05, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression by Newton's method with a ridge; column 0 is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], shrink)
    ridge[0] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (y - p) - ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        norm = np.abs(step).max()
        w = w + step * min(1.0, 4.0 / max(norm, 1e-12))
        if norm < 1e-8:
            break
    return w
