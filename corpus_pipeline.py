"""A training-data pipeline: toxicity filter, near-dedup, redaction, mixing and tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the documents of the next one. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm import bpe, mixing, ordered_minhash, pii, toxicity
from wordtide.llm.common import materialise, read_table
from wordtide.llm.queries import PATTERN, VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~held)
    return toxicity.with_scores(docs, model, "pipeline_toxic_score").where("pipeline_toxic_score < 0.5").select(*[docs[c] for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ordered_minhash.dedup(docs)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe.encode(docs, VOCABULARY, PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: The toxicity model and the edit-distance classes cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
