"""Queries of the corpus operators over the given tables, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import blob_ledger, bpe, fingerprint, hostgraph, lattice, linecrf, mixing, ordered_minhash, periodic, pii, toxicity, warc, whitening
from .common import read_table

#: The vocabulary is a parameter: a rank file and the pattern that splits text before its merges.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.link(read_table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "epochs", "mix_key")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(read_table(spark, sf_dir, "documents"))


def op7_ordered_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_minhash.classes(read_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostgraph.judge(read_table(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(read_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linecrf.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.find(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find(periodic.with_planted_runs(read_table(spark, sf_dir, "documents"))))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_lattice": op2_lattice,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_fingerprint": op6_fingerprint,
    "op7_ordered_minhash": op7_ordered_minhash,
    "op8_url_filter": op8_url_filter,
    "op9_warc": op9_warc,
    "op10_line_crf": op10_line_crf,
    "op11_blob_ledger": op11_blob_ledger,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_mixing": mixing.SQL,
    "op9_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
}
