"""Saved bodies, and whether they still parse to the fields that were saved with them."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.operators import pages

#: Fields that must parse to the same value; the visible text may vary and is reported.
STRICT = ("title", "description", "og_description", "h1")
_FIELDS = "struct<title:string,description:string,og_description:string,h1:array<string>,visible_text:string>"
_PARSED = pa.struct([("title", pa.string()), ("description", pa.string()), ("og_description", pa.string()), ("h1", pa.list_(pa.string())), ("visible_text", pa.string())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [gzip.compress(b.as_py(), mtime=0) for b in batch.column("body")]
        yield pa.RecordBatch.from_arrays([batch.column("sha256"), batch.column("bytes"), pa.array(packed, pa.binary())], names=["sha256", "bytes", "packed"])


def stored_bodies(requests: DataFrame, body: str = "body") -> DataFrame:
    """(sha256, bytes, packed) of the distinct bodies, gzipped; bytes are those of the body as it was.

    Copies meet as partial aggregates, so a body that very many requests share moves once a task.
    """
    raw = requests.select(F.col(body).cast("binary").alias("body")).where("body is not null").withColumn("sha256", F.sha2("body", 256))
    distinct = raw.groupBy("sha256").agg(F.first("body").alias("body")).select("sha256", F.octet_length("body").cast("long").alias("bytes"), "body")
    return distinct.mapInArrow(_pack, "sha256 string, bytes bigint, packed binary")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        problems, fields = [], []
        for sha, size, packed, kind in zip(*(batch.column(c) for c in ("sha256", "bytes", "packed", "content_type")), strict=True):
            problem = parsed = None
            try:
                body = gzip.decompress(packed.as_py())
                if hashlib.sha256(body).hexdigest() != sha.as_py():
                    problem = "hash_mismatch"
                elif len(body) != size.as_py():
                    problem = "length_mismatch"
                else:
                    parsed = pages.read_fields(pages.decode_body(body, kind.as_py()))
            except (OSError, EOFError, zlib.error):
                problem = "unreadable_body"
            problems.append(problem)
            fields.append(parsed)
        yield pa.RecordBatch.from_arrays(
            [batch.column("sha256"), batch.column("content_type"), pa.array(problems, pa.string()), pa.array(fields, _PARSED)], names=["sha256", "content_type", "problem", "parsed"]
        )


def parsed_bodies(bodies: DataFrame, kinds: DataFrame) -> DataFrame:
    """Every stored body, unpacked, checked against its hash and length, decoded and parsed once per content type that it was sent
    with: (sha256, content_type, problem, parsed)."""
    wanted = kinds.select("sha256", "content_type").where("sha256 is not null").distinct()
    return bodies.join(wanted, "sha256").select("sha256", "bytes", "packed", "content_type").mapInArrow(_parse, f"sha256 string, content_type string, problem string, parsed {_FIELDS}")


def reparse_problems(rows: DataFrame, bodies: DataFrame, key: str = "domain") -> DataFrame:
    """K12 over ``rows(key, sha256, content_type, title, description, og_description, h1, visible_text)``: per row what differs.

    (key, problems, saved_characters, parsed_characters, text_varies): ``problems`` are missing_body (fields without a body, unless
    all are empty), hash_mismatch, length_mismatch, unreadable_body, or the names of the strict fields that parse to something
    else; a visible text that varies is reported with its lengths and is no problem. Equal bodies are parsed once; a null field
    equals an empty one.
    """
    parsed = parsed_bodies(bodies, rows)
    same_kind = rows["content_type"].eqNullSafe(parsed["content_type"])
    joined = rows.join(parsed, (rows["sha256"] == parsed["sha256"]) & same_kind, "left").select(*[rows[c] for c in rows.columns], "problem", "parsed")
    blank = lambda c: F.coalesce(F.array_join(c, "") if c is h1 else c, F.lit("")) == ""
    h1 = F.col("h1")
    empty = blank(F.col("title")) & blank(F.col("description")) & blank(F.col("og_description")) & blank(h1) & blank(F.col("visible_text"))
    none = F.array().cast("array<string>")
    differs = [F.when(F.coalesce(F.col(f), none if f == "h1" else F.lit("")) != F.coalesce(F.col(f"parsed.{f}"), none if f == "h1" else F.lit("")), f) for f in STRICT]
    problems = (
        F.when(F.col("problem").isNotNull(), F.array("problem"))
        .when(F.col("parsed").isNull(), F.when(empty, none).otherwise(F.array(F.lit("missing_body"))))
        .otherwise(F.array_compact(F.array(*differs)))
    )
    text = F.coalesce("visible_text", F.lit(""))
    varies = F.col("parsed").isNotNull() & (text != F.coalesce("parsed.visible_text", F.lit("")))
    return joined.select(key, problems.alias("problems"), F.length(text).alias("saved_characters"), F.length("parsed.visible_text").alias("parsed_characters"), varies.alias("text_varies"))
