"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over ``WINDOW`` bytes ends a piece wherever it is -1 modulo the block size, so
boundaries depend on near-by content only and an edit changes the pieces it touches. Each piece adds
one of 64 letters to the signature. The block size is the least ``3 * 2**k`` that expects at most
``PIECES`` pieces, halved while the text gives fewer than ``FEW`` letters and doubled while it gives
more than ``PIECES``; a second signature uses twice the block size.
Two fingerprints are compared at block sizes they share, by edit distance of the signatures, if
these have ``COMMON`` letters in a row in common.

Documents are paired with their neighbour in descending id order without a global sort in one task:
quantiles of the ids cut the order into slices (rows of ids only), the first document of each slice
is repeated at the end of the slice before it, and every slice is then read in order by itself.

Defined results: null texts count as empty; the empty text has the fingerprint ``3::`` and is like
itself only; documents without an id come last; equal ids are ordered by text hash, so equal rows
follow each other; with one document the next one is itself; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import long_ids, text_id

WINDOW = 7
PIECES = 64
FEW = 16
RUN = 3
COMMON = 4
LEAST_BLOCK = 3
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Most slices of the id order: what the driver and the plan hold is bounded by it. A slice is
#: sorted by one task, so 100 TB in 16,384 slices means about 6 GB a task, in spillable sorts.
MOST_SLICES = 1 << 14


def rolling(data: bytes) -> np.ndarray:
    """Hash of the last ``WINDOW`` bytes at each position (fewer at the start)."""
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    out = raw.copy()
    factor = np.uint32(1)
    for back in range(1, WINDOW):
        factor = np.uint32(int(factor) * 0x9E3779B1 & 0xFFFFFFFF)
        out[back:] += raw[:-back] * factor if back < len(raw) else np.uint32(0)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    return out


def signature(data: bytes, hashes: np.ndarray, block: int) -> str:
    """A letter for each piece that ends where the hash is -1 modulo the block; of more than
    ``RUN`` equal letters in a row only that many stay, so repetitions do not crowd out the rest."""
    cuts = [0, *(np.flatnonzero(hashes % np.uint32(block) == block - 1) + 1).tolist()]
    if cuts[-1] < len(data):
        cuts.append(len(data))
    view = memoryview(data)
    letters = "".join([LETTERS[zlib.crc32(view[a:b]) & 63] for a, b in zip(cuts, cuts[1:], strict=False)])
    return re.sub(rf"(.)\1{{{RUN},}}", lambda m: m[1] * RUN, letters)


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``."""
    data = text.encode()
    if not data:
        return f"{LEAST_BLOCK}::"
    hashes = rolling(data) if len(data) >= WINDOW else rolling(data + bytes(WINDOW))[: len(data)]
    block = LEAST_BLOCK
    while len(data) > PIECES * block:
        block *= 2
    letters = signature(data, hashes, block)
    while len(letters) < FEW and block > LEAST_BLOCK:
        block //= 2
        letters = signature(data, hashes, block)
    while len(letters) > PIECES:
        block *= 2
        letters = signature(data, hashes, block)
    return f"{block}:{letters}:{signature(data, hashes, 2 * block)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel over the first string."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        hp, hn = minus | (full & ~(d | plus)), plus & d
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1 | 1) & full, (hn << 1) & full
        plus, minus = hn | (full & ~(x | hp)), hp & x
    return score


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    if min(len(a), len(b)) >= COMMON:
        runs = {a[i : i + COMMON] for i in range(len(a) - COMMON + 1)}
        if not any(b[i : i + COMMON] in runs for i in range(len(b) - COMMON + 1)):
            return 0.0
    elif abs(len(a) - len(b)) > COMMON:
        return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(one: str, two: str) -> float:
    """Likeness of two fingerprints, 0 to 1; 0 at block sizes that do not meet."""
    if one == two:
        return 1.0
    b1, s1, d1 = one.split(":")
    b2, s2, d2 = two.split(":")
    b1, b2 = int(b1), int(b2)
    if b1 == b2:
        return max(_alike(s1, s2), _alike(d1, d2) if min(len(d1), len(d2)) >= 8 else 0.0)
    if b1 == 2 * b2:
        return _alike(s1, d2)
    if b2 == 2 * b1:
        return _alike(d1, s2)
    return 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third (floor) replaced by the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_SCHEMA = (
    "doc_id string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None  # (id, text, fingerprint) that waits for the next row of its slice
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    for pdf in batches:
        rows = []
        for doc_id, text, closing in zip(pdf["doc_id"], pdf["text"], pdf["closing"], strict=True):
            own = fingerprint(text)
            if held is not None:
                key, before, print_before = held
                new = edited(before, text)
                print_new = fingerprint(new)
                sha = hashlib.sha256(new.encode()).hexdigest()
                rows.append((key, len(before), sha, print_before, print_new, likeness(print_before, print_new), likeness(print_before, own)))
            held = None if closing else (doc_id, text, own)
        yield pd.DataFrame(rows, columns=names).astype({"n_chars": "int64", "near_edited": "float64", "near_next": "float64"})


def _above(marks: list[int], value: Column) -> Column:
    """How many of the sorted marks lie above a value: found in a row of coarse marks first, then in
    the one block of marks that they leave open."""
    if not marks:
        return F.lit(0)
    width = max(1, math.isqrt(len(marks)))
    blocks = [marks[k : k + width] for k in range(0, len(marks), width)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = F.size(F.filter(longs([b[0] for b in blocks]), lambda m: m <= value))  # blocks that start at or below
    inside = F.size(F.filter(F.get(F.array(*map(longs, blocks)), below - 1), lambda m: m <= value))
    return F.lit(len(marks)) - F.when(below == 0, F.lit(0)).otherwise((below - 1) * width + inside)


def in_order(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Rows (slice, doc_id, text, closing) such that each slice, sorted, is a run of the descending
    id order closed by the first document of the next slice (after the last: of the first)."""
    spark = docs.sparkSession
    n = min(MOST_SLICES, slices or 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = [k / n for k in range(1, n)] or [0.5]
    marks = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * n)).alias("m")).first()["m"] or []
    place = F.when(F.col("doc_id").isNull(), F.lit(len(set(marks)) + 1)).otherwise(_above(sorted(set(marks)), F.col("doc_id")))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        place.alias("slice"), "doc_id", F.xxhash64("text").alias("h"), "text"
    )
    first = F.min_by(F.struct("doc_id", "h"), F.struct(F.col("doc_id").isNull().alias("n"), (-F.col("doc_id")).alias("i"), "h"))
    heads = sorted((r["slice"], r["f"]["doc_id"], r["f"]["h"]) for r in rows.groupBy("slice").agg(first.alias("f")).collect())
    before = [(heads[k - 1][0], i, h) for k, (_, i, h) in enumerate(heads)]
    closing = F.broadcast(spark.createDataFrame(before, "to int, id long, head long")) if before else None
    if closing is None:
        return rows.withColumn("closing", F.lit(False))
    ends = (
        rows.join(closing, rows["doc_id"].eqNullSafe(closing["id"]) & (rows["h"] == closing["head"]))
        .select(F.col("to").alias("slice"), "doc_id", "h", "text")
        .dropDuplicates(["slice"])
    )
    return rows.withColumn("closing", F.lit(False)).unionByName(ends.withColumn("closing", F.lit(True)))


def compare(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> fingerprints of every text and of its edited text, and likenesses."""
    rows = in_order(docs, slices).repartition("slice")
    rows = rows.sortWithinPartitions("slice", "closing", F.col("doc_id").desc_nulls_last(), "h")
    return long_ids(rows.select(text_id("doc_id"), "text", "closing").mapInPandas(_slices, _SCHEMA), "doc_id")
