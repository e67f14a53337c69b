"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts longer than ``CHUNK`` code points are cut into overlapping chunks, one row each, and spread
over the cluster; shorter ones are a single chunk. Every chunk is pre-tokenised alone and its
pieces are encoded by merge ranks. The pattern never looks back, so two chunkings that share one
piece boundary agree from there on: ``stitch`` follows a chunk until one of its boundaries is also
a boundary of the next chunk and goes on there. A piece that touches the end of its chunk is not
trusted, since the pattern looks one character ahead. Where two chunks share no boundary in their
overlap (one word as long as a chunk), the text is re-read from the last sure boundary on until it
meets a boundary of a later chunk. The result is that of one pass over the whole text.

Decoding looks up the bytes of each id and concatenates them.

Defined results: a null text is encoded as the empty text (no ids); lone surrogates cannot occur in
a text column; repeated rows and repeated or null ids are encoded row by row; an empty table gives
an empty result; other columns are not read. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_ids, text_id

CHUNK = 1 << 15
OVERLAP = 1 << 9
#: Pieces remembered by a task; the memory is emptied when full.
CACHE = 400_000


class Codec:
    """Merge ranks, pre-token pattern and the bytes of each id."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.split = regex.compile(pattern)
        self.core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.seen: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token, as little-endian 32-bit integers."""
        got = self.seen.get(piece)
        if got is None:
            ids = self.core._core_bpe.encode_single_piece(piece.encode())
            got = np.array(ids, dtype="<u4").tobytes()
            if len(piece) <= 64:
                if len(self.seen) >= CACHE:
                    self.seen.clear()
                self.seen[piece] = got
        return got

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join([self.piece(p) for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def chunk_starts(length: int, chunk: int = CHUNK) -> list[int]:
    return list(range(0, max(length, 1), chunk))


def pieces_of(split, text: str, at: int, window: tuple[int, int], last: bool) -> tuple[list[str], list[int], int]:
    """Pieces of ``text[at:]``, their starts in the whole text, and where the sure part ends."""
    found, starts = [], []
    base, end = window
    for m in split.finditer(text, at):
        if m.end() == end - base and not last:
            break
        found.append(m.group())
        starts.append(base + m.start())
    sure = starts[-1] + len(found[-1]) if found else base + at
    return found, starts, sure


def stitch(split, parts: list[tuple[int, str, list[str], list[int], int]], length: int) -> list[str]:
    """Pieces of the whole text from its chunks (start, text, pieces, starts, sure end), in order."""
    out: list[str] = []
    at = 0  # sure boundary reached so far
    for k, (base, text, pieces, starts, sure) in enumerate(parts):
        following = parts[k + 1] if k + 1 < len(parts) else None
        if at > base + len(text) or (following and at > following[0] + len(following[1])):
            continue
        own = bisect.bisect_left(starts, at)
        if own == len(starts) or starts[own] != at:  # no shared boundary: read on from the last sure one
            pieces, starts, sure = pieces_of(split, text, at - base, (base, base + len(text)), following is None)
            own = 0
        if following is None:
            out += pieces[own:]
            at = length
            continue
        meet = set(following[3])
        stop = own
        while stop < len(starts) and not (starts[stop] >= following[0] and starts[stop] in meet):
            stop += 1
        out += pieces[own:stop]
        if stop < len(starts):
            at = starts[stop]
        elif sure in meet or sure >= following[0]:
            at = sure
        else:  # one piece spans the rest of this chunk: join it with the next one
            base2, text2 = following[0], following[1]
            joined = text + text2[len(text) - (base2 - base):]
            more = pieces_of(split, joined, sure - base, (base, base + len(joined)), k + 2 == len(parts))
            parts[k + 1] = (base, joined, *more)
            at = sure
    return out


def encode_text(text: str, own: Codec, chunk: int = CHUNK, overlap: int = OVERLAP) -> bytes:
    """Ids of a text by chunks, without Spark."""
    if len(text) <= chunk:
        return own.encode(own.split.findall(text))
    parts = []
    for base in chunk_starts(len(text), chunk):
        end = min(len(text), base + chunk + overlap)
        parts.append((base, text[base:end], *pieces_of(own.split, text[base:end], 0, (base, end), end == len(text))))
    return own.encode(stitch(own.split, parts, len(text)))


def _digest(doc_id, ids: bytes, own: Codec) -> tuple:
    return doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()


_OUT = "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"n_tokens": "int64"})


def _encode_short(path: str, pattern: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for pdf in batches:
            yield _frame([_digest(i, own.encode(own.split.findall(t)), own) for i, t in zip(pdf["doc_id"], pdf["text"], strict=True)])

    return run


def _pretokenise(path: str, pattern: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for pdf in batches:
            ends, sures = [], []
            for base, text, last in zip(pdf["base"], pdf["chunk"], pdf["last"], strict=True):
                _, starts, sure = pieces_of(own.split, text, 0, (base, base + len(text)), last)
                ends.append(np.array(starts, dtype="<i4").tobytes())
                sures.append(sure)
            yield pdf.assign(starts=ends, sure=sures)

    return run


def _stitch_rows(path: str, pattern: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for pdf in batches:
            rows = []
            for doc_id, length, chunks in zip(pdf["doc_id"], pdf["length"], pdf["chunks"], strict=True):
                parts = []
                for c in sorted(chunks, key=lambda c: c["base"]):
                    base, text = c["base"], c["chunk"]
                    starts = np.frombuffer(c["starts"], dtype="<i4").tolist()
                    bounds = [s - base for s in starts] + [c["sure"] - base]
                    parts.append((base, text, [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)], starts, c["sure"]))
                rows.append(_digest(doc_id, own.encode(stitch(own.split, parts, length)), own))
            yield _frame(rows)

    return run


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_tokens, ids_sha256, decoded_sha256, one row per document.

    Only texts longer than a chunk are shuffled, as chunks; a document's chunks meet again in one
    group, no larger than the document row was.
    """
    rows = docs.select(text_id("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("length", F.length("text"))
    short = rows.where(F.col("length") <= chunk).select("doc_id", "text").mapInPandas(_encode_short(path, pattern), _OUT)
    cut = (
        rows.where(F.col("length") > chunk)
        .withColumn("key", F.sha2("text", 256))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("base", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(chunk))))
        .select(
            "doc_id", "key", "row", "length", "base",
            F.expr(f"substring(text, base + 1, {chunk + overlap})").alias("chunk"),
            (F.col("base") + chunk + overlap >= F.col("length")).alias("last"),
        )
        .repartition(F.col("key"), F.col("base"))
    )
    schema = "doc_id string, key string, row bigint, length int, base int, chunk string, last boolean, starts binary, sure int"
    ready = cut.mapInPandas(_pretokenise(path, pattern), schema)
    grouped = ready.groupBy("doc_id", "key", "row").agg(
        F.first("length").alias("length"), F.collect_list(F.struct("base", "chunk", "starts", "sure")).alias("chunks")
    )
    long = grouped.select("doc_id", "length", "chunks").mapInPandas(_stitch_rows(path, pattern), _OUT)
    return long_ids(short.unionByName(long), "doc_id")


def encode_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, ids (array of int): the ids themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for pdf in batches:
            ids = [np.frombuffer(encode_text(t, own), dtype="<u4").astype("int32") for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids})

    ids = docs.select(text_id("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "doc_id string, ids array<int>")
    return long_ids(ids, "doc_id")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded(doc_id, ids)`` -> doc_id, data (the bytes); null ids decode to nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for pdf in batches:
            data = [own.decode(np.asarray(() if i is None else i, dtype="<u4").tobytes()) for i in pdf["ids"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "data": data})

    return long_ids(encoded.select(text_id("doc_id"), "ids").mapInPandas(run, "doc_id string, data binary"), "doc_id")
