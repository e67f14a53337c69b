"""WARC archives as seekable Zstandard bundles.

``write_archives`` turns pages into WARC/1.1 records and packs them, per task and in a stream, into
bundles: independent Zstandard frames of about ``FRAME_BYTES`` raw bytes, then a footer in the
seekable format (a skippable frame with one compressed and raw size per frame). Bundles are rows of
a table (bundle, data) of at most about ``BUNDLE_BYTES`` raw bytes each, so any store that Spark
reaches can hold them, together with an index (page_id, bundle, frame, offset, length) that maps
record identifiers to offsets within a frame. ``read_archives`` walks whole bundles; ``fetch``
reads single records by the index and decodes one frame each.

Of records with equal payloads of at least ``REVISIT_FROM`` bytes the one with the smallest page_id
is a response, the others revisit it without a payload; smaller payloads are always responses.

Defined results: a null html is an empty payload; a null url an empty target; rows that repeat a
page_id are separate records, and all of them are responses if theirs is the smallest page_id;
a null page_id sorts last and is written as an empty id; an empty table gives empty archives;
extra columns are not read. A payload beyond the frame or bundle size gets a frame or bundle alone.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_ids, materialise, text_id

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 23
REVISIT_FROM = 100
#: Fixed values of the seekable format: magic of the skippable frame and of the footer.
#: The profile of a revisit with an equal payload, as the format's standard names it.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time of capture; records need one.
DATE = "2026-01-01T00:00:00Z"
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

BUNDLE_SCHEMA = "bundle string, data binary, records array<struct<page_id:bigint,frame:int,offset:bigint,length:bigint>>"


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to, date: str = DATE) -> bytes:
    """One WARC record. A revisit has its payload's size and digest in its head only. The url stays as it is, but for line ends,
    which are percent-encoded."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head[5:5] = [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(raw: bytes) -> Iterator[tuple[dict, bytes, int, int]]:
    """Heads, payloads, offsets and lengths of the records in a raw frame."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = dict((x.split(": ", 1) + [""])[:2] for x in raw[at:end].decode().split("\r\n")[1:])
        start, size = end + 4, int(head["Content-Length"])
        stop = start + size + 4
        if raw[stop - 4 : stop] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, raw[start : start + size], at, stop - at
        at = stop


class Bundle:
    """Frames and their seek table, filled record by record."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.records: list[tuple] = []
        self.open: list[bytes] = []
        self.filled = self.raw = 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, page_id, data: bytes) -> None:
        if self.filled and self.filled + len(data) > FRAME_BYTES:
            self.close_frame()
        self.records.append((page_id, len(self.frames), self.filled, len(data)))
        self.open.append(data)
        self.filled += len(data)
        self.raw += len(data)

    def close_frame(self) -> None:
        raw = b"".join(self.open)
        frame = self.packer.compress(raw)
        self.frames.append(frame)
        self.sizes.append((len(frame), len(raw)))
        self.open, self.filled = [], 0

    def bytes(self) -> bytes:
        if self.open:
            self.close_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, raw size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    start = len(data) - 9 - 8 * n
    kind, size = struct.unpack("<II", data[start - 8 : start])
    if kind != SKIPPABLE or size != 8 * n + 9:
        raise ValueError("broken seek table")
    out, at = [], 0
    for k in range(n):
        packed, raw = struct.unpack("<II", data[start + 8 * k : start + 8 * k + 8])
        out.append((at, packed, raw))
        at += packed
    return out


def frame_at(data: bytes, entry: tuple[int, int, int]) -> bytes:
    at, packed, raw = entry
    return zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=raw)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bundle = Bundle()

    def out() -> pd.DataFrame:
        data = bundle.bytes()
        name = hashlib.sha256(data).hexdigest()
        keys = ("page_id", "frame", "offset", "length")
        return pd.DataFrame({"bundle": [name], "data": [data], "records": [[dict(zip(keys, r, strict=True)) for r in bundle.records]]})

    for pdf in batches:
        for page_id, url, payload, digest, size, refers in zip(
            pdf["page_id"], pdf["url"], pdf["payload"], pdf["digest"], pdf["size"], pdf["refers_to"], strict=True
        ):
            page_id = None if page_id is None else int(page_id)
            refers = None if refers is None else int(refers)
            data = record(page_id, url, bytes(payload), digest, size, refers)
            if bundle.raw and bundle.raw + len(data) > BUNDLE_BYTES:
                yield out()
                bundle = Bundle()
            bundle.add(page_id, data)
    if bundle.records:
        yield out()


def write_archives(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> a written table (bundle, data, records).

    The html is not shuffled to find equal payloads: digests alone are grouped (with partial
    aggregation, so thousands of copies meet as one row a task), and only pages that revisit
    come back, joined by page_id and digest.
    """
    rows = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    light = materialise(rows.select("page_id", "digest", "size"), "warc-digests")
    first = materialise(
        light.where(F.col("size") >= REVISIT_FROM).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "warc-first",
    )
    revisits = materialise(
        light.join(first, "digest").where("page_id <> first or page_id is null").select("page_id", "digest", F.col("first").alias("refers_to")).distinct(),
        "warc-revisits",
    )
    same = rows["page_id"].eqNullSafe(revisits["page_id"]) & (rows["digest"] == revisits["digest"])
    marked = rows.join(revisits, same, "left").select(
        rows["page_id"], "url", F.when(F.col("refers_to").isNull(), rows["payload"]).otherwise(F.lit(b"")).alias("payload"), rows["digest"], "size", "refers_to"
    )
    return materialise(marked.withColumns({c: text_id(c) for c in ("page_id", "refers_to")}).mapInPandas(_pack, BUNDLE_SCHEMA), "warc-bundles")


def index(bundles: DataFrame) -> DataFrame:
    """(page_id, bundle, frame, offset, length): where each record lies, relative to its frame."""
    return bundles.select("bundle", F.explode("records").alias("r")).select("r.page_id", "bundle", "r.frame", "r.offset", "r.length")


_READ_SCHEMA = (
    "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, url string, intact boolean"
)


def _id(text: str) -> str | None:
    return text.removeprefix("<urn:page:").removesuffix(">") or None


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for data in pdf["data"]:
            data = bytes(data)
            rows = []
            for entry in seek_table(data):
                for head, payload, _, _ in parse_records(frame_at(data, entry)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = head["WARC-Type"]
                    size = len(payload) if kind == "response" else int(head["X-Payload-Length"])
                    good = kind == "revisit" or (hashlib.sha256(payload).hexdigest() == digest and size == int(head["X-Payload-Length"]))
                    refers = _id(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
                    rows.append((_id(head["WARC-Record-ID"]), size, digest, kind, refers, head["WARC-Target-URI"], good))
            names = [c.split()[0] for c in _READ_SCHEMA.split(", ")]
            yield pd.DataFrame(rows, columns=names)


def read_archives(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, with its digest checked against the payload read."""
    return long_ids(bundles.select("data").mapInPandas(_unpack, _READ_SCHEMA), "page_id", "refers_to")


def _fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for data, wanted in zip(pdf["data"], pdf["wanted"], strict=True):
            data = bytes(data)
            table = seek_table(data)
            for w in wanted:
                raw = frame_at(data, table[w["frame"]])[w["offset"] : w["offset"] + w["length"]]
                head, payload, _, _ = next(parse_records(raw))
                out.append((_id(head["WARC-Record-ID"]), head["WARC-Type"], payload))
        yield pd.DataFrame(out, columns=["page_id", "record_type", "payload"])


def fetch(bundles: DataFrame, ids: DataFrame) -> DataFrame:
    """Random access: the records of ``ids(page_id)``, one frame decoded for each."""
    where = index(bundles).join(ids.select("page_id").distinct(), "page_id")
    wanted = where.groupBy("bundle").agg(F.collect_list(F.struct("page_id", "frame", "offset", "length")).alias("wanted"))
    found = bundles.select("bundle", "data").join(wanted, "bundle").select("data", "wanted").mapInPandas(
        _fetch, "page_id string, record_type string, payload binary"
    )
    return long_ids(found, "page_id")
