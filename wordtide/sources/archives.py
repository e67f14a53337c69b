"""Daily archives of names (A4, A5): inflated in a stream, under caps, with a reason for each that is refused."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.functions import text as T

_CHUNK, _LINES = 1 << 16, 4096
OUT = "source_path string, line bigint, name string, reason string"


@dataclass(frozen=True)
class Caps:
    """What an archive may be. Fixed values of the daily lists; all of them may be set."""

    member: str = "domain-names.txt"
    packed: int = 10 * 1024 * 1024
    raw: int = 30 * 1024 * 1024
    least_rows: int = 1000


def window_reason(date: Column, start: str | None = None, end: str | None = None) -> Column:
    """A4: ``undated`` where a window is asked for and the source has no date, ``out_of_window``, or null."""
    if start is None and end is None:
        return F.lit(None).cast("string")
    early = F.lit(False) if start is None else date < F.lit(start).cast("date")
    late = F.lit(False) if end is None else date > F.lit(end).cast("date")
    return F.when(date.isNull(), "undated").when(early | late, "out_of_window")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the archives in a folder or glob. Spark passes over files of no bytes."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def _inflated(member, cap: int) -> Iterator[bytes]:
    """Pieces of a member; no more than the cap is ever inflated, whatever the archive's list says of its size."""
    size = 0
    while piece := member.read(min(_CHUNK, cap + 1 - size)):
        size += len(piece)
        if size > cap:
            raise OverflowError
        yield piece


def _lines(archive: zipfile.ZipFile, caps: Caps) -> Iterator[str]:
    """Stripped lower-case lines that are not blank, decoded a line at a time."""
    rest, first = b"", True
    with archive.open(caps.member) as member:
        for piece in _inflated(member, caps.raw):
            *whole, rest = (rest + piece).splitlines(keepends=True) or [b""]
            if rest.endswith(b"\n"):
                whole, rest = [*whole, rest], b""
            for raw in whole:
                text, first = raw.decode("utf-8-sig" if first else "utf-8").strip().lower(), False
                if text:
                    yield text
        text = rest.decode("utf-8-sig" if first else "utf-8").strip().lower()
        if text:
            yield text


def _refusal(content: bytes, caps: Caps) -> str | None:
    """Why an archive is refused, after one pass over all of it that keeps nothing."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            if archive.namelist() != [caps.member]:
                return "unexpected_members"
            if archive.getinfo(caps.member).file_size > caps.raw:
                return "raw_too_large"
            rows = sum(1 for _ in _lines(archive, caps))
    except OverflowError:
        return "raw_too_large"
    except UnicodeDecodeError:
        return "invalid_utf8"
    except (zipfile.BadZipFile, zlib.error, EOFError) as e:
        return "crc_failed" if "CRC" in str(e) or isinstance(e, zlib.error | EOFError) else "not_an_archive"
    except (NotImplementedError, RuntimeError):
        return "not_readable"
    return "too_few_rows" if rows < caps.least_rows else None


def _read(caps: Caps):
    names = ["source_path", "line", "name", "reason"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string()]

    def table(path: str, first: int, lines: list, reason: str | None) -> pa.RecordBatch:
        columns = ([path] * len(lines), range(first, first + len(lines)) if reason is None else [None], lines, [reason] * len(lines))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, reason, content in zip(*(batch.column(i) for i in range(3)), strict=True):
                path, reason = path.as_py(), reason.as_py()
                content = None if reason else content.as_py()
                reason = reason or ("not_an_archive" if content is None else _refusal(content, caps))
                if reason:
                    yield table(path, 0, [None], reason)
                    continue
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    held, at = [], 1
                    for text in _lines(archive, caps):
                        held.append(text)
                        if len(held) == _LINES:
                            yield table(path, at, held, None)
                            held, at = [], at + _LINES
                    if held:
                        yield table(path, at, held, None)

    return run


def read_archives(files: DataFrame, caps: Caps = Caps(), start: str | None = None, end: str | None = None) -> DataFrame:
    """``files(path, length, content)`` -> (source_path, source_date, line, name, reason): the lines of good archives, numbered
    from 1, and one row with a reason for each other one.

    Reasons, the first that fits: undated, out_of_window, archive_too_large (such a file is not opened), not_an_archive,
    unexpected_members, raw_too_large, crc_failed, invalid_utf8, too_few_rows, not_readable. An archive is the unit of work; its
    packed bytes are in memory, its text never is: it is inflated twice, first to be judged.
    """
    date = T.source_date(F.substring_index("path", "/", -1))
    reason = F.coalesce(window_reason(date, start, end), F.when(F.col("length").isNull(), "not_an_archive").when(F.col("length") > caps.packed, "archive_too_large"))
    small = F.col("length") <= caps.packed  # reaches the reader, which opens no larger file
    fine = files.where(small).where(reason.isNull()).select("path", reason.alias("reason"), "content")
    refused = files.where(reason.isNotNull()).select("path", reason.alias("reason"), F.lit(None).cast("binary").alias("content"))
    out = fine.unionByName(refused).mapInArrow(_read(caps), OUT)
    return out.select("source_path", T.source_date(F.substring_index("source_path", "/", -1)).alias("source_date"), "line", "name", "reason")


def manifest(lines: DataFrame) -> DataFrame:
    """One row per archive: date, status, reason, rows and distinct names."""
    g = lines.groupBy("source_path", "source_date").agg(F.max("reason").alias("reason"), F.count("name").alias("rows"), F.countDistinct("name").alias("unique_names"))
    return g.withColumn("status", F.when(F.col("reason").isNull(), "ok").otherwise("error"))
