"""Readers of lines, JSON lines, captures, exports and configuration."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.functions import text as T


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """A1: lower-case stripped lines without byte order marks and blanks."""
    line = F.lower(F.trim(F.regexp_replace("value", "^﻿", "")))
    return spark.read.text(path).select(line.alias("name")).where("name <> ''")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2 and A3: (source_path, source_date, source_line from 1, raw, reason_code): lines split at
    the byte level, each decoded on its own; a bad one has the reason ``invalid_utf8``.

    A daily file is the unit of work, so line numbers need no order between tasks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path_, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                lines = content.split(b"\n")
                for i, line in enumerate(lines[:-1] if lines and lines[-1] == b"" else lines, 1):
                    line = line.removesuffix(b"\r")
                    try:
                        rows.append((path_, i, line.decode("utf-8-sig" if i == 1 else "utf-8"), None))
                    except UnicodeDecodeError:
                        rows.append((path_, i, None, "invalid_utf8"))
                yield pd.DataFrame(rows, columns=["source_path", "source_line", "raw", "reason_code"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    out = files.mapInPandas(run, "source_path string, source_line long, raw string, reason_code string")
    return out.withColumn("source_date", T.source_date(F.substring_index("source_path", "/", -1)))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Path, bytes and SHA-256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def in_window(lines: DataFrame, start: str, end: str) -> DataFrame:
    """A4: dated rows between two days; undated ones are left out."""
    return lines.where(F.col("source_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def day_tokens(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A5: the days of a range with the URL-safe token of each archive name."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    token = F.translate(F.base64(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(".zip"))), "+/", "-_")
    return days.withColumn("token", token)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON array per file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str, tolerant: str = "none") -> DataFrame:
    """``none`` fails on a bad line, ``any`` drops bad lines, ``tail`` keeps them in
    ``_corrupt_record`` for ``bad_before_end``."""
    reader = spark.read
    if tolerant == "none":
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    if tolerant == "any":
        return reader.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return reader.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def bad_before_end(lines: DataFrame, schema: str) -> DataFrame:
    """Broken lines that are not the last of their file; ``lines`` come from ``read_lines``."""
    last = lines.groupBy("source_path").agg(F.max("source_line").alias("_last"))
    parsed = F.from_json("raw", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    broken = lines.withColumn("_p", parsed).where("_p._corrupt_record is not null or raw is null")
    return broken.join(last, "source_path").where("source_line < _last").select("source_path", "source_line")


def excluded_names(records: DataFrame, column: str = "domain") -> DataFrame:
    """Distinct lower-case names without trailing dots."""
    return records.select(F.lower(F.regexp_replace(column, r"\.+$", "")).alias("domain")).where("domain <> ''").distinct()


def parse_export(raw: str | None, term: str, geo: str = "US", days: int = 30) -> tuple[str, list[tuple[str, int]]]:
    """(problem or empty, points) of an exported series: a heading row with Day or Week,
    the exact term and place, then ascending unique dates with whole numbers from 0 to 100."""
    heads = ("day", "week", "日", "周")
    rows = [line.strip().split(",") for line in (raw or "").lstrip("﻿").splitlines() if line.strip()]
    at = [i for i, r in enumerate(rows) if len(r) == 2 and r[0].strip().lower() in heads]
    if len(at) != 1:
        return "heading", []
    name = rows[at[0]][1].strip()
    place = {"US": ("(United States)", "(美国)")}.get(geo, (f"({geo})",))
    if name.rsplit(":", 1)[0].strip() != term or not name.endswith(place):
        return "term", []
    points: list[tuple[str, int]] = []
    for r in rows[at[0] + 1 :]:
        if len(r) != 2 or not r[1].strip().isdigit() or not 0 <= int(r[1]) <= 100:
            return "value", []
        if points and r[0] <= points[-1][0]:
            return "order", []
        points.append((r[0], int(r[1])))
    if rows[at[0]][0].strip().lower() in ("day", "日") and len(points) != days:
        return "length", []
    return "", points


def read_exports(spark: SparkSession, path: str, terms: dict[str, str], geo: str = "US") -> DataFrame:
    """Exports by file name: ``terms`` maps a file's name to its term; (file, term, problem, day, value)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                name = file.rsplit("/", 1)[-1]
                if name in terms:
                    problem, points = parse_export(content.decode("utf-8", "replace"), terms[name], geo)
                    rows += [(name, terms[name], problem, d, v) for d, v in points] or [(name, terms[name], problem, None, None)]
            yield pd.DataFrame(rows, columns=["file", "term", "problem", "day", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, term string, problem string, day string, value int")


def capture_status(message: Column, has_series: Column) -> Column:
    """A chart, an explicit lack of data, or an error; error text is never lack of data."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(low.rlike(r"captcha|403|429|something went wrong|error"), "error")
        .when(has_series, "chart")
        .when(low.rlike("not enough data|doesn't have enough data|数据不足"), "no_data")
        .otherwise("error")
    )


def chart_points(payload: Column) -> Column:
    """(day seconds, value) of the first timeline of a saved response, after its prefix."""
    body = F.regexp_replace(payload, r"^\)\]\}'[,]?\s*", "")
    schema = "struct<default:struct<timelineData:array<struct<time:string,value:array<int>,isPartial:boolean>>>>"
    return F.transform(F.from_json(body, schema)["default"]["timelineData"], lambda p: F.struct(p["time"].cast("long").alias("at"), F.get(p["value"], F.lit(0)).alias("value"), F.coalesce(p["isPartial"], F.lit(False)).alias("partial")))


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Gzip bodies named by their hash: (name, bytes, intact)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                name = file.rsplit("/", 1)[-1].removesuffix(".gz")
                try:
                    body = gzip.decompress(content)
                    rows.append((name, len(body), hashlib.sha256(body).hexdigest() == name))
                except (OSError, EOFError):
                    rows.append((name, None, False))
            yield pd.DataFrame(rows, columns=["name", "bytes", "intact"]).astype({"bytes": "Int64"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "name string, bytes long, intact boolean")


def read_lexicon(spark: SparkSession, path: str, sha256: str | None = None) -> list[str]:
    """A word list, refused if its hash is not the expected one. The list is a parameter of the
    classifier and small by contract."""
    if sha256 is not None:
        got = [r["sha256"] for r in file_hashes(spark, path).collect()]
        if got != [sha256]:
            raise ValueError("the word list has another hash")
    return [r["value"] for r in spark.read.text(path).select(F.lower(F.trim("value")).alias("value")).where("value <> ''").distinct().collect()]


def check_groups(groups: Sequence[tuple[str, int, Sequence[str]]]) -> None:
    """Unique names and suffixes, shares of 100 in all, one fallback."""
    names, suffixes = [g for g, _, _ in groups], [s for _, _, own in groups for s in own]
    if len(set(names)) != len(names) or len(set(suffixes)) != len(suffixes):
        raise ValueError("groups and suffixes must be unique")
    if sum(s for _, s, _ in groups) != 100 or sum(not own for _, _, own in groups) != 1:
        raise ValueError("shares must sum to 100 and one group must take the rest")


def check_roots(roots: Sequence[str]) -> None:
    """Unique lower-case letters."""
    if len(set(roots)) != len(roots) or not all(r.isascii() and r.isalpha() and r.islower() for r in roots):
        raise ValueError("roots must be unique words of lower-case letters")


def registry_servers(bootstrap: DataFrame) -> DataFrame:
    """A22 over ``bootstrap(services: array<array<array<string>>>)``: (tld, server)."""
    one = bootstrap.select(F.explode("services").alias("s"))
    return one.select(F.explode(F.get("s", F.lit(0))).alias("tld"), F.get(F.get("s", F.lit(1)), F.lit(0)).alias("server"))
