"""Root matching with spans."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.functions import vocab as V

_SPANS = "array<struct<root:string,start:int,end:int,text:string>>"


def alternation(roots: Sequence[str]) -> str:
    """Longest first, so a root wins over its own beginning."""
    return "|".join(re.escape(r) for r in sorted(roots, key=lambda r: (-len(r), r)))


def root_texts(c: Column, roots: Sequence[str] = V.ROOTS, whole_words: bool = False) -> Column:
    """Leftmost, longest, non-overlapping root texts of a name (E2) or of whole words."""
    inner = f"(?:{alternation(roots)})"
    pattern = rf"(?iU)(?<!\w){inner}(?!\w)" if whole_words else f"(?i){inner}"
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), 0), lambda m: F.lower(m))
    empty = F.array().cast("array<string>")
    return F.when(c.isNull(), empty).when(~F.lit(whole_words) & c.startswith("xn--"), empty).otherwise(found)


def distinct_roots(texts: Column, roots: Sequence[str] = V.ROOTS) -> Column:
    """The roots that were hit, in the order of the list."""
    return F.filter(T.strings(roots), lambda r: F.array_contains(texts, r))


def root_spans(c: Column, roots: Sequence[str] = V.ROOTS) -> Column:
    """E2 with offsets (0-based, end exclusive): the text is split at marked matches and running
    lengths give the places, so no Python is needed."""
    marked = F.regexp_replace(F.translate(c, "\x01", "\x02"), f"(?i)({alternation(roots)})", "\x01$1\x01")
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(_SPANS).alias("out"))

    def step(acc, piece):
        end = acc["at"] + F.length(piece)
        span = F.struct(F.lower(piece).alias("root"), acc["at"].alias("start"), end.alias("end"), piece.alias("text"))
        out = F.when(acc["i"] % 2 == 1, F.array_append(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("at"), (acc["i"] + 1).alias("i"), out.alias("out"))

    found = F.aggregate(F.split(marked, "\x01", -1), state, step)["out"]
    return F.when(c.isNull() | c.startswith("xn--"), F.array().cast(_SPANS)).otherwise(found)


def root_spans_whole(frame: DataFrame, column: str, roots: Sequence[str] = V.ROOTS) -> DataFrame:
    """E3 with offsets, in Arrow batches."""
    pattern = re.compile(rf"(?<!\w)(?:{alternation(roots)})(?!\w)", re.I)

    @F.pandas_udf(_SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(
                lambda t: [{"root": m.group().lower(), "start": m.start(), "end": m.end(), "text": m.group()} for m in pattern.finditer(t or "")]
            )

    return frame.withColumn("spans", run(column))


def root_counts(hits: DataFrame, key: str, roots: Sequence[str] = V.ROOTS) -> DataFrame:
    """G7 over ``hits(key, roots)``: distinct keys per root, roots without hits included."""
    vocabulary = hits.sparkSession.createDataFrame([(r, i) for i, r in enumerate(roots)], "root string, position int")
    counts = hits.select(key, F.explode("roots").alias("root")).groupBy("root").agg(F.countDistinct(key).alias("n"))
    return F.broadcast(vocabulary).join(counts, "root", "left").select("root", "position", F.coalesce("n", F.lit(0)).alias("n"))
