"""Periodic runs of words: recursive frequency splitting, then a scan of lags.

A run is a stretch of consecutive words with smallest period q and at least ``max(24, 3 q)`` words that no
neighbouring word extends. ``find`` gives every run of a text and the text with each run cut to its first period.

* *Splitting.* A run holds each of its words three times or more, so a word that occurs less often in a segment
  lies in no run of it. Such words split the segment; counts are then taken within the pieces, and so on until
  nothing changes. Only the smaller pieces are counted anew (the largest keeps the old counts less theirs), so
  this takes n log n steps however deep it goes.
* *Pruning.* In a run every eight words recur one period on or back; a segment is cut to stretches of such positions.
* *Scan.* A run of period q holds two whole neighbouring blocks of q words that begin at multiples of q. For each
  lag those blocks are compared by sums of word hashes (n / q comparisons), and equal ones are checked and extended
  word by word. All lags together take n log n steps, so a text of a million words in one stubborn segment is no
  different in kind. Hashes only propose; words decide.

Every text is worked on by itself, so nothing is shuffled.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no words, no runs and an empty rest;
a null ``doc_id`` is kept as null and repeated rows are separate rows; runs may overlap, and a word goes if any run
holds it after that run's first period; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST, TIMES = 24, 3
WORD = r"[^\x20\x09-\x0D]+"
#: Words of the windows that must recur. Every run of at least SHORTEST words and TIMES periods has 2 q + GRAM - 1.
GRAM = 8
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ROWS_A_BATCH = 512


def _between(cuts: list[int], start: int, stop: int) -> list[tuple[int, int]]:
    """The pieces of a segment between cuts that are long enough for a run."""
    return [(a + 1, b) for a, b in zip([start - 1, *cuts], [*cuts, stop], strict=True) if b - a - 1 >= SHORTEST]


def surviving(words: np.ndarray) -> list[tuple[int, int]]:
    """Segments of at least SHORTEST words in which every word occurs TIMES times or more."""
    n = len(words)
    if n < SHORTEST:
        return []
    order = np.argsort(words, kind="stable")
    first = np.searchsorted(words[order], np.arange(int(words.max()) + 2))

    def places(word: int, start: int, stop: int) -> list[int]:
        at = order[first[word] : first[word + 1]]
        return at[np.searchsorted(at, start) : np.searchsorted(at, stop)].tolist()

    todo, kept = [(0, n, None, None)], []  # the last two: counts that are known already, and words whose count has changed
    while todo:
        start, stop, counts, doubtful = todo.pop()
        if counts is None:
            values, which, numbers = np.unique(words[start:stop], return_inverse=True, return_counts=True)
            cuts = (np.flatnonzero(numbers[which] < TIMES) + start).tolist()
        else:
            cuts = sorted(p for w in doubtful if 0 < counts[w] < TIMES for p in places(w, start, stop))
        if not cuts:
            kept.append((start, stop))
            continue
        pieces = _between(cuts, start, stop)
        large = max(pieces, key=lambda x: x[1] - x[0], default=(stop, stop))
        inherits = 2 * (large[1] - large[0]) >= stop - start
        todo += [(*piece, None, None) for piece in pieces if piece is not large or not inherits]
        if inherits:
            counts = Counter(dict(zip(values.tolist(), numbers.tolist(), strict=True))) if counts is None else counts
            gone = Counter(words[start : large[0]].tolist())
            gone.update(words[large[1] : stop].tolist())
            counts.subtract(gone)
            todo.append((*large, counts, gone.keys()))
    return sorted(kept)


def recurring(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a segment whose windows of GRAM words all occur elsewhere in it too."""
    n = len(words) - GRAM + 1
    key = np.zeros(n, np.uint64)
    for k in range(GRAM):
        key = key * _BASE + _hashes(words[k : k + n])
    _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (counts[which] > 1).astype(np.int8), [0]])))
    return [(int(a), int(b) + GRAM - 1) for a, b in edges.reshape(-1, 2) if b - a + GRAM - 1 >= SHORTEST]


def _hashes(words: np.ndarray) -> np.ndarray:
    x = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many first words two stretches share."""
    at, step, n = 0, 64, min(len(x), len(y))
    while at < n:
        differ = np.flatnonzero(x[at : min(n, at + step)] != y[at : min(n, at + step)])
        if differ.size:
            return at + int(differ[0])
        at, step = at + step, 2 * step
    return n


def _prime_factors(q: int) -> list[int]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return [*out, q] if q > 1 else out


def scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Every run (start, length, period) of a segment, by lags from the smallest."""
    n = len(words)
    powers = np.cumprod(np.full(n + 1, _BASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_hashes(words) * powers[:n])])
    found: list[tuple[int, int, int]] = []
    for q in range(1, n // TIMES + 1):
        blocks = np.diff(sums[::q])
        at = np.flatnonzero(blocks[:-1] * powers[q - 1] == blocks[1:]) * q
        if not at.size:
            continue
        for start, length, period in found:  # inside a run whose period divides q there is only that run
            if q % period == 0 and length >= 2 * q:
                at = at[(at < start) | (at + 2 * q > start + length)]
        while at.size:
            here = int(at[0])
            start = here - _agree(words[:here][::-1], words[: here + q][::-1])
            stop = here + q + _agree(words[here:], words[here + q :])
            at = at[at + 2 * q > max(stop, here + 2 * q)]
            run = words[start:stop]
            if len(run) >= max(SHORTEST, TIMES * q) and not any(
                np.array_equal(run[q // r :], run[: -(q // r)]) for r in _prime_factors(q)
            ):
                found.append((start, stop - start, q))
    return found


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """Every run (start, length, period) of a text's words, by start and period."""
    counts = Counter(words)  # the first split, on the words themselves: most texts end here
    out = []
    for start, stop in _between([i for i, w in enumerate(words) if counts[w] < TIMES], 0, len(words)):
        names: dict[bytes, int] = {}
        ids = np.fromiter((names.setdefault(w, len(names)) for w in words[start:stop]), np.int64, stop - start)
        for a, b in surviving(ids):
            for c, d in recurring(ids[a:b]):
                at = start + a + c
                out += [(at + begin, length, q) for begin, length, q in scan(ids[a + c : a + d])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_A_BATCH):
            part = batch.slice(at, _ROWS_A_BATCH)
            sizes, runs, rests = [], [], []
            for text in part.column("text"):
                words = (text.as_py() or b"").split()  # bytes.split() parts at exactly these six characters
                found = runs_of(words)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                rests.append(_collapsed(words, found))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(rests, pa.binary())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def find(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_words, runs array<struct<start, length, period>>, collapsed string)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    out = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_find, schema)
    return out.withColumn("collapsed", F.decode("collapsed", "UTF-8"))


def strongest(runs: Column) -> Column:
    """The run with most periods, compared exactly; ties go to the smallest start, then period. Null without runs."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.aggregate(F.slice(runs, F.lit(2), F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda a, b: F.when(more(b, a), b).otherwise(a))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts in which one document in ten goes on periodically from some word, as its ``doc_id`` decides.

    With n words, h the CRC of the decimal id and g = h div 10: where h ends in 0 and n > 0, word i >= a = g mod n
    becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Other texts stay as they are; a null id plants nothing.
    """
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("g", F.when(h % 10 == 0, g))
    marked = marked.withColumn("n", F.when(F.col("g").isNotNull(), n)).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    marked = marked.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, tail = F.col("a").cast("int"), (F.col("n") - F.col("a")).cast("int")
    period = F.array_repeat(F.slice(words, a + 1, F.col("p")), F.ceil(tail / F.col("p")).cast("int"))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(period), F.lit(1), tail)), " ")
    return marked.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """What ``find`` gives, as counts, the strongest run and digests."""
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
