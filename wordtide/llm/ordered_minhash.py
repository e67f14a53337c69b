"""MinHash near-dedup by Order MinHash with banded alignment.

Texts are lower-cased words. Every run of ``K`` words, labelled with its occurrence number in the
text, is hashed; each of ``TABLES`` tables takes the ``PICK`` labelled runs with the smallest hashes
and keeps them in text order. Every two of them, in that order, are a bucket key, so a bucket tells
which runs two texts share and in which order. In texts of up to ``SHORT`` words a few edits touch
every long run, so these have ``SHORT_TABLES`` more tables of runs of ``SHORT_K`` words.

Comparisons inside buckets, of rows that are not in one component yet:

1. Each text is compared with the smallest id of the bucket key that it shares most often with one
   (its hub), which links nearly all of a large group.
2. In buckets of up to ``BLOCK`` rows that still hold several components, every two rows of
   different components are compared, by word counts in place.
3. In larger ones each text is compared with the shortest text of the bucket: texts that consist
   mostly of a passage they share are often all similar to it. Those that have at least ``CORE`` of
   their runs in common with that text, a family, may be similar by the shared runs alone although
   that text is none of theirs (it may have other words before the passage). For up to ``ROUNDS`` rounds
   one member of each family is compared with all that are in other components; then every two
   members that are still apart are compared by word counts, dealt by length and salt into pairs of
   blocks, whatever the family's size. No member is left out.
4. Each text of a larger bucket is sketched again without the runs it shares with the shortest text,
   by ``REST_TABLES`` tables of one run of ``REST_K`` words (edits touch fewer of the shorter runs, so half as many
   keys find as many pairs as 24 of ``K`` words), which gives finer buckets inside the old one; these are
   treated in the same way, until no large bucket holds several components; finer buckets of members
   of the family only have been compared already and go. The shortest text of a finer bucket has the
   runs of all buckets around it, so no run is used twice and the rounds end.

Two similar texts of a large bucket that are no family thus have more than ``1 - CORE`` of one text's runs
outside of the shared passage, and meet by these.

A comparison first bounds the edit distance from below by word counts (``BAG`` counters a text, later
exact counts of words and runs of two and three, safe: nothing similar is lost) and then aligns the word sequences in a band around the diagonal. Texts are
linked if ``1 - distance / longer length`` is at least ``SIMILARITY``; classes are the components.

Exact copies are one row from the start: texts are grouped by hash with partial aggregation, and the
classes of their representatives are joined back.

Defined results: null counts as the empty text; all texts without words are one class; texts of
fewer than ``K`` words have one run; ids are the identity of a document, so rows of one id are linked
whatever their texts; rows without an id have no class and are kept; an empty table gives an empty
result; other columns stay in ``dedup`` and are not read elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import EACH, FEW, components, forget, long_ids, materialise, text_id

K = 5
PICK = 4
TABLES = 20
SHORT, SHORT_K, SHORT_TABLES = 64, 2, 8
REST_K, REST_TABLES = 3, 12
SIMILARITY = 0.8
BAG = 128
BLOCK = 128
CORE, ROUNDS, FAMILY_BLOCK, FAMILY_WORDS = 0.3, 3, 1024, 400_000
#: Pairs that one task aligns where there are few; texts that are looked up first, and sent to the executors if they have so many
#: characters at most.
ALIGNED, LOOKED_UP, HELD = 250, 4_000, 8_000_000
#: Alignments of longer texts go by furthest positions instead of bits: their tables of places would grow.
COLUMN_WORDS = 4096
STEP = 1 << 13

_U = np.uint64
_ODD = np.random.default_rng(7).integers(0, 1 << 31, max(TABLES, REST_TABLES), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = np.random.default_rng(8).integers(0, 1 << 32, max(TABLES, REST_TABLES), dtype=np.uint32)
_POLY = np.random.default_rng(9).integers(1, 1 << 63, K, dtype=np.uint64) * _U(2) + _U(1)

#: Places of the pairs of up to PICK picks.
_PAIRS = {m: np.triu_indices(m, 1) for m in range(2, PICK + 1)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))


def word_hashes(words: list[str], block: int = 100_000) -> np.ndarray:
    """64-bit hashes of words (without spaces): polynomials over their bytes, summed word by word in
    one pass over the joined text, in blocks of bounded memory."""
    if len(words) > block:
        return np.concatenate([word_hashes(words[lo : lo + block]) for lo in range(0, len(words), block)])
    if not words:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    place = np.arange(len(data)) - np.repeat(starts, np.append(np.diff(starts), len(data) - starts[-1]))
    terms = (data.astype(np.uint64) + _U(1)) * (_POWERS[place & 0xFFFF] + (place >> 16).astype(np.uint64))
    terms[ends[:-1]] = 0  # the spaces
    return _mix(_mix(np.add.reduceat(terms, starts)) + (ends - starts).astype(np.uint64))


def words_of(text: str) -> np.ndarray:
    """Hashes of the lower-case words of a text."""
    return word_hashes(text.lower().split())


def labelled_runs(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the runs of ``k`` words in text order, each labelled with its occurrence number."""
    if len(words) < k:
        return _mix(np.sum(words * _POLY[: len(words)], dtype=np.uint64, keepdims=True) + _U(len(words) + 1))
    n = len(words) - k + 1
    runs = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        runs += words[j : j + n] * _POLY[j]
    runs = _mix(runs)
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    new = np.empty(n, dtype=bool)
    new[0] = True
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(n)
    nth = np.empty(n, dtype=np.uint64)
    nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return _mix(runs + nth * _U(0xD6E8FEB86659FD93))


def least(labels: np.ndarray, tables: int, pick: int) -> np.ndarray:
    """Places of the ``pick`` labels of least rank in each table, in text order."""
    short = (labels >> _U(32)).astype(np.uint32)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    row = np.arange(tables)
    for lo in range(0, len(labels), STEP):  # texts of any length in bounded memory
        ranks = short[lo : lo + STEP][None, :] * _ODD[:tables, None] + _ADD[:tables, None]
        ranks ^= ranks >> np.uint32(15)
        ranks *= np.uint32(0x85EBCA6B)
        ranks ^= ranks >> np.uint32(13)
        for _ in range(min(pick, ranks.shape[1])):
            at = ranks.argmin(axis=1)
            found.append((ranks[row, at], at + lo))
            ranks[row, at] = 0xFFFFFFFF
    ranks, at = (np.stack(x, axis=1) for x in zip(*found, strict=True))
    keep = np.argsort(ranks, axis=1, kind="stable")[:, :pick]
    return np.sort(np.take_along_axis(at, keep, axis=1), axis=1)


def _keys(labels: np.ndarray, tables: int) -> np.ndarray:
    """Bucket keys: every two picked runs of a table in text order, or the only run."""
    at = least(labels, tables, PICK)
    table = np.arange(tables, dtype=np.uint64)[:, None]
    if at.shape[1] == 1:
        return _mix(labels[at] + table).ravel()
    first, second = _PAIRS[at.shape[1]]
    return _mix(_mix(labels[at[:, first]] * _U(0x9E3779B97F4A7C15) + labels[at[:, second]]) + table).ravel()


def sketch(words: np.ndarray) -> np.ndarray:
    """The distinct bucket keys of a text."""
    keys = _keys(labelled_runs(words), TABLES)
    if len(words) <= SHORT:
        keys = np.append(keys, _keys(labelled_runs(words, SHORT_K), SHORT_TABLES))
    return np.unique(keys).view(np.int64)


def rest_keys(labels: np.ndarray, hub: np.ndarray, seed: int) -> np.ndarray:
    """Keys of a text by single runs that the hub's text lacks."""
    left = labels[~np.isin(labels, hub)]
    if not len(left):
        return np.zeros(0, dtype=np.int64)
    at = least(left, REST_TABLES, 1)[:, 0]
    own = _mix(np.array([seed], dtype=np.int64).view(np.uint64) + _U(1))
    return np.unique(_mix(_mix(left[at] + own) + np.arange(REST_TABLES, dtype=np.uint64))).view(np.int64)


def bag(words: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((words % _U(BAG)).astype(np.int64), minlength=BAG), 65535).astype(np.uint16)


def within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of two sequences if it is at most ``most``, by banded alignment."""
    if abs(len(a) - len(b)) > most:
        return None
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return n + m if n + m <= most else None
    return _columns(a, b, most) if max(n, m) <= COLUMN_WORDS else _furthest(a, b, most)


def _columns(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The distance column by column of the shorter text, the cells of the band as bits of one number.

    Only diagonals that a path of ``most`` edits can touch are in the band. ``up`` and ``down`` say where a cell is one more or one
    less than the cell above it. The band moves down by one row a column; the cells that come and go at its edges are taken as one
    more than their neighbour, which is the cost of a real path, and so are the rows above the text. ``d`` is the distance on the
    diagonal that ends in the last cell, which never falls, so the first excess decides.
    """
    long, short = (a.tolist(), b.tolist()) if len(a) >= len(b) else (b.tolist(), a.tolist())
    d = len(long) - len(short)
    below = (most - d) // 2
    width = d + 2 * below + 1
    places: dict[int, int] = {}
    for i, w in enumerate(long, below + 1):
        places[w] = places.get(w, 0) | (1 << i)
    full, last, goal = (1 << width) - 1, 1 << (width - 1), 1 << (below + d)
    down = (1 << (below + 1)) - 1
    up = full ^ down
    for j, w in enumerate(short, 1):
        up, down = (up >> 1) | last, down >> 1
        equal = (places.get(w, 0) >> j) & full
        flat = (((equal & up) + up) ^ up) | equal
        right, left = down | (full & ~(flat | up)), up & flat
        d += bool(up & goal) - bool(down & goal) + bool(right & goal) - bool(left & goal)
        if d > most:
            return None
        right, left, steep = (right << 1) | 1, left << 1, equal | down
        up, down = (left | ~(steep | right)) & full, right & steep & full
    return d


def _run(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    """How many places from (x, y) on are equal."""
    start = x
    while True:
        k = min(len(a) - x, len(b) - y, 64)
        same = a[x : x + k] == b[y : y + k]
        if not len(same):
            return x - start
        stop = int(same.argmin())
        if not same[stop]:
            return x - start + stop
        x, y = x + len(same), y + len(same)


def _furthest(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The distance by furthest-reaching positions on the diagonals of the band, for 0, 1, 2 ...
    edits: position x on diagonal d stands for a[:x] against b[: x - d]."""
    n, m = len(a), len(b)
    ids = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    a, b = np.append(ids[:n], -1), np.append(ids[n:], -2)
    mid = most + 1
    reach = np.full(2 * most + 3, -2 * (n + m + 1))
    reach[mid] = _run(a, b, 0, 0)
    goal = mid + n - m
    for e in range(0, most + 1):
        if e:
            lo, hi = mid - e, mid + e + 1
            d = np.arange(-e, e + 1)
            x = np.maximum(np.maximum(reach[lo - 1 : hi - 1], reach[lo:hi]) + 1, reach[lo + 1 : hi + 1])
            x = np.minimum(x, np.minimum(n, m + d))
            good = (x >= np.maximum(d, 0)) & (d >= -m)
            on = np.flatnonzero(good)
            for _ in range(4):
                on = on[a[x[on]] == b[x[on] - d[on]]]
                if not len(on):
                    break
                x[on] += 1
            while len(on) > 12:
                on = on[a[x[on]] == b[x[on] - d[on]]]
                x[on] += 1
            for k in on.tolist():
                x[k] += _run(a, b, int(x[k]), int(x[k] - d[k]))
            reach[lo:hi] = np.where(good, x, -2 * (n + m + 1))
        if reach[goal] >= n:
            return e
    return None


def most_edits(n: int, m: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * max(n, m) + 1e-9)


def runs_of(words: np.ndarray) -> list[np.ndarray]:
    """The labelled runs of one, two and three words, sorted."""
    return [np.sort(labelled_runs(words, q)) for q in (1, 2, 3) if len(words) >= q]


def least_edits(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """A lower bound of the edit distance of two texts, of their ``runs_of``: an edit changes at most q runs of q words."""
    most = 0.0
    for q, (x, y) in enumerate(zip(a, b, strict=False), 1):
        both = np.concatenate([x, y])
        both.sort(kind="stable")  # merges the two
        most = max(most, (max(len(x), len(y)) - int((both[1:] == both[:-1]).sum())) / q)
    return most


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY, runs: tuple | None = None) -> bool:
    """Whether two texts are similar; ``runs`` are their ``runs_of`` where these are known."""
    most = most_edits(len(a), len(b), similarity)
    if abs(len(a) - len(b)) > most:
        return False
    x, y = runs or (runs_of(a), runs_of(b))
    return least_edits(x, y) <= most and within(a, b, most) is not None


def _sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        n, keys, bags = [], [], []
        for text in pdf.pop("text"):
            words = words_of(text)
            n.append(len(words))
            keys.append(sketch(words))
            bags.append(bag(words).tobytes())
        yield pdf.assign(n=n, keys=keys, bag=bags)


def _bag_filter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            x = np.frombuffer(b"".join(pdf["bag_a"]), dtype=np.uint16).reshape(-1, BAG).astype(np.int64)
            y = np.frombuffer(b"".join(pdf["bag_b"]), dtype=np.uint16).reshape(-1, BAG).astype(np.int64)
            more, less = np.maximum(x - y, 0).sum(1), np.maximum(y - x, 0).sum(1)
            longest = np.maximum(pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy())
            pdf = pdf[np.maximum(more, less) <= (1 - SIMILARITY) * longest + 1e-9]
        yield pdf[["a", "b"]]


def _close_in(group: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The pairs (a, b) of a bucket, of different components (and blocks, if there are several), that word counts allow."""
    order = np.argsort(group["n"], kind="stable")
    n, c, rep = (group[x][order] for x in ("n", "c", "rep"))
    blocks = group["block"][order] if len(np.unique(group["block"])) > 1 else None
    bags = np.frombuffer(b"".join(group["bag"][order]), dtype=np.uint16).reshape(-1, BAG).astype(np.int32)
    coarse = bags.reshape(-1, BAG // 8, 8).sum(2, dtype=np.int32)
    upto = np.searchsorted(n, n / SIMILARITY + 1e-6, side="right")
    out = []
    for lo in range(0, len(n), 256):
        hi = min(lo + 256, len(n))
        end = int(upto[hi - 1])
        x, y = np.arange(lo, hi)[:, None], np.arange(lo, end)[None, :]
        left, right = np.nonzero((y > x) & (y < upto[lo:hi, None]) & (c[lo:hi, None] != c[None, lo:end]))
        if blocks is not None:  # blocks are met among themselves elsewhere
            other = blocks[left + lo] != blocks[right]
            left, right = left[other], right[other]
        if len(left) > 1 << 14:  # sums of counters bound the distance as well, at an eighth of the work
            good = np.empty(len(left), dtype=bool)
            for at in range(0, len(left), 1 << 16):  # a part at a time, whose counters take few MB
                x, y = left[at : at + (1 << 16)] + lo, right[at : at + (1 << 16)]
                apart = coarse[x] - coarse[y]
                worst = np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1))
                good[at : at + (1 << 16)] = worst <= (1 - SIMILARITY) * n[y] + 1e-9
            left, right = left[good], right[good]
        for at in range(0, len(left), 1 << 14):
            x, y = left[at : at + (1 << 14)] + lo, right[at : at + (1 << 14)] + lo
            apart = bags[x] - bags[y]
            worst = np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1))
            good = worst <= (1 - SIMILARITY) * n[y] + 1e-9
            x, y = rep[x[good]], rep[y[good]]
            out.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
    return out


def _close_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket -> close pairs, bucket by bucket; a bucket is one block or a pair of blocks."""
    kept: pd.DataFrame | None = None

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["key"].to_numpy()
        starts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
        columns = {x: pdf[x].to_numpy() for x in ("n", "c", "rep", "bag", "block")}
        found = [np.zeros((0, 2), dtype=np.int64)]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if hi - lo > 1:
                found += _close_in({x: v[lo:hi] for x, v in columns.items()})
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    for pdf in batches:
        if not len(pdf):
            continue
        pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        last = (pdf["key"] == pdf["key"].iloc[-1]).to_numpy()
        kept = pdf[last]
        if not last.all():
            yield pairs(pdf[~last])
    if kept is not None:
        yield pairs(kept)


def _linked_in(group: dict[str, np.ndarray]) -> list[tuple[int, int]]:
    """Links of a bucket that join its components: close pairs are aligned in place, and only while their ends are still apart,
    so there are fewer links than rows."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = parent.get(up, up)
            c = up
        return c

    texts, at = dict(zip(group["rep"].tolist(), group["text"], strict=True)), dict(zip(group["rep"].tolist(), group["c"].tolist(), strict=True))
    known: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
    out = []
    for pairs in _close_in(group):
        for a, b in pairs.tolist():
            x, y = root(at[a]), root(at[b])
            if x != y:
                for rep in (a, b):
                    if rep not in known:
                        words = words_of(texts[rep])
                        known[rep] = words, runs_of(words)
                if similar(known[a][0], known[b][0], runs=(known[a][1], known[b][1])):
                    parent[max(x, y)] = min(x, y)
                    out.append((a, b))
    return out


def _linked_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket, with texts -> the links that join components, bucket by bucket."""
    for bucket in _buckets(batches):
        links = _linked_in({x: bucket[x].to_numpy() for x in ("n", "c", "rep", "bag", "block", "text")}) if len(bucket) > 1 else []
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one bucket after the other, of batches that are sorted by bucket."""
    kept: pd.DataFrame | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        keys = pdf["key"].to_numpy()
        starts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            yield pdf.iloc[lo:hi]
        kept = pdf.iloc[starts[-1] :]
    if kept is not None:
        yield kept


def _rest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last: tuple = (None, None, None)
    for pdf in batches:
        keys, core = [], []
        for seed, hub, text, hub_text in zip(pdf["seed"], pdf["hub"], pdf["text"], pdf["hub_text"], strict=True):
            if last[0] != hub:
                words = words_of(hub_text)
                last = (hub, labelled_runs(words), labelled_runs(words, REST_K))
            words = words_of(text)
            keys.append(rest_keys(labelled_runs(words, REST_K), last[2], int(seed)))
            core.append(bool(np.isin(labelled_runs(words), last[1]).mean() >= CORE))
        yield pdf[["seed", "hub", "rep", "n"]].assign(core=core, keys=keys)


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last: tuple = (None, None, None)
    for pdf in batches:
        keep = []
        for a, text_a, text_b in zip(pdf["a"], pdf["text_a"], pdf["text_b"], strict=True):
            if last[0] != a:
                words = words_of(text_a)
                last = (a, words, runs_of(words))
            words = words_of(text_b)
            keep.append(similar(last[1], words, runs=(last[2], runs_of(words))))
        yield pdf.loc[keep, ["a", "b"]] if len(pdf) else pdf[["a", "b"]]


def _bucketed(keyed: DataFrame) -> DataFrame:
    """Rows (key, rep, n) of buckets of two or more, with their size ``m`` and smallest id ``low``. Where rows say whether they
    are members of the family of the bucket around, buckets of members only go: those have all been compared."""
    core = F.min("core") if "core" in keyed.columns else F.lit(False)
    several = keyed.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("low"), core.alias("known")).where("m > 1 and not known")
    return materialise(keyed.select("key", "rep", "n").join(several.drop("known"), "key"), "omh-buckets")


def _done(out: DataFrame, *tables: DataFrame) -> DataFrame:
    """``out``, a written table, after the scratch tables that only it needed are deleted."""
    for table in tables:
        forget(table)
    return out


def _ends(pairs: DataFrame, name: str, n: int) -> DataFrame:
    """The ids in ``n`` pairs, written."""
    return materialise(pairs.select(F.col("a").alias(name)).union(pairs.select("b")).distinct(), "omh-ids", 2 * n // EACH + 1)


def _sent(table: DataFrame) -> DataFrame:
    """A written table of ids, sent to the executors if it is counted to have at most ``FEW`` rows: this spares the shuffle of the
    large side of a join, whatever size Spark takes the table for."""
    return _few(table, table.count())


def _few(table: DataFrame, n: int) -> DataFrame:
    return F.broadcast(table) if n <= FEW else table


def _of(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows ``(rep, n, bag)`` of written ids, sent to the executors where they are few (a few MB)."""
    n = ids.count()
    table = table.join(_few(ids, n), "rep", "left_semi")
    return F.broadcast(table) if n <= EACH else table


def _checked(close: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of a written table whose texts are similar, by alignment.

    Few texts are looked up first, by all tasks that read texts, and sent to those that align: one or two tasks of few pairs would
    otherwise go through every partition of the joins, which takes longer than the alignment.
    """
    if not (n := close.count()):
        return close
    ids, parts = _ends(close, "doc_id", n), n // ALIGNED + 1
    m = ids.count()
    texts = texts.join(_few(ids, m), "doc_id", "left_semi")
    held = None
    if m <= LOOKED_UP:
        texts = held = materialise(texts, "omh-held")
    if held is not None and (held.agg(F.sum(F.length("text"))).first()[0] or 0) <= HELD:
        both = close.repartition(parts).sortWithinPartitions("a")
        both = both.join(F.broadcast(texts.toDF("b", "text_b")), "b").join(F.broadcast(texts.toDF("a", "text_a")), "a")
        parts = None
    else:
        both = texts.toDF("b", "text_b").join(_few(close, n), "b").join(texts.toDF("a", "text_a"), "a")
    links = both.select("a", "b", "text_a", "text_b").mapInPandas(_verify, "a bigint, b bigint")
    return _done(materialise(links, "omh-links", parts), held, ids, close)


def _linked(pairs: DataFrame, slim: DataFrame, texts: DataFrame, most: int | None = None) -> DataFrame:
    """The pairs whose texts are similar, by word counts first and then by alignment; ``most`` is a number that the pairs do not
    exceed, where it is known."""
    pairs = materialise(pairs, "omh-pairs", None if most is None else most // EACH + 1)
    if not (n := pairs.count()):
        return pairs
    ids = _ends(pairs, "rep", n)
    slim = _of(slim, ids)
    close = (
        _few(pairs, n).join(slim.toDF("a", "n_a", "bag_a"), "a")
        .join(slim.toDF("b", "n_b", "bag_b"), "b")
        .mapInPandas(_bag_filter, "a bigint, b bigint")
    )
    return _checked(_done(materialise(close, "omh-close", n // EACH + 6), pairs, ids), texts)


def _lifted(edges: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """``n`` edges between the components of their ends; every end has a label."""
    for end in ("a", "b"):
        edges = _few(edges, n).join(labels.toDF(end, f"{end}_c"), end).drop(end).withColumnRenamed(f"{end}_c", end)
    return edges


def _joined(own: DataFrame, links: DataFrame) -> DataFrame:
    """``own(rep, c)`` with the components that ``links``, a written table of pairs of ids, join."""
    if not (n := links.count()):
        return own
    more = components(_lifted(links, own, n), most=n).toDF("c", "joined")
    return materialise(own.join(_few(more, 2 * n), "c", "left").select("rep", F.coalesce("joined", "c").alias("c")), "omh-own")


def _split(rows: DataFrame, own: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with theirs."""
    rows = materialise(rows.drop("low").join(own, "rep"), "omh-own-rows")
    several = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    return _done(materialise(rows.join(several.select("key"), "key", "left_semi"), "omh-open"), rows)


def _small(rows: DataFrame, slim: DataFrame, texts: DataFrame) -> DataFrame:
    """The similar pairs of different components in buckets of up to ``BLOCK`` rows."""
    ids = materialise(rows.select("rep").distinct(), "omh-ids", rows.count() // EACH + 1)
    rows = rows.select("key", "rep", "c", F.lit(0).alias("block")).join(_of(slim, ids), "rep").repartition("key").sortWithinPartitions("key")
    close = materialise(rows.mapInPandas(_close_blocks, "a bigint, b bigint"), "omh-close")
    return _checked(_done(materialise(close.distinct(), "omh-close", close.count() // EACH + 1), close, ids), texts)


def _rests(rows: DataFrame, texts: DataFrame, inside: str, most: int) -> DataFrame:
    """Rows (seed, hub, rep, n, core, keys): what the texts of large buckets have and the hubs lack, as keys apart for each value of
    the column ``inside``, and whether the shared part makes them members of the hub's family. Hubs of many texts are dealt to
    tasks in parts of about ``BLOCK``. ``most`` is the number of rows."""
    pairs = rows.where("rep <> hub").select(F.col(inside).alias("seed"), "hub", "rep", "n").distinct()
    pairs = materialise(pairs, "omh-large", most // EACH + 1)
    parts = _few(pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), most // BLOCK)
    hubs = texts.toDF("hub", "hub_text").join(parts, "hub").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    dealt = pairs.join(parts, "hub").withColumn("part", F.expr("cast(pmod(xxhash64(rep), parts) as int)"))
    dealt = texts.toDF("rep", "text").join(_few(dealt, most), "rep").join(hubs.drop("parts"), ["hub", "part"])
    dealt = dealt.select("seed", "hub", "rep", "n", "text", "hub_text")
    return _done(materialise(dealt.mapInPandas(_rest_rows, "seed bigint, hub bigint, rep bigint, n int, core boolean, keys array<bigint>"), "omh-rests"), pairs)


def _several(family: DataFrame, own: DataFrame) -> DataFrame:
    """The rows of families that hold several components, with theirs."""
    rows = materialise(family.join(own, "rep"), "omh-family")
    mixed = rows.groupBy("hub").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    return _done(materialise(rows.join(mixed.select("hub"), "hub", "left_semi"), "omh-families"), rows)


def _in_blocks(rows: DataFrame, slim: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    """The similar pairs of different components in families of any size.

    Similar texts are in one class of lengths or in neighbouring ones. A class is salted into blocks of about ``FAMILY_BLOCK``
    rows, fewer of long texts; every block meets itself, the others of its class and those of the next one, each pair of blocks as
    one bucket. A bucket aligns its close pairs in place, while their components are still apart. There are at most ``most`` rows.
    """
    ratio = -np.log(SIMILARITY)
    rows = rows.withColumn("length", F.floor(F.log(F.greatest("n", F.lit(1))) / ratio).cast("int"))
    sizes = rows.groupBy("hub", "length").agg(F.ceil(F.greatest(F.count("*") / FAMILY_BLOCK, F.sum("n") / FAMILY_WORDS)).cast("int").alias("blocks"))
    written = sizes = materialise(sizes.withColumn("blocks", F.greatest("blocks", F.lit(1))), "omh-lengths", most // EACH + 1)
    ahead = _few(sizes.select("hub", (F.col("length") - 1).alias("length"), F.col("blocks").alias("ahead")), most)
    behind = _few(sizes.select("hub", (F.col("length") + 1).alias("length"), F.col("blocks").alias("behind")), most)
    sizes = sizes.join(ahead, ["hub", "length"], "left").join(behind, ["hub", "length"], "left").na.fill(0)
    own = F.expr("cast(pmod(xxhash64(rep), blocks) as int)")
    dealt = rows.join(_few(sizes, most), ["hub", "length"]).withColumn("own", own).withColumn("block", F.col("length") * (1 << 20) + own)
    units = F.expr(
        "concat(transform(sequence(0, blocks - 1), i -> named_struct('x', length, 'i', least(i, own), 'y', length, 'j', greatest(i, own))),"
        " transform(filter(sequence(0, ahead), i -> i < ahead), i -> named_struct('x', length, 'i', own, 'y', length + 1, 'j', i)),"
        " transform(filter(sequence(0, behind), i -> i < behind), i -> named_struct('x', length - 1, 'i', i, 'y', length, 'j', own)))"
    )
    met = dealt.select("hub", "rep", "c", "block", F.explode(units).alias("u")).select(F.xxhash64("hub", "u").alias("key"), "rep", "c", "block")
    wanted = materialise(rows.select("rep").distinct(), "omh-ids", most // EACH + 1)
    held = texts.toDF("rep", "text").join(_sent(wanted), "rep", "left_semi").join(_of(slim, wanted), "rep")
    # few bytes, much work: a number given keeps Spark from putting the buckets together by bytes
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.join(held, "rep").repartition(parts, "key").sortWithinPartitions("key")
    links = materialise(met.mapInPandas(_linked_blocks, "a bigint, b bigint"), "omh-links")
    return _done(links, wanted, written)


def _families(rests: DataFrame, large: DataFrame, own: DataFrame, slim: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    """``own`` after the members of every family have been compared: some rounds with one member each, then what is still apart.
    ``large`` has the ``most`` rows of the buckets with their hubs; each bucket has more than ``BLOCK``, which bounds the hubs."""
    hubs = large.select("hub", F.col("hub").alias("rep"), F.col("hub_n").alias("n"))
    family = materialise(rests.where("core").select("hub", "rep", "n").union(hubs).distinct(), "omh-core", most // EACH + 1)
    for turn in range(ROUNDS):
        rows = _several(family, own)
        if rows.isEmpty():
            return _done(own, family, rows)
        # a component is drawn by hash, so a large group of open rows is likely to be hit; its shortest text speaks for it
        home = _few(rows.where("rep = hub").select("hub", F.col("c").alias("home")), most // BLOCK)
        drawn = rows.join(home, "hub").where("c <> home").groupBy("hub", "c").agg(F.min(F.struct("n", "rep"))["rep"].alias("pivot"))
        drawn = drawn.groupBy("hub").agg(F.min_by(F.struct("pivot", F.col("c").alias("pivot_c")), F.xxhash64("c", F.lit(turn))).alias("p")).select("hub", "p.*")
        apart = rows.join(_few(drawn, most // BLOCK), "hub").where("c <> pivot_c")
        pairs = apart.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
        links = _linked(pairs, slim, texts, 2 * most)
        if links.isEmpty():  # no large open group is left, or none was hit: the blocks decide
            break
        own = _done(_joined(own, links), rows)
    rows = _several(family, own)
    if not rows.isEmpty():
        own = _joined(own, _in_blocks(rows, slim, texts, 2 * most))
    return _done(own, family, rows)


def _finer(rests: DataFrame, own: DataFrame) -> DataFrame:
    """Rows (key, rep, n, core) of finer buckets, of those buckets that still hold several components and not members of the
    family only, which have all been compared."""
    n = rests.count()
    rows = own.join(_few(rests.select("seed", "rep", "core"), n), "rep")
    left = rows.groupBy("seed").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("core").alias("known")).where("low < high and not known")
    rows = rests.join(_few(left.select("seed"), n), "seed", "left_semi")
    # the array of a row becomes many rows: a number given keeps Spark from putting rows together by bytes
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rep", "seed")
    return materialise(rows.select(F.explode("keys").alias("key"), "rep", "n", "core").distinct(), "omh-fine", n * REST_TABLES // EACH + 1)


def _with_hubs(rows: DataFrame, own: DataFrame, slim: DataFrame, texts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The ``most`` rows of large buckets with their shortest text as ``hub``, and ``own`` after comparison with it."""
    hubs = rows.groupBy("key").agg(F.min(F.struct("n", "rep", "c")).alias("s"))
    hubs = hubs.select("key", F.col("s.rep").alias("hub"), F.col("s.n").alias("hub_n"), F.col("s.c").alias("hub_c"))
    rows = materialise(rows.join(_few(hubs, most // BLOCK), "key"), "omh-hubs")
    pairs = rows.where("c <> hub_c").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    return rows, _joined(own, _linked(pairs, slim, texts, most))


def groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``docs(doc_id, text)``: (copies(doc_id, h), classes of texts (h, class_id))."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("h"), text.alias("text"))
    sketched = rows.withColumn("doc_id", text_id("doc_id")).mapInPandas(_sketch_rows, "doc_id string, h string, n int, keys array<bigint>, bag binary")
    sketched = materialise(long_ids(sketched, "doc_id"), "omh-sketch")
    picked = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n", "keys", "bag"))).alias("r")
    reps = materialise(
        sketched.groupBy("h").agg(picked).where("r is not null").select("h", F.col("r.doc_id").alias("rep"), "r.n", "r.keys", "r.bag"), "omh-reps"
    )
    copies = materialise(sketched.select("doc_id", "h"), "omh-copies")
    forget(sketched)
    buckets = _bucketed(reps.select(F.explode("keys").alias("key"), "rep", "n"))
    reps = _done(materialise(reps.drop("keys"), "omh-reps"), reps)
    slim = reps.select("rep", "n", "bag")
    wanted = materialise(buckets.select(F.col("rep").alias("doc_id")).distinct(), "omh-wanted")
    texts = materialise(rows.select("doc_id", "text").join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "omh-texts")
    forget(wanted)

    met = buckets.where("rep <> low").groupBy("rep", "low").agg(F.count("*").alias("k"))
    nearest = met.groupBy(F.col("rep").alias("b")).agg(F.max_by("low", F.struct("k", "low")).alias("a")).select("a", "b")
    links = _linked(nearest, slim, texts)
    n = links.count()
    labels = components(links, most=n)
    own = reps.select("rep").distinct().join(_few(labels.toDF("rep", "c"), 2 * n), "rep", "left")
    own = materialise(own.select("rep", F.coalesce("c", "rep").alias("c")), "omh-own")
    inside = "hub"
    while True:
        mixed = _done(_split(buckets, own), buckets)
        own = _joined(own, _small(mixed.where(F.col("m") <= BLOCK), slim, texts))
        large = mixed.where(F.col("m") > BLOCK)
        if not (most := large.count()):
            break
        large, own = _with_hubs(large, own, slim, texts, most)
        rests = _rests(large, texts, inside, most)
        own = _families(rests, large, own, slim, texts, most)
        fine = _done(_finer(rests, own), rests)
        buckets = _done(_bucketed(fine), fine, large, mixed)
        inside = "key"
    by_text = reps.select("h", "rep").join(own, "rep").select("h", F.col("c").alias("class_id"))
    return copies, _done(materialise(by_text, "omh-classes"), reps, texts, own)


def classes(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, class_id, kept, one row per row of ``docs``; class_id is the
    smallest id of the class and kept says whether that is this id."""
    copies, by_text = groups(docs)
    return copies.join(by_text, "h", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id; all columns stay."""
    kept = classes(docs.select("doc_id", "text")).where("kept and doc_id is not null").select(F.col("doc_id").alias("omh_id")).distinct()
    kept = materialise(kept, "omh-kept")
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    named = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("omh_id"), "left_semi").withColumn("omh_nth", F.row_number().over(one))
    return named.where("omh_nth = 1").drop("omh_nth").unionByName(docs.where("doc_id is null"))
