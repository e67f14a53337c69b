"""Quality by a linear-chain conditional random field over lines.

Every line has features of its characters and words, and those of the lines before and after it; a
chain with two states (bad, good) scores them with weights and a transition matrix. Labels are known
for documents only, so fitting (on at most ``FIT_DOCS`` labelled documents) starts from lines that
all bear their document's label and alternates: fit the chain by gradient ascent on the conditional
likelihood, then relabel the lines of bad documents by their marginals (at least the worst line
stays bad; lines of good documents stay good). Forward-backward marginals, weighted by line length,
give a document's share of good text, and a logistic curve over it and the text's length the score.

Defined results: null texts count as empty; an empty text is one empty line; lines end at a line
feed; labels without a value are not used, repeated labels of an id count as the larger one; repeated
rows are scored one by one; without labels of both kinds every score is 1; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, logistic, sigmoid
from .ordered_minhash import word_hashes

FIT_DOCS = 5_000
#: Lines of a training chain; longer documents make several chains.
CHAIN = 64
ROUNDS, STEPS, RATE, SHRINK = 3, 80, 0.1, 1e-3

#: Classes of bytes: 0 lower case and letters beyond ASCII, 1 upper case, 2 digit, 3 space, 4 bar,
#: 5 exclamation mark, 6 signs that decorate words, 7 other punctuation.
_CLASS = np.zeros(256, dtype=np.uint8)
for _code in range(128):
    _c = chr(_code)
    _CLASS[_code] = (
        0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c.isspace() or not _c.isprintable() else 4 if _c == "|" else 5 if _c == "!" else 6 if _c in "*#%&$~^" else 7
    )
#: Features of a line: shares of the seven classes after the first, log length, log words, mean word
#: length, share of words that repeat the one before, share of words seen among the last 64.
OWN = 12


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines, OWN) features and the byte length of each line."""
    lines = text.split("\n")
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    kinds = _CLASS[data]
    ends = np.r_[np.flatnonzero(data == 10), len(data)]
    starts = np.r_[0, ends[:-1] + 1]
    size = ends - starts
    out = np.zeros((len(lines), OWN))
    whole = np.maximum(size, 1)
    for k in range(1, 8):
        sums = np.r_[0, np.cumsum(kinds == k, dtype=np.int64)]
        out[:, k - 1] = (sums[ends] - sums[starts]) / whole
    split = [line.split() for line in lines]
    count = np.fromiter(map(len, split), dtype=np.int64, count=len(lines))
    out[:, 7] = np.log1p(size) / 6
    out[:, 8] = np.log1p(count) / 4
    out[:, 9] = np.minimum(size / np.maximum(count, 1), 40) / 10
    if count.sum() > 1:
        ids = word_hashes(list(chain.from_iterable(split)))
        line = np.repeat(np.arange(len(lines)), count)
        same = np.flatnonzero((ids[1:] == ids[:-1]) & (line[1:] == line[:-1]))
        out[:, 10] = np.bincount(line[same + 1], minlength=len(lines)) / np.maximum(count, 1)
        order = np.argsort(ids, kind="stable")
        again = np.zeros(len(ids), dtype=bool)
        close = (ids[order][1:] == ids[order][:-1]) & (np.diff(order) <= 64)
        again[order[1:][close]] = True
        out[:, 11] = np.bincount(line[again], minlength=len(lines)) / np.maximum(count, 1)
    return out, size


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """A line's features, those of the lines before and after it, edge marks and a constant."""
    n = len(own)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    edge = np.zeros((n, 3))
    edge[:, 0] = 1
    edge[0, 1] = edge[-1, 2] = 1
    return np.c_[own, own**2, before, after, edge]


WIDTH = 4 * OWN + 3


def marginals(unary: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(good) of each line by forward-backward; ``unary`` is the score of good against bad."""
    n = len(unary)
    (t00, t01), (t10, t11) = np.exp(trans - trans.max()).tolist()
    odds = np.exp(np.clip(unary, -30, 30)).tolist()
    ahead = [0.0] * n
    f0, f1 = 1.0, odds[0]
    ahead[0] = f1 / (f0 + f1)
    for i in range(1, n):
        p = ahead[i - 1]
        f0, f1 = (1 - p) * t00 + p * t10, ((1 - p) * t01 + p * t11) * odds[i]
        ahead[i] = f1 / (f0 + f1)
    out = [0.0] * n
    b0 = b1 = 1.0
    for i in range(n - 1, -1, -1):
        p = ahead[i]
        good, bad = p * b1, (1 - p) * b0
        out[i] = good / (good + bad)
        o = odds[i]
        n0, n1 = t00 * b0 + t01 * o * b1, t10 * b0 + t11 * o * b1
        s = n0 + n1
        b0, b1 = n0 / s, n1 / s
    return np.array(out)


def good_share(own: np.ndarray, size: np.ndarray, weights: np.ndarray, trans: np.ndarray) -> float:
    """Length-weighted mean of the marginals."""
    p = marginals(with_neighbours(own) @ weights, trans)
    w = size + 1.0
    return float((p * w).sum() / w.sum())


class Model:
    def __init__(self, weights, trans, curve):
        self.weights, self.trans, self.curve = weights, trans, curve

    def score(self, text: str) -> float:
        if self.curve is None:
            return 1.0
        own, size = line_features(text)
        return float(sigmoid(_curve_inputs(good_share(own, size, self.weights, self.trans), size.sum()) @ self.curve))


def _curve_inputs(share, length) -> np.ndarray:
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.stack([np.ones_like(share), np.log(share / (1 - share)), np.log1p(length) / 5 + np.zeros_like(share)], axis=-1)


def _expected(at: np.ndarray, score: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) at each place of padded chains and the expected transitions; ``at`` (chains, width)
    are line numbers, -1 beyond a chain's end."""
    there = at >= 0
    width = at.shape[1]
    odds = np.exp(np.clip(np.where(there, score[at], 0.0), -30, 30))
    t = np.exp(trans)
    fwd, bwd = np.empty((*at.shape, 2)), np.ones((*at.shape, 2))
    fwd[:, 0, 0], fwd[:, 0, 1] = 1 / (1 + odds[:, 0]), odds[:, 0] / (1 + odds[:, 0])
    for i in range(1, width):
        f = fwd[:, i - 1] @ t
        f[:, 1] *= odds[:, i]
        fwd[:, i] = f / f.sum(1, keepdims=True)
    for i in range(width - 2, -1, -1):
        b = bwd[:, i + 1].copy()
        b[:, 1] *= odds[:, i + 1]
        b = b @ t.T
        bwd[:, i] = np.where(there[:, i + 1, None], b / b.sum(1, keepdims=True), 1.0)
    post = fwd * bwd
    good = post[..., 1] / post.sum(-1)
    after = bwd[:, 1:].copy()
    after[..., 1] *= odds[:, 1:]
    joint = fwd[:, :-1, :, None] * t * after[:, :, None, :]
    joint *= there[:, 1:, None, None] / joint.sum((2, 3), keepdims=True)
    return good, joint.sum((0, 1))


def _fit_chain(x: np.ndarray, y: np.ndarray, groups: list[np.ndarray], weights: np.ndarray, trans: np.ndarray):
    """Gradient ascent with momentum scaling; ``groups`` are padded chains of like length."""
    seen = np.zeros((2, 2))
    for at in groups:
        lab, pairs = y[at], at[:, 1:] >= 0
        np.add.at(seen, (lab[:, :-1][pairs], lab[:, 1:][pairs]), 1)
    n = float(len(x))
    m = [np.zeros_like(weights), np.zeros_like(trans)]
    v = [np.zeros_like(weights), np.zeros_like(trans)]
    for k in range(1, STEPS + 1):
        score = x @ weights
        miss, expected = np.zeros(len(x)), np.zeros((2, 2))
        for at in groups:
            good, pairs = _expected(at, score, trans)
            there = at >= 0
            miss[at[there]] = y[at[there]] - good[there]
            expected += pairs
        grads = [x.T @ miss / n - SHRINK * weights, (seen - expected) / n - SHRINK * trans]
        for p, g, mm, vv in zip((weights, trans), grads, m, v, strict=True):
            mm *= 0.9
            mm += 0.1 * g
            vv *= 0.999
            vv += 0.001 * g * g
            p += RATE * (mm / (1 - 0.9**k)) / (np.sqrt(vv / (1 - 0.999**k)) + 1e-8)
    return weights, trans


def _chains(bounds: np.ndarray) -> list[np.ndarray]:
    """Line numbers of chains of at most ``CHAIN`` lines, padded to the next of a few widths."""
    by: dict[int, list[np.ndarray]] = {}
    for a, b in zip(bounds, bounds[1:], strict=False):
        for lo in range(a, b, CHAIN):
            n = min(b, lo + CHAIN) - lo
            width = next(w for w in (1, 2, 4, 8, 16, 32, CHAIN) if w >= n)
            line = np.full(width, -1)
            line[:n] = np.arange(lo, lo + n)
            by.setdefault(width, []).append(line)
    return [np.array(by[w]) for w in sorted(by)]


def fit_lines(docs: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """``docs``: (own features, line sizes, label) of each document."""
    labels = np.array([d[2] for d in docs], dtype=float)
    if not len(labels) or not 0 < labels.sum() < len(labels):
        return Model(None, None, None)
    x = np.concatenate([with_neighbours(d[0]) for d in docs])
    bounds = np.r_[0, np.cumsum([len(d[0]) for d in docs])]
    y = np.repeat(labels.astype(int), np.diff(bounds))
    groups = _chains(bounds)
    weights, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    for turn in range(ROUNDS):
        weights, trans = _fit_chain(x, y, groups, weights, trans)
        if turn + 1 < ROUNDS:
            for (a, b), bad in zip(zip(bounds, bounds[1:], strict=False), labels == 0, strict=True):
                if bad:
                    p = marginals(x[a:b] @ weights, trans)
                    y[a:b] = p > 0.5
                    y[a + int(p.argmin())] = 0
    share = np.array([good_share(own, size, weights, trans) for own, size, _ in docs])
    length = np.array([size.sum() for _, size, _ in docs])
    return Model(weights, trans, logistic(_curve_inputs(share, length), labels))


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [line_features(t or "") for t in pdf["text"]]
        yield pd.DataFrame(
            {"y": pdf["y"], "x": [x.astype("<f4").tobytes() for x, _ in rows], "size": [s.astype("<i8").tobytes() for _, s in rows]}
        )


def fit(docs: DataFrame, labels: DataFrame, use=None, most: int = FIT_DOCS) -> Model:
    """A model of ``labels.quality`` from at most ``most`` documents; ``use`` filters label rows."""
    sample = labelled_sample(docs, labels, "quality", use, most)
    rows = sample.select("y", "text").mapInPandas(_feature_rows, "y int, x binary, size binary").collect()
    ready = [(np.frombuffer(r["x"], dtype="<f4").reshape(-1, OWN).astype(float), np.frombuffer(r["size"], dtype="<i8"), r["y"]) for r in rows]
    return fit_lines(sorted(ready, key=lambda d: (d[2], len(d[0]), d[0].tobytes())))


def with_scores(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a column of scores."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            yield pd.Series([model.score(t or "") for t in text], dtype=float)

    return docs.withColumn(column, score("text"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, score, predicted; labels whose crc32 of the id is 2
    modulo 4 are held out."""
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs, labels, ~held)
    scored = with_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
