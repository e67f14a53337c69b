"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

Fitting, on at most ``FIT_DOCS`` labelled documents (those whose id hashes lowest): words and word
beginnings that occur mostly in toxic documents form the lexicon, each with its log odds. A Levenshtein
automaton for one edit (a letter too much, too few or wrong, or two neighbours exchanged) is intersected with the trie of the terms of at least ``FUZZY_FROM`` letters
(``BEGINS_FUZZY_FROM`` for beginnings) and turned into a deterministic automaton state by state as
words come, so a word that is far from all terms ends after a few letters.

Scoring, over whole texts: every hit, misspelled or not, has its term's weight times a factor for each
of: misspelled, inside quotation marks, near words of reporting, near second persons (``WINDOW`` words
at either side). The factors are learnt with the model, each from a range that keeps their sense: a
misspelling counts less than the term and more than nothing, quotation lessens, address raises.
Logistic regression over the weighed hits, with weights that are never negative, gives the score, so
no hit lowers it. For the fit each half of the documents is scored by a lexicon of the other half, so
the hits are no better than on unseen texts.

Defined results: null texts count as empty; empty texts and texts without hits get the score of no
hits; labels without a value, or for other ids, are not used; repeated labels of an id count as the
larger one; repeated rows are scored one by one; without labels of both kinds every score is 0; an
empty table gives an empty result; other columns stay in ``with_scores`` and are not read elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, logistic, materialise, sigmoid

FIT_DOCS = 16_000
#: Most terms that a lexicon may have, since it is collected and sent to the tasks; more raise an error, none are left out.
MOST_TERMS = 100_000
LEAST_SHARE = 0.75
#: Terms of the lexicon that chance alone may be expected to give.
CHANCE_TERMS = 1.0
BEGINNINGS = range(3, 9)
FUZZY_FROM, BEGINS_FUZZY_FROM = 5, 6
WINDOW = 8
CACHE = 400_000

WORD = regex.compile(r"[^\W\d_]+")
QUOTES = "\"“”„«»"
#: Fixed word lists of the context.
REPORTING = frozenset(
    "said says quote quoted quotes called calling word term wrote sagte nannte zitat dit disait citation appelé dijo llamó cita".split()
)
SECOND = frozenset("you your youre yourself u du dich dir dein deine ihr euch tu te toi ton ta tes vous votre usted ustedes tú ti vosotros".split())

#: The least factor of a misspelling is a choice: a fit on few misspelled terms would take still less, and lose misspelled abuse.
#: What lessens or raises a hit, and the values that its factor may take; the middle one unless the fit gains.
FACTORS = {"misspelled": (0.25, 0.5, 0.75, 0.9), "quoted": (0.3, 0.5, 0.7), "reported": (0.6, 0.75, 0.9), "addressed": (1.1, 1.25, 1.5)}
START = (0.5, 0.5, 0.75, 1.25)
#: Log likelihood that another value must gain.
LEAST_GAIN = 1.0
CLASSES = 1 << len(FACTORS)
FEATURES = ("most", "sum", "density")


class Automaton:
    """The product of a trie and the Levenshtein automaton for one edit, built while it is used."""

    def __init__(self, terms: dict[str, float]):
        self.next: list[dict[str, int]] = [{}]
        self.ends: dict[int, float] = {}
        for term, weight in terms.items():
            node = 0
            for c in term:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                node = self.next[node][c]
            self.ends[node] = weight
        self.start = self._closed({(0, 0, "")})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}

    def _closed(self, items: set) -> frozenset:
        """With skipped term letters (deletions) added, and no item that a better one covers. An item is a node of the trie, the
        edits so far and, in the middle of an exchange, the letter that must come next."""
        more = {(child, 1, "") for node, e, due in items if not e and not due for child in self.next[node].values()}
        items = items | more
        return frozenset((n, e, due) for n, e, due in items if not e or due or (n, 0, "") not in items)

    def step(self, state: frozenset, c: str) -> frozenset:
        key = (state, c)
        got = self.steps.get(key)
        if got is None:
            items = set()
            for node, e, due in state:
                if due:
                    if c == due:
                        items.add((node, e, ""))
                    continue
                below = self.next[node]
                if c in below:
                    items.add((below[c], e, ""))
                if not e:
                    items.add((node, 1, ""))
                    items.update((child, 1, "") for child in below.values())
                    items.update((self.next[child][c], 1, letter) for letter, child in below.items() if c in self.next[child])
            if len(self.steps) > CACHE:
                self.steps.clear()
            got = self.steps[key] = self._closed(items)
        return got

    def match(self, word: str, begins: bool = False) -> tuple[float, int] | None:
        """(weight, edits) of the best term within one edit of the word, or of a beginning of it."""
        state, found = self.start, []
        for c in word:
            state = self.step(state, c)
            if not state:
                break
            if begins:
                found += [(e, -self.ends[node]) for node, e, due in state if not due and node in self.ends]
        if not begins:
            found = [(e, -self.ends[node]) for node, e, due in state if not due and node in self.ends]
        return (-min(found)[1], min(found)[0]) if found else None


class Lexicon:
    """Whole terms and beginnings with their weights."""

    def __init__(self, terms: list[tuple[str, bool, float]], factors: tuple[float, ...] = START):
        self.factors = factors
        self.whole = {t: w for t, begins, w in terms if not begins}
        self.begins = {t: w for t, begins, w in terms if begins}
        self.sizes = sorted({len(t) for t in self.begins})
        self.near = Automaton({t: w for t, w in self.whole.items() if len(t) >= FUZZY_FROM})
        self.near_begins = Automaton({t: w for t, w in self.begins.items() if len(t) >= BEGINS_FUZZY_FROM})
        self.seen: dict[str, tuple[float, int] | None] = {}

    def _match(self, word: str) -> tuple[float, int] | None:
        weight = self.whole.get(word, 0.0)
        for n in self.sizes:
            if n <= len(word):
                weight = max(weight, self.begins.get(word[:n], 0.0))
        if weight:
            return weight, 0
        if len(word) < FUZZY_FROM - 1:
            return None
        near = [m for m in (self.near.match(word), self.near_begins.match(word, True)) if m]
        return max(near) if near else None

    def match(self, word: str) -> tuple[float, int] | None:
        try:
            return self.seen[word]
        except KeyError:
            if len(self.seen) > CACHE:
                self.seen.clear()
            got = self.seen[word] = self._match(word)
            return got

    def hits(self, text: str) -> list[float]:
        """For each class of hits (a bit for each factor) the largest weight, then for each class the
        sum of weights, then the number of words."""
        most, total = [0.0] * CLASSES, [0.0] * CLASSES
        low = text.lower()
        found = WORD.findall(low)
        matched = {w: m for w in set(found) if (m := self.match(w))}
        if not matched:
            return [*most, *total, float(len(found))]
        found = [(m.start(), m.group()) for m in WORD.finditer(low)]
        for i, (at, word) in enumerate(found):
            if word not in matched:
                continue
            weight, edits = matched[word]
            lo, hi = max(0, i - WINDOW), min(len(found), i + WINDOW + 1)
            left, right = low[found[lo][0] : at], low[at + len(word) : found[hi - 1][0]]
            around = {w for _, w in found[lo:hi]}
            opened = sum(left.count(q) for q in QUOTES) % 2 == 1 and any(q in right for q in QUOTES)
            kind = (edits > 0) + 2 * opened + 4 * bool(around & REPORTING) + 8 * bool(around & SECOND)
            most[kind] = max(most[kind], weight)
            total[kind] += weight
        return [*most, *total, float(len(found))]

    def features(self, text: str) -> list[float]:
        return weighed(np.array([self.hits(text)]), self.factors)[0].tolist()


def weighed(hits: np.ndarray, factors: tuple[float, ...]) -> np.ndarray:
    """``FEATURES`` of rows of ``Lexicon.hits`` under the given factors."""
    on = np.arange(CLASSES)[:, None] >> np.arange(len(factors)) & 1
    factor = np.prod(np.where(on, np.array(factors), 1.0), axis=1)
    most, total = (hits[:, :CLASSES] * factor).max(axis=1), (hits[:, CLASSES : 2 * CLASSES] * factor).sum(axis=1)
    return np.stack([most, np.log1p(total), 10.0 * total / (hits[:, -1] + 20)], axis=1)


def learn_lexicon(sample: DataFrame) -> list[tuple[str, bool, float]]:
    """Terms of ``sample(text, y)`` by their share of toxic documents.

    Copies and near copies, told by their two longest words, count as one document in all, each by an equal part of it with its own
    label, or a toxic text with many copies would make all its words terms. A term must be in so many toxic documents that
    among all candidates fewer than ``CHANCE_TERMS`` would be by chance.
    """
    words = sample.select("y", F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}+"), 0)).alias("ws"))
    ranked = F.reverse(F.array_sort(F.transform("ws", lambda w: F.struct(F.length(w), w))))
    words = materialise(words.withColumn("longest", F.sha2(F.to_json(F.slice(ranked, 1, 2)), 256)), "fit-words")
    words = words.join(words.groupBy("longest").agg((1.0 / F.count("*")).alias("part")), "longest")
    starts = F.concat(*[F.transform(F.filter("ws", _at_least(n)), _beginning(n)) for n in BEGINNINGS])
    counts = words.select("y", "part", F.explode(F.array_union("ws", starts)).alias("t")).groupBy("t")
    counts = counts.agg(F.sum(F.col("y") * F.col("part")).alias("bad"), F.sum("part").alias("n"))
    counts = materialise(counts.where("n > 1.000001"), "fit-terms")
    base, candidates = words.agg(F.sum(F.col("y") * F.col("part")) / F.sum("part")).first()[0] or 0.0, counts.count()
    if not 0 < base < 1 or not candidates:
        return []
    least = max(3, math.ceil(math.log(candidates / CHANCE_TERMS) / -math.log(base))) - 1e-6
    share = (F.col("bad") + 0.1) / (F.col("n") + 1.0)
    good = counts.where((F.col("bad") >= least) & (share >= LEAST_SHARE))
    rows = good.select("t", F.log(share / (1 - share)).alias("w"), "bad").orderBy(F.desc("bad"), "t").limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"the lexicon has more than {MOST_TERMS} terms")
    return [(r["t"].rstrip("*"), r["t"].endswith("*"), float(r["w"])) for r in rows]


def _at_least(n: int):
    return lambda w: F.length(w) >= n


def _beginning(n: int):
    """The first n letters, marked as a beginning."""
    return lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))


def _hit_rows(terms):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": [lexicon.hits(t or "") for t in pdf["text"]]})

    return run


def raising(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of a logistic regression, constant first and the others not negative, and its log
    likelihood."""
    use = list(range(x.shape[1]))
    while True:
        own = np.c_[np.ones(len(x)), x[:, use]]
        w = logistic(own, y)
        if not use or w[1:].min() >= 0:
            break
        use.pop(int(w[1:].argmin()))
    p = np.clip(sigmoid(own @ w), 1e-12, 1 - 1e-12)
    full = np.zeros(x.shape[1] + 1)
    full[[0, *(i + 1 for i in use)]] = w
    return full, float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


class Model:
    def __init__(self, terms: list, weights: np.ndarray | None, factors: tuple[float, ...] = START):
        self.terms, self.weights, self.factors = terms, weights, factors

    def lexicon(self) -> Lexicon:
        return Lexicon(self.terms, self.factors)

    def score(self, x) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        return sigmoid(np.c_[np.ones(len(x)), np.asarray(x, dtype=float).reshape(-1, len(FEATURES))] @ self.weights)


def fit(docs: DataFrame, labels: DataFrame, use=None, most: int = FIT_DOCS) -> Model:
    """A model of ``labels.toxic`` from at most ``most`` documents; ``use`` filters label rows."""
    sample = labelled_sample(docs, labels, "toxic", use, most)
    terms = learn_lexicon(sample)
    rows = []
    for half in (0, 1):
        other = learn_lexicon(sample.where(F.col("half") != half))
        rows += sample.where(F.col("half") == half).select("y", "text").mapInPandas(_hit_rows(other), "y int, x array<double>").collect()
    y = np.array([r["y"] for r in rows], dtype=float)
    if not len(y) or not 0 < y.sum() < len(y):
        return Model(terms, None)
    hits, factors = np.array([r["x"] for r in rows], dtype=float), START
    weights, best = raising(weighed(hits, factors), y)
    for _ in range(2):
        for i, values in enumerate(FACTORS.values()):
            for v in values:
                new = (*factors[:i], v, *factors[i + 1 :])
                w, gained = raising(weighed(hits, new), y)
                if gained > best + LEAST_GAIN:
                    weights, best, factors = w, gained, new
    return Model(terms, weights, factors)


def with_scores(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a column of scores."""
    terms, weights, factors = model.terms, model.weights, model.factors

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(terms, weights, factors)
        lexicon = own.lexicon()
        for text in texts:
            yield pd.Series(own.score([lexicon.features(t or "") for t in text]), dtype=float)

    return docs.withColumn(column, score("text"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, score, predicted; labels with a crc32 of the id
    divisible by 5 are held out."""
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit(docs, labels, ~held)
    scored = with_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
