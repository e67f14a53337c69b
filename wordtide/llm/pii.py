"""Personal data by candidate gradient boosting, native throughout.

1. Generators propose spans with offsets: one strict pattern a kind (the base rules) and several of
   high recall, which overlap each other and the base. A pattern's matches are marked with a control
   character that the text cannot hold (``translate`` swaps it out first, one for one, so offsets
   stay), the marked text is split at the marks, and running lengths give the offsets in code points.
   Running lengths are made in blocks, so a text of very many matches costs time in proportion.
2. Every candidate gets ``FEATURES`` of its format and its context as bits. Labels are weak and not the
   strict rules: positive are base spans, seen a second time without the bits that the strict pattern
   asks for (``HIDDEN``), and candidates after a word that announces their kind, seen without that cue;
   negative are candidates of a broken format (Luhn's check, parts above 255, too few digits, dates,
   no mixture of letters and digits) without a cue; all others are unlabelled and left out.
   Candidates of all documents are counted by (kind, bits, label, fold): at most 2**features rows,
   whatever the input. Boosted trees of depth two are fitted to the counts of one fold (documents by
   hash); thresholds per kind are calibrated to ``PRECISION`` on the other fold.
3. The trees are written as CASE expressions and score the candidates in the JVM. Base spans always
   stay. Candidates above their kind's threshold compete: one is added if it touches no base span and
   no candidate that it overlaps has a better score (ties: the earlier start, then the longer one, then
   the earlier kind).

Added spans may be of the kind ``secret`` (keys, passwords), which has no base rule.

Defined results: null texts count as empty; equal spans of two generators count once; repeated
rows are scored one by one; an empty table gives an empty result (and no trees); a corpus without
one label adds nothing. Only named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
MARK, STAND_IN = "\x01", "\x02"
CONTEXT = 24
PRECISION = 0.95
TREES, SHRINK = 24, 0.4
#: Longest candidate of the generators of high recall.
LONGEST = 800
#: Elements that running sums take at a time.
BLOCK = 256

#: Strict patterns. Possessive forms and look-behinds match what the plain ones do, without
#: recursion on long runs and without a second look at a run that has failed.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of high recall: (kind, pattern).
LOOSE = (
    ("email", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]| at ) ?[a-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[a-z0-9-]{2,63}+){1,8}+"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}+(?: ?\. ?[0-9]{1,3}+){3}+(?![0-9])|(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}+:){7}[0-9a-f]{1,4}+(?![0-9a-f:])"),
    ("card", r"(?<![0-9])[0-9](?:[ ./-]?+[0-9]){11,20}+(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{14,19}+(?![0-9])"),
    ("phone", r"(?<![0-9A-Za-z.])(?:\+|00)?[(]?[0-9][0-9 ()./-]{6,22}[0-9](?![0-9A-Za-z])"),
    ("secret", r"(?<![A-Za-z0-9+/_])[A-Za-z0-9+/_]{16,128}+(?![A-Za-z0-9+/_])"),
)
#: A text without these has no match of the kind at all.
GATE = {
    "email": r"@|(?i)[(\[ ]at[)\] ]", "ip": r"[0-9]\s?[.]|[0-9a-fA-F]:", "card": r"[0-9]", "phone": r"[0-9]",
    "secret": r"[A-Za-z0-9+/_]{16}",
}
CUES = {
    "email": r"(?i)mail|contact|write|kontakt|courriel|correo",
    "ip": r"(?i)\bip\b|host|server|address|adresse|login",
    "card": r"(?i)card|visa|master|karte|carte|tarjeta|payment",
    "phone": r"(?i)tel|phone|call|fax|mobil|anruf|llam",
    "secret": r"(?i)(?:passw(?:or)?d|secret|token|key)\W{1,5}$",
}
#: Names of the feature bits, in order.
FEATURES = (
    "plus", "bracket", "space", "dash", "dot", "at", "ten", "fourteen", "octets", "luhn", "cue", "bounded", "mixed", "even",
)
#: Bits that a strict pattern asks for, and the cue: labelled spans are seen without them as well.
HIDDEN = {"email": ("at", "cue"), "ip": ("cue",), "card": ("space", "dash", "cue"), "phone": ("plus", "cue"), "secret": ("cue",)}


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 1 to 19 digits passes Luhn's check."""
    back = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (i % 2 + 1))
    total = F.aggregate(back, F.lit(0), lambda acc, v: acc + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def octets(x: Column) -> Column:
    """Whether all parts between dots are at most 255."""
    return F.forall(F.split(x, r" ?\. ?"), lambda p: p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def holds(kind: str, x: Column) -> Column:
    """Whether a match of the strict pattern passes the rest of its rule."""
    n = F.length(_digits(x))
    if kind == "ip":
        return octets(x)
    if kind == "card":
        return F.when(n.between(14, 19), luhn(_digits(x))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


_SPAN = "array<struct<k:int,s:int,e:int,bits:int,y:int>>"
_PLAIN = "array<struct<k:int,s:int,e:int>>"
_CHOSEN = "array<struct<k:int,s:int,e:int,score:double>>"


def running(parts: str) -> Column:
    """Where each part of an array column begins, if the parts are put one after the other."""
    add = lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n)
    first = lambda x: F.array(x.cast("int"))
    blocks = F.expr(f"transform(sequence(0, cast((size({parts}) - 1) div {BLOCK} as int)), b -> slice({parts}, b * {BLOCK} + 1, {BLOCK}))")
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, p: acc + F.length(p)))
    offsets = F.aggregate(sums, first(F.lit(0)), add)
    inside = lambda b, o: F.slice(F.aggregate(b, first(o), lambda acc, p: add(acc, F.length(p))), 1, F.size(b))
    return F.flatten(F.zip_with(blocks, F.slice(offsets, F.lit(1), F.size(offsets) - 1), inside))


def _bits(kind: str, x: Column, before: Column, after: Column) -> Column:
    """Feature bits of a candidate."""
    digits, none = _digits(x), F.lit(False)
    n = F.length(digits)
    letters = F.length(F.regexp_replace(x, "[^A-Za-z]", ""))
    flags = (
        x.startswith("+"), x.contains("("), x.contains(" "), x.contains("-"), x.contains("."), x.contains("@"),
        n.between(10, 13), n.between(14, 19), octets(x) if kind == "ip" else none,
        F.when(n.between(14, 19), luhn(digits)).otherwise(none) if kind in ("card", "phone") else none,
        before.rlike(CUES[kind]), ~before.rlike(r"[A-Za-z0-9]$") & ~after.rlike(r"^[A-Za-z0-9]"),
        (n >= 2) & (letters >= 2), ~x.rlike("[a-z]") | ~x.rlike("[A-Z]"),
    )
    out = F.lit(0)
    for i, flag in enumerate(flags):
        out = out + F.when(flag, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def broken(kind: str, x: Column) -> Column:
    """Whether a candidate's format rules its kind out."""
    n = F.length(_digits(x))
    if kind == "email":
        return ~x.rlike(r"(?i)(?:\.|\(dot\)|\[dot\]|dot) ?[a-z]{2,24}$")
    if kind == "ip":
        return ~x.contains(":") & ~octets(x)
    if kind == "card":
        return F.when(n.between(14, 19), ~luhn(_digits(x))).otherwise(F.lit(True))
    if kind == "phone":
        return ~n.between(8, 15) | x.rlike(r"^[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{1,4}$")
    return (n < 2) | (F.length(F.regexp_replace(x, "[^A-Za-z]", "")) < 2) | x.rlike(r"_[A-Za-z]+_|^[A-Za-z_/+]+[0-9]{0,2}$")


def _marked(text: Column, kind: str, pattern: str) -> Column:
    """The text cut at the matches: every second part is one; null without matches."""
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)
    return F.when(text.rlike(GATE[kind]) & text.rlike(pattern), parts)


def _spans(parts: str, starts: str, kind: str, strict: bool) -> Column:
    """Candidates with offsets (code points, end exclusive), bits and weak label (null: none)."""
    places = F.expr(f"sequence(1, size({parts}) - 2, 2)")

    def span(i):
        x, before, after = F.get(parts, i), F.right(F.get(parts, i - 1), F.lit(CONTEXT)), F.left(F.get(parts, i + 1), F.lit(1))
        bits = _bits(kind, x, before, after)
        cue = bits.bitwiseAND(F.lit(1 << FEATURES.index("cue"))) != 0
        y = F.lit(1) if strict else F.when(cue & ~broken(kind, x), 1).when(broken(kind, x) & ~cue, 0)
        at = F.get(starts, i)
        return F.struct(F.lit(KINDS.index(kind)).alias("k"), at.alias("s"), (at + F.length(x)).alias("e"), bits.alias("bits"), y.alias("y"))

    if strict:
        places = F.filter(places, lambda i: holds(kind, F.get(parts, i)))
    return F.coalesce(F.transform(places, span).cast(_SPAN), F.array().cast(_SPAN))


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``pii_base`` (base spans) and ``pii_more`` (candidates), both as k, s, e, bits, y."""
    searches = [(k, STRICT[k], True) for k in BASE_KINDS] + [(k, p, False) for k, p in LOOSE]
    shadow = F.translate(F.coalesce(F.col(text), F.lit("")), MARK, STAND_IN)
    df = docs.withColumn("pii_text", shadow)
    df = df.select("*", *[_marked(F.col("pii_text"), k, p).alias(f"pii_parts{i}") for i, (k, p, _) in enumerate(searches)]).drop("pii_text")
    df = df.select("*", *[F.when(F.col(f"pii_parts{i}").isNotNull(), running(f"pii_parts{i}")).alias(f"pii_starts{i}") for i in range(len(searches))])
    found = [_spans(f"pii_parts{i}", f"pii_starts{i}", k, strict) for i, (k, _, strict) in enumerate(searches)]
    df = df.withColumn("pii_base", F.concat(*found[: len(BASE_KINDS)])).withColumn("pii_more", F.concat(*found[len(BASE_KINDS) :]))
    return df.drop(*[f"pii_{x}{i}" for x in ("parts", "starts") for i in range(len(searches))])


def count_patterns(found: DataFrame) -> list[tuple[int, int, int, int, int]]:
    """(kind, bits, fold, labelled candidates, positive ones) over all documents, from ``found`` with
    ``pii_fold``: bounded by the number of bits. Positive ones count with and without hidden bits."""
    hidden = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (k, sum(1 << FEATURES.index(f) for f in HIDDEN[kind]))])
    seen = lambda m, bits: F.struct(m["k"].alias("k"), bits.alias("bits"), m["y"].alias("y"))
    rows = found.select("pii_fold", F.explode(F.filter(F.concat("pii_base", "pii_more"), lambda m: m["y"].isNotNull())).alias("m"))
    bits = F.col("m.bits")
    bare = bits.bitwiseAND(F.bitwise_not(hidden[F.col("m.k")]))
    rows = rows.select("pii_fold", F.explode(F.when(F.col("m.y") == 1, F.array(seen(F.col("m"), bits), seen(F.col("m"), bare))).otherwise(F.array(seen(F.col("m"), bits)))).alias("c"))
    counts = rows.groupBy("c.k", "c.bits", "pii_fold").agg(F.count("*").alias("n"), F.sum("c.y").alias("y"))
    return [(r["k"], r["bits"], r["pii_fold"], r["n"], r["y"]) for r in counts.collect()]


class Boosted:
    """Trees of depth two over bits: (first bit, bit if set, bit if not, four values)."""

    def __init__(self, prior: float, trees: list[tuple], thresholds: dict[int, float]):
        self.prior, self.trees, self.thresholds = prior, trees, thresholds

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        for a, b, c, v in self.trees:
            out += np.where(x[:, a], np.where(x[:, b], v[0], v[1]), np.where(x[:, c], v[2], v[3]))
        return 1 / (1 + np.exp(-out))

    def column(self, bits: Column) -> Column:
        """The same score as an expression."""
        on = lambda i: bits.bitwiseAND(F.lit(1 << i)) != 0
        out = F.lit(float(self.prior))
        for a, b, c, v in self.trees:
            yes = F.when(on(b), F.lit(float(v[0]))).otherwise(F.lit(float(v[1])))
            no = F.when(on(c), F.lit(float(v[2]))).otherwise(F.lit(float(v[3])))
            out = out + F.when(on(a), yes).otherwise(no)
        return 1 / (1 + F.exp(-out))


def _table(patterns: list[tuple]) -> tuple[np.ndarray, ...]:
    """Kinds, bits as columns (kinds last), candidates and positive ones."""
    bits = np.array([p[1] | 1 << (len(FEATURES) + p[0]) for p in patterns], dtype=np.int64)
    x = (bits[:, None] >> np.arange(len(FEATURES) + len(KINDS)) & 1).astype(bool)
    return np.array([p[0] for p in patterns]), x, np.array([p[3] for p in patterns], float), np.array([p[4] for p in patterns], float)


def fit(patterns: list[tuple[int, int, int, int, int]], trees: int = TREES, shrink: float = SHRINK) -> Boosted:
    """Gradient boosting on the counted patterns of fold 0 with logistic loss, and a threshold for each
    kind: the least score, one half at least, from which on the labels of fold 1 have a precision of
    ``PRECISION``. A fold without both labels stands for nothing; then both are one."""
    folds = [sorted(p for p in patterns if p[2] == f) for f in (0, 1)]
    if not all(0 < sum(p[4] for p in f) < sum(p[3] for p in f) for f in folds):
        folds = [sorted(patterns)] * 2
    patterns = folds[0]
    if not patterns or not 0 < sum(p[4] for p in patterns) < sum(p[3] for p in patterns):
        return Boosted(0.0, [], {})
    _, x, n, y = _table(patterns)
    nbits = x.shape[1]
    prior = float(np.log((y.sum() + 1) / (n.sum() - y.sum() + 1)))
    raw, out = np.full(len(n), prior), []

    def leaf(mask, grad, hess):
        return grad[mask].sum() / (hess[mask].sum() + 1.0)

    def gain(mask, grad, hess):
        best = (-1.0, 0)
        for j in range(nbits):
            g = sum(grad[m].sum() ** 2 / (hess[m].sum() + 1.0) for m in (mask & x[:, j], mask & ~x[:, j]))
            best = max(best, (g, -j))
        return best[0], -best[1]

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - n * p, n * p * (1 - p)
        options = []
        for a in range(nbits):
            (gb, b), (gc, c) = gain(x[:, a], grad, hess), gain(~x[:, a], grad, hess)
            options.append((gb + gc, -a, b, c))
        _, a, b, c = max(options)
        a = -a
        masks = (x[:, a] & x[:, b], x[:, a] & ~x[:, b], ~x[:, a] & x[:, c], ~x[:, a] & ~x[:, c])
        values = tuple(float(np.clip(shrink * leaf(m, grad, hess), -4, 4)) for m in masks)
        for m, v in zip(masks, values, strict=True):
            raw[m] += v
        out.append((a, b, c, values))
    model = Boosted(prior, out, {})
    kinds, x, n, y = _table(folds[1])
    score = model.score(x)
    for k in range(len(KINDS)):
        own = kinds == k
        for cut in sorted(set(np.round(score[own], 6)), reverse=True):
            over = own & (score >= cut - 1e-6)
            if y[over].sum() < PRECISION * n[over].sum():
                break
            model.thresholds[k] = float(max(cut - 1e-6, 0.5))
    return model


def decide(found: DataFrame, model: Boosted) -> DataFrame:
    """Adds ``pii_spans``: base and added spans by start and kind; ``found`` has a unique ``pii_row``."""
    def over(k: int, least: float) -> Column:
        score = lambda m: model.column(m["bits"] + F.lit(1 << (len(FEATURES) + k)))
        rated = F.transform(F.filter("pii_more", lambda m: m["k"] == k), lambda m: F.struct(m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e"), score(m).alias("score")))
        return F.filter(rated.cast(_CHOSEN), lambda m: m["score"] >= F.lit(least))

    scored = [over(k, least) for k, least in model.thresholds.items()]
    chosen = F.concat(*scored) if scored else F.array().cast(_CHOSEN)
    df = found.withColumn("pii_chosen", chosen)
    by_start = lambda spans: F.array_sort(F.transform(spans, lambda m: F.struct(m["s"].alias("s"), m["k"].alias("k"), m["e"].alias("e"))))
    base = F.transform("pii_base", lambda m: F.struct(m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e")))
    df = df.withColumn("pii_base", base.cast(_PLAIN))
    rows = df.where("size(pii_chosen) > 0").select("pii_row", F.explode(F.array_distinct("pii_chosen")).alias("m"), F.lit(False).alias("fixed"))
    fixed = F.transform("pii_base", lambda m: F.struct(m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e"), F.lit(9.0).alias("score")))
    rows = rows.union(df.where("size(pii_chosen) > 0").select("pii_row", F.explode(fixed.cast(_CHOSEN)), F.lit(True)))
    along = Window.partitionBy("pii_row").orderBy("m.s")
    before = F.max(F.when(F.col("fixed"), F.col("m.e"))).over(along.rangeBetween(Window.unboundedPreceding, 0))
    near = F.collect_list("m").over(along.rangeBetween(-LONGEST, LONGEST))
    rows = rows.select("pii_row", "m", "fixed", before.alias("covered"), near.alias("near"))
    rank = lambda m: F.struct((-m["score"]).alias("a"), m["s"].alias("b"), (-m["e"]).alias("c"), m["k"].alias("d"))
    loses = F.exists("near", lambda o: (o["s"] < F.col("m.e")) & (F.col("m.s") < o["e"]) & (rank(o) < rank(F.col("m"))))
    added = rows.where(~F.col("fixed") & (F.coalesce("covered", F.lit(0)) <= F.col("m.s")) & ~loses)
    added = added.groupBy("pii_row").agg(F.collect_list(F.struct("m.k", "m.s", "m.e")).alias("pii_added"))
    with_some = df.where("size(pii_chosen) > 0").join(added, "pii_row", "left").withColumn("pii_added", F.coalesce("pii_added", F.array().cast(_PLAIN)))
    both = df.where("size(pii_chosen) = 0").withColumn("pii_added", F.array().cast(_PLAIN)).unionByName(with_some)
    return both.withColumn("pii_spans", by_start(F.concat("pii_base", "pii_added"))).withColumn("pii_base", by_start(F.col("pii_base")))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(names, m["k"]), m["s"].cast("string"), m["e"].cast("string"))), ",")


def _found(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with candidates, a row number and a fold, written once: decisions and counts read it."""
    fold = (F.crc32(F.coalesce("text", F.lit(""))) % 2).cast("int")
    found = with_candidates(docs).withColumn("pii_fold", fold).withColumn("pii_row", F.monotonically_increasing_id())
    return materialise(found if keep_text else found.drop("text"), "pii-candidates")


def _of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda m: m["k"] == kind)


def find(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256,
    spans, n_added."""
    found = _found(docs.select("doc_id", "text"), keep_text=False)
    done = decide(found, fit(count_patterns(found)))
    counts = [F.size(_of_kind("pii_base", i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return done.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("pii_base")), 256).alias("base_sha256"),
        listed(F.col("pii_spans")).alias("spans"),
        F.size("pii_added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, model: Boosted | None = None) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; all columns stay.

    Overlapping spans are replaced as one, by the kind of the first. Null texts stay null.
    """
    kept = {c: f"pii_own_{i}" for i, c in enumerate(docs.columns)}  # own columns may be called as ours
    found = _found(docs.select(*[F.col(c).alias(kept[c] if c != "text" else c) for c in docs.columns]))
    done = decide(found, model or fit(count_patterns(found)))
    empty = F.array().cast("array<struct<k:int,s:int,e:int>>")
    merged = F.aggregate(
        "pii_spans",
        empty,
        lambda acc, m: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] > m["s"]),
            F.array_append(
                F.slice(acc, 1, F.size(acc) - 1),
                F.struct(
                    F.element_at(acc, -1)["k"].alias("k"),
                    F.element_at(acc, -1)["s"].alias("s"),
                    F.greatest(F.element_at(acc, -1)["e"], m["e"]).alias("e"),
                ),
            ),
        ).otherwise(F.array_append(acc, F.struct(m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e")))),
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    pieces = F.transform(
        "pii_merged",
        lambda m, i: F.concat(
            F.substring("text", F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("pii_merged"), i - 1)["e"]) + 1, m["s"] - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("pii_merged"), i - 1)["e"])),
            F.get(names, m["k"]),
        ),
    )
    tail = F.expr("substring(text, element_at(pii_merged, -1).e + 1)")
    clean = F.when(F.size("pii_spans") == 0, F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return done.withColumn("pii_merged", merged).withColumn("text", F.when(F.col("text").isNull(), F.col("text")).otherwise(clean)).select(*[F.col(kept[c] if c != "text" else c).alias(c) for c in docs.columns])
