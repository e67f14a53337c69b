"""Embeddings, toxicity, quality, URL filter and WARC against plain versions."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordtide.llm import hostgraph, lattice, linecrf, toxicity, warc
from wordtide.llm.common import read_table
from wordtide.llm.queries import QUERIES

from ..conftest import DATA


# ---- lattice

def brute_links(rows):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None for x in v)]
    usable = [(i, v / np.linalg.norm(v)) for i, v in usable if np.isfinite(v).all() and np.any(v)]
    links, parent = collections.Counter(), {i: i for i, _ in usable}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(usable, 2):
        if len(a) == len(b) and a @ b >= 0.9:
            links[i] += 1
            links[j] += 1
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return links, {i: root(i) for i in parent}


def near_vectors(seed, groups, per, dim=64, noise=0.25):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(per):
            z = rng.normal(size=dim)
            out.append(centre + noise * z / np.linalg.norm(z))
    return [[float(x) for x in v] for v in out]


@pytest.mark.parametrize("block", [lattice.BLOCK, 7])
def test_lattice(spark, monkeypatch, block):
    monkeypatch.setattr(lattice.units, "__defaults__", (block,))
    odd = [None, [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [], [1.0, 2.0], [2.0, 4.0], [1e-30] * 64, [1e30] * 64]
    vectors = near_vectors(1, 12, 9) + near_vectors(2, 1, 60, noise=0.2) + near_vectors(3, 80, 1) + odd
    rows = [(i * 3 + 1, v, 0, 1) for i, v in enumerate(vectors)]
    rows += [(5000 + i, vectors[i], 1, 2) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, n int")
    got = {r["vec_id"]: r for r in lattice.link(df).collect()}
    links, comps = brute_links([(r[0], r[1]) for r in rows])
    assert len(got) == len(rows)
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(links.values())
    assert all(r["n_links"] <= links[i] for i, r in got.items())
    assert all(r["component_id"] == comps.get(i, i) and r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert lattice.link(df.where("false")).count() == 0


def test_e8_nearest():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)) * 1.5
    home = lattice.e8(x)
    twice = (home * 2).astype(int)
    assert ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all() and (home.sum(1) % 2 == 0).all()
    assert len(lattice.NEIGHBOURS) == 240 and np.allclose((lattice.NEIGHBOURS**2).sum(1), 2)
    d = ((x - home) ** 2).sum(1)
    other = ((x[:, None, :] - home[:, None, :] - lattice.NEIGHBOURS) ** 2).sum(2).min(1)
    assert (d <= other + 1e-9).all() and (d <= 1 + 1e-9).all()


# ---- toxicity

def test_automaton():
    terms = {"idiot": 2.0, "moron": 1.0, "clown": 1.5}
    auto = toxicity.Automaton(terms)

    def within_one(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            apart = [i for i in range(len(a)) if a[i] != b[i]]
            exchanged = len(apart) == 2 and apart[1] == apart[0] + 1 and a[apart[0]] == b[apart[1]] and a[apart[1]] == b[apart[0]]
            return len(apart) <= 1 or exchanged
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    rng = random.Random(4)
    for _ in range(4000):
        w = list(rng.choice(list(terms)))
        for _ in range(rng.randint(0, 2)):
            i = rng.randint(0, len(w))
            w[i : i + rng.randint(0, 1)] = [rng.choice("idotmrnclwx")] * rng.randint(0, 1)
            if rng.random() < 0.3 and len(w) > 2:
                i = rng.randrange(len(w) - 1)
                w[i], w[i + 1] = w[i + 1], w[i]
        w = "".join(w)
        hits = [t for t in terms if within_one(w, t)]
        got = auto.match(w)
        assert (got is not None) == bool(hits), w
        assert got is None or got[1] == min(0 if w == t else 1 for t in hits)


def test_copies_count_as_one_document_with_both_labels(spark):
    """Forty near copies of one toxic text make no terms; what ten different toxic texts share does."""
    clean = [(0, f"plain words {chr(97 + i % 26) * 5} about gardens and houses number{i} {'w' + 'abcdefghij'[i % 10] * 9}{chr(97 + i // 10) * 3}") for i in range(60)]
    copies = [(1, "garbled surroundings incomprehensibility extraordinarily poisonous " + "x" * (i % 3)) for i in range(40)]
    shared = [(1, f"zzbadword {chr(97 + i) * 14} {chr(98 + i) * 13} and so on") for i in range(20)]
    mixed = [(0, shared[0][1])]
    sample = spark.createDataFrame(clean + copies + shared + mixed, "y int, text string")
    terms = {t for t, _, _ in toxicity.learn_lexicon(sample)}
    assert "zzbadword" in terms and not terms & {"garbled", "poisonous", "surroundings"}


def test_context():
    lexicon = toxicity.Lexicon([("idiot", False, 3.0), ("achlich", True, 2.0)])
    plain, quoted, direct = (lexicon.features(t)[0] for t in ("such an idiot here", 'he wrote "an idiot" there', "you idiot"))
    assert quoted < plain < direct
    assert lexicon.features("")[0] == 0 and lexicon.features("ACHLICHER")[0] > 0
    for right, wrong in (("such an idiot here", "such an idoit here"), ("you idiot", "you idiott"), ("ACHLICHER", "ACHLYCHER")):
        assert 0 < lexicon.features(wrong)[0] < lexicon.features(right)[0]  # letters that changed places are one edit as well
    assert lexicon.features('he wrote "an idiott" there')[0] < lexicon.features("such an idiott here")[0] < lexicon.features("you idiott")[0]


def test_scores_of_misspelled_and_quoted_terms(spark):
    """On a model learnt from the given tables: clean < misspelled < exact, and quoted < plain, for
    every whole term that is long enough; scores against plain sums, hit by hit."""
    folder = "/root/testdata/sf0.01"
    docs = read_table(spark, folder, "documents")
    model = toxicity.fit(docs, read_table(spark, folder, "labels"))
    lexicon = model.lexicon()
    score = lambda t: model.score([lexicon.features(t)])[0]
    assert (model.weights[1:] >= 0).all() and model.weights[1:].max() > 0
    text = "the day was long and {} came by the river in the end"
    clean, terms = score(text.format("xyxyx")), [t for t, begins, _ in model.terms if not begins and len(t) >= 7]
    for term in terms:
        wrong = term[:-2] + "qj"[term[-2] == "q"] + term[-1]
        assert clean < score(text.format(wrong)) <= score(text.format(term)), term
        assert clean < score(f'the day was long and he "{term}" came by the river') < score(text.format(term)), term
    assert terms

    def plainly(t):
        words = [(m.start(), m.group()) for m in toxicity.WORD.finditer(t.lower())]
        most = total = 0.0
        for i, (at, w) in enumerate(words):
            weights = [x for term, begins, x in model.terms if w == term or begins and w.startswith(term)]
            factor = 1.0
            if not weights:
                near = lambda term, begins: any(edits(term, w[:n]) <= 1 for n in (range(len(term) - 1, len(term) + 2) if begins else (len(w),)) if n <= len(w))
                weights = [x for term, begins, x in model.terms if len(term) >= (6 if begins else 5) and len(w) >= 4 and near(term, begins)]
                factor = model.factors[0]
            if not weights:
                continue
            lo, hi = max(0, i - 8), min(len(words), i + 9)
            left, right = t.lower()[words[lo][0] : at], t.lower()[at + len(w) : words[hi - 1][0]]
            around = {x for _, x in words[lo:hi]}
            inside = sum(left.count(q) for q in toxicity.QUOTES) % 2 == 1 and any(q in right for q in toxicity.QUOTES)
            for f, on in zip(model.factors[1:], (inside, around & toxicity.REPORTING, around & toxicity.SECOND), strict=True):
                factor *= f if on else 1.0
            most, total = max(most, factor * max(weights)), total + factor * max(weights)
        return 1 / (1 + np.exp(-(np.array([1, most, np.log1p(total), 10 * total / (len(words) + 20)]) @ model.weights)))

    def edits(a, b):
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            rows.append([i])
            for j, y in enumerate(b, 1):
                swap = rows[i - 2][j - 2] + 1 if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y else 99
                rows[i].append(min(rows[i - 1][j] + 1, rows[i][-1] + 1, rows[i - 1][j - 1] + (x != y), swap))
        return rows[-1][-1]

    rows = docs.where("length(text) < 3000").orderBy("doc_id").limit(60).select("doc_id", "text").collect()
    got = {r["doc_id"]: r["s"] for r in toxicity.with_scores(docs, model, "s").collect()}
    for r in rows:
        assert abs(got[r["doc_id"]] - plainly(r["text"] or "")) < 1e-9, r["doc_id"]


def score_of(rows, labels, column):
    pairs = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = sum(p == y for _, p, y in pairs) / len(pairs)
    pos, neg = [s for s, _, y in pairs if y == 1], [s for s, _, y in pairs if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    return good, auc


@pytest.mark.parametrize("name,column,least", [("op3_toxicity", "toxic", 0.93), ("op10_line_crf", "quality", 0.93)])
def test_held_out(spark, name, column, least):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, folder).collect()
    labels = {r["doc_id"]: r[column] for r in read_table(spark, folder, "labels").collect()}
    good, auc = score_of(rows, labels, column)
    assert len(rows) == read_table(spark, folder, "documents").count()
    assert good >= least and auc >= 0.8 and all(0 <= r["score"] <= 1 for r in rows)


def test_models_on_odd_rows(spark, odd_docs, no_docs):
    labels = read_table(spark, DATA, "labels")
    nothing = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for run in (toxicity.toxicity, linecrf.quality):
        for lab in (labels, nothing, labels.where("false")):
            rows = run(odd_docs, lab).collect()
            assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
        assert run(no_docs, labels).count() == 0


def test_marginals():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        u, t = rng.normal(size=n), rng.normal(size=(2, 2))
        z, good = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(u[i] for i in range(n) if path[i]) + sum(t[a, b] for a, b in itertools.pairwise(path)))
            z += w
            good += w * np.array(path)
        assert np.allclose(linecrf.marginals(u, t), good / z)
        score, trans = u, t
        at = np.full((1, 8), -1)
        at[0, :n] = np.arange(n)
        assert np.allclose(linecrf._expected(at, score, trans)[0][0, :n], good / z)


# ---- URL filter

def rank_by_hand(edges, seed, hosts, rounds=400, d=hostgraph.DAMPING):
    """Plain PageRank; what reaches hosts without out-links goes back to the seeds in every round."""
    out = collections.Counter()
    for a, _, n in edges:
        out[a] += n
    r = {h: seed.get(h, 0.0) for h in hosts}
    for _ in range(rounds):
        lost = sum(v for h, v in r.items() if not out[h])
        new = {h: (1 - d + d * lost) * seed.get(h, 0.0) for h in hosts}
        for a, b, n in edges:
            new[b] += d * r[a] * n / out[a]
        r = new
    return r


def test_host_graph(spark):
    link = lambda *hosts: "".join(f'<a class=x href="http://{h}/p">t</a>' for h in hosts)
    pages = [
        (1, "http://good.org/fr/1", link("fine.com", "bad.net")), (2, "http://bad.net/x", link("farm.com")), (3, "http://farm.com/a?b", link("bad.net", "bad.net")),
        (4, "https://Fine.com/de/", "<a href='/local'>"), (5, "http://x.example.net/en/1#t", None), (6, "http://x.example.net/fr", "<a href=//fine.com/>"), (12, "http://a.example.com/en/", ""), (13, "http://good.org/de/", ""),
        (7, None, link("bad.net")), (8, "nothing", ""), (9, "http://a.example.com/de/q", ""), (10, "http://farm.com/de/", ""), (11, "http://other.io", link("farm.com")),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit("clash")).withColumn("n", F.lit(1))
    got = {r["page_id"]: r for r in hostgraph.judge(df).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in (1, 2, 4, 5, 6, 7, 8, 9)] == [
        ("good.org", "/fr/1", "org/fr/", "allow"), ("bad.net", "/x", "net/", "block"), ("fine.com", "/de/", None, "allow"),
        ("x.example.net", "/en/1", "example.net/en/", "allow"), ("x.example.net", "/fr", "net/", "block"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("a.example.com", "/de/q", "example.com/de/", "block")]
    edges = [("good.org", "fine.com", 1), ("good.org", "bad.net", 1), ("bad.net", "farm.com", 1), ("farm.com", "bad.net", 1), ("x.example.net", "fine.com", 1), ("other.io", "farm.com", 1)]
    hosts = {r["host"] for r in got.values()} | {h for e in edges for h in e[:2]}
    trust = rank_by_hand(edges, {"good.org": 1 / 2, "x.example.net": 1 / 2}, hosts)
    distrust = rank_by_hand([(b, a, n) for a, b, n in edges], {"bad.net": 1 / 3, "x.example.net": 1 / 3, "a.example.com": 1 / 3}, hosts)
    assert abs(sum(trust.values()) - 1) < 1e-9 and abs(sum(distrust.values()) - 1) < 1e-9
    assert got[12]["verdict"] == "block" and got[13]["verdict"] == "allow"  # by their hosts' own seeds
    for i in (3, 4, 11, 12, 13):
        h = got[i]["host"]
        assert abs(got[i]["trust"] - trust.get(h, 0)) < 1e-5 and abs(got[i]["distrust"] - distrust.get(h, 0)) < 1e-5
        bad = distrust.get(h, 0) / max(trust.get(h, 0) + distrust.get(h, 0), 1e-300)
        assert got[i]["verdict"] == ("block" if bad > 0.5 else "allow")
    assert got[11]["verdict"] == "block"
    assert hostgraph.judge(df.where("false")).count() == 0


# ---- WARC

def test_warc(spark, monkeypatch):
    big = "<p>" + "x é" * 200
    rows = [(3, "http://a/", big), (1, "http://b/", big), (2, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "a\r\nb", "\r\n\r\n" * 60), (9, "u", "y" * 400_000), (4, "u", "small")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash")).repartition(2)
    bundles = warc.write_archives(df)
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["intact"]) for r in warc.read_archives(bundles).collect())
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = collections.Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        again = h in first and i != first[h]
        want[(i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[h] if again else None, True)] += 1
    assert got == want
    ids = spark.createDataFrame([(1,), (9,), (2,)], "page_id bigint")
    records = {r["page_id"]: (r["record_type"], bytes(r["payload"])) for r in warc.fetch(bundles, ids).collect()}
    assert records == {1: ("response", big.encode()), 9: ("response", b"y" * 400_000), 2: ("revisit", b"")}
    assert warc.read_archives(warc.write_archives(df.where("false"))).count() == 0


def test_seek_table():
    bundle = warc.Bundle()
    data = [warc.record(i, "u", bytes([65 + i % 20]) * 50_000, "d", 50_000, None) for i in range(30)]
    for i, d in enumerate(data):
        bundle.add(i, d)
    whole = bundle.bytes()
    table = warc.seek_table(whole)
    assert len(table) == len(bundle.frames) > 3
    for i, frame, offset, length in bundle.records:
        assert warc.frame_at(whole, table[frame])[offset : offset + length] == data[i]
    with pytest.raises(ValueError):
        warc.seek_table(whole[:-1] + b"x")
