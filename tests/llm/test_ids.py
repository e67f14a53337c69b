"""Ids beyond 2^53, null and repeated, through every operator; extra and clashing columns, empty tables."""

import pytest
from pyspark.sql import functions as F

from wordtide.llm import blob_ledger, bpe, fingerprint, hostgraph, lattice, linecrf, mixing, ordered_minhash, periodic, pii, toxicity, warc, whitening
from wordtide.llm.queries import PATTERN, VOCABULARY

IDS = [9007199254740993, 1152921504606846979, None, 9007199254740995, 1152921504606846979, 5, -9007199254740993]
SEEN = sorted(IDS, key=str)
CLASH = "length int, key string, n int, rep bigint, h string, blob string, salt int"


@pytest.fixture(scope="module")
def docs(spark):
    text = lambda k: f"shop number {k} sells very good shoes and boots, mail k{k}@x.example.com now\ntoken = \"abc{k}def\" " + "on and " * 14
    rows = [(i, text(9 if k in (1, 4) else k), "en", "s", 1, "k", 2, 3, "h", "b", 4) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {CLASH}")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, k % 2, k % 2) for k, i in enumerate(range(60))] + [(None, 1, 1), (9007199254740993, None, None), (5, 1, 0), (5, 0, 1)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, quality int, toxic int, text string, score int")


@pytest.fixture(scope="module")
def trained(spark, docs):
    more = [(i, ("good clean words about the garden\nand the house" if i % 2 else "you stupid idiot junk junk\nbuy buy buy") + f" {i}") for i in range(60)]
    return docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=str)


@pytest.mark.parametrize("name", ["bpe", "bpe_chunks", "bpe_ids", "mixing", "pii", "fingerprint", "minhash", "ledger", "runs"])
def test_document_ids(docs, name):
    run = {
        "bpe": lambda d: bpe.encode(d, VOCABULARY, PATTERN), "bpe_chunks": lambda d: bpe.encode(d, VOCABULARY, PATTERN, 40, 20),
        "bpe_ids": lambda d: bpe.decode_ids(bpe.encode_ids(d, VOCABULARY, PATTERN), VOCABULARY, PATTERN), "mixing": mixing.mix, "pii": pii.find, "fingerprint": fingerprint.compare,
        "minhash": ordered_minhash.classes, "ledger": blob_ledger.find, "runs": lambda d: periodic.digests(periodic.find(periodic.with_planted_runs(d))),
    }[name]
    assert ids(run(docs)) == SEEN
    assert run(docs.where("false")).count() == 0


def test_ids_of_classes(docs):
    same = docs.withColumn("text", F.lit("one text that all documents share, word for word"))
    got = {(r["doc_id"], r["class_id"]) for r in ordered_minhash.classes(same).collect()}
    assert got == {(i, None if i is None else -9007199254740993) for i in IDS}


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_ids_and_labels_of_classifiers(trained, labels, name):
    run = {"toxicity": toxicity.toxicity, "quality": linecrf.quality}[name]
    assert ids(run(trained, labels)) == sorted([*IDS, *range(60)], key=str)
    assert ids(run(trained, labels.where("false"))) == sorted([*IDS, *range(60)], key=str)


@pytest.fixture(scope="module")
def pages(spark):
    body = "<html>" + "x" * 200 + "</html>"
    rows = [(i, f"http://a.example.org/{k}\n x  y" if k else None, body if k in (0, 1, 3, 5) else (None if k == 2 else f"<p>{k}"), 1, "d") for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, size int, digest string")


def test_page_ids(pages):
    bundles = warc.write_archives(pages)
    got = warc.read_archives(bundles).collect()
    assert sorted((r["page_id"] for r in got), key=str) == SEEN and all(r["intact"] for r in got)
    refers = {r["page_id"]: r["refers_to"] for r in got if r["record_type"] == "revisit"}
    assert refers == {9007199254740993: 5, 1152921504606846979: 5, 9007199254740995: 5}
    assert "http://a.example.org/1%0A x  y" in {r["url"] for r in got}
    found = warc.fetch(bundles, pages.where("page_id = 9007199254740995").select("page_id")).collect()
    assert [(r["page_id"], r["record_type"]) for r in found] == [(9007199254740995, "revisit")]
    assert ids(hostgraph.judge(pages), "page_id") == SEEN and hostgraph.judge(pages.where("false")).count() == 0


def test_warc_heads():
    raw = warc.record(2**53 + 1, "http://x/ a\r\nb", b"body", "d" * 64, 4, None) + warc.record(7, None, b"body", "d" * 64, 4, 2**53 + 1)
    (one, body, _, _), (two, nothing, _, _) = warc.parse_records(raw)
    assert body == b"body" and nothing == b""
    assert one["WARC-Record-ID"] == "<urn:page:9007199254740993>" and one["WARC-Target-URI"] == "http://x/ a%0D%0Ab" and one["Content-Length"] == "4"
    assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(one) & set(two)
    assert two["WARC-Refers-To"] == one["WARC-Record-ID"] and two["WARC-Profile"].endswith("/identical-payload-digest") and "WARC-Profile" not in one


def test_vector_ids(spark):
    rows = [(i, [1.0, 0.1 * (k % 2), 0.0, 0.0, 0.5, 0.0, 0.0, 0.2], 1, 2) for k, i in enumerate(IDS)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, n int")
    got = lattice.link(df).collect()
    assert sorted((r["vec_id"] for r in got), key=str) == SEEN
    assert {r["component_id"] for r in got if r["vec_id"] is not None} == {-9007199254740993}
    assert {r["vec_id"] for r in whitening.whiten(df).collect()} == set(IDS)
