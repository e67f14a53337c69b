"""Corrections, freshness, published tables, archives, bodies and resumable logs on small rows."""

import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from wordtide.functions import vocab as V
from wordtide.operators import corrections, freshness, reparse
from wordtide.sources import archives, published
from wordtide.streaming import logs

# --- corrections


def test_heading_review(spark):
    cases = [
        ("Security Check", [], ("recheck", "review_challenge", "title")), (" Coming soon!!! ", ["Domain Parking"], ("skip", "review_placeholder", "title")),
        ("A shop", ["my-shop.co.uk is for sale | Broker"], ("skip", "review_parking", "h1")), ("Our coming soon page", ["Security check for all"], None),
        ("Logo maker – coming soon", None, ("skip", "review_placeholder", "title")), (None, ["Robot or human?"], ("recheck", "review_challenge", "h1")), (None, None, None), ("", [None, ""], None),
        ("webcake | chưa xuất bản", [], ("skip", "review_placeholder", "title")), ("x.com for sale", ["Client challenge"], ("skip", "review_parking", "title")),
    ]
    df = spark.createDataFrame([(i, t, h) for i, (t, h, _) in enumerate(cases)], "i int, title string, h1 array<string>")
    got = df.select("i", corrections.heading_review(F.col("title"), F.col("h1")).alias("r")).orderBy("i").collect()
    assert [None if g["r"] is None else (g["r"]["decision"], g["r"]["reason"], g["r"]["field"]) for g in got] == [w for _, _, w in cases]


def test_overlay_takes_the_last_version_of_each_field(spark):
    rows = spark.createDataFrame([("a", "pass", 1, "x"), ("b", "pass", 2, None), ("c", None, None, "z"), (None, "skip", 3, "n"), ("a", "recheck", 9, "x")], "k string, decision string, size int, corrections_of string")
    ledger = spark.createDataFrame(
        [("a", 1, "decision", "skip", "m"), ("a", 3, "decision", "recheck", "m"), ("a", 2, "decision", "old", "z"), ("a", 5, "size", "7", "n"), ("b", 1, "decision", "skip", "m"), ("b", 2, "decision", None, "m"),
         ("c", 1, "decision", "p", "a"), ("c", 1, "decision", "q", "b"), ("c", 1, "unknown", "q", "b"), ("zz", 1, "decision", "q", "b"), (None, 1, "decision", "q", "b")],
        "k string, version bigint, field string, value string, origin string",
    )
    got = {(r["k"], r["original_decision"]): r for r in corrections.overlay(rows, ledger, "k", ("decision", "size")).collect()}
    assert len(got) == 5
    assert (got["a", "pass"]["decision"], got["a", "pass"]["size"], got["a", "pass"]["original_size"]) == ("recheck", 7, 1)
    assert [tuple(p) for p in got["a", "pass"]["provenance"]] == [("decision", 3, "m"), ("size", 5, "n")]
    assert got["b", "pass"]["decision"] == "pass" and got["b", "pass"]["provenance"] == []  # taken back
    assert got["c", None]["decision"] == "q" and [p["field"] for p in got["c", None]["provenance"]] == ["decision"]
    assert got[None, "skip"]["decision"] == "skip" and got["a", "recheck"]["size"] == 7
    cells = {(r["original"], r["corrected"]): (r["n"], r["original_total"], r["corrected_total"]) for r in corrections.contingency(corrections.overlay(rows, ledger, "k", ("decision", "size")), "decision").collect()}
    assert cells == {("pass", "recheck"): (1, 2, 2), ("recheck", "recheck"): (1, 1, 2), ("pass", "pass"): (1, 2, 1), (None, "q"): (1, 1, 1), ("skip", "skip"): (1, 1, 1)}
    assert corrections.overlay(rows, ledger.where("false"), "k", ("decision",)).where("size(provenance) > 0").count() == 0
    assert corrections.overlay(rows.where("false"), ledger, "k", ("decision",)).count() == 0


def test_expansion_index(spark):
    rows = spark.createDataFrame(
        [
            ("a.com", 1, "pass", "html_with_content", False, "Logo Maker", ["Logo  maker", "logo MAKER"], "Sign in to our shop"), ("b.com", 2, "recheck", "thin_or_empty", False, "logo maker", [], "Tiny heading"),
            ("c.com", 3, "skip", "parking_page", False, "Unused phrase here", [], ""), ("d.com", 4, "pass", "html_with_content", True, "Half a page", None, None), ("d.com", 4, "pass", "html_with_content", True, "Half a page", None, None),
            ("e.com", 5, "recheck", "http_blocked", None, None, None, None), ("f.com", 6, "pass", "html_with_content", None, "one", [], ""),
        ],
        "domain string, row_order int, decision string, reason string, incomplete boolean, title string, h1 array<string>, description string",
    )
    fields = (("title", "title"), ("h1", "h1"), ("description", "description"))
    evidence = corrections.field_evidence(rows, fields)
    prior = spark.createDataFrame([(" HALF a  page ",)], "keyword string")
    got = {r["term"]: r for r in corrections.expansion_index(evidence, prior, examples=2).collect()}
    assert set(got) == {"logo maker", "sign in to our shop", "tiny heading", "half a page"}
    logo = got["logo maker"]
    assert (logo["keyword"], logo["evidence"], logo["domains"], logo["review_status"], logo["is_new"]) == ("logo maker", 4, 2, "ready_for_semantic_review", True)
    assert [(e["domain"], e["field"], e["quote"]) for e in logo["first_evidence"]] == [("a.com", "title", "Logo Maker"), ("a.com", "h1", "Logo  maker")]
    assert got["sign in to our shop"]["review_status"] == "phrase_review"
    assert got["tiny heading"]["review_status"] == got["half a page"]["review_status"] == "metadata_only"
    assert got["half a page"]["evidence"] == 1 and not got["half a page"]["is_new"]
    status = {(r["domain"], r["keywords"], r["keyword_status"]) for r in corrections.page_keywords(rows, evidence, fields).collect()}
    assert status == {("a.com", 2, "literal_candidates"), ("b.com", 2, "literal_candidates"), ("c.com", 0, "no_usable_page_fields"), ("d.com", 1, "literal_candidates"), ("e.com", 0, "no_usable_page_fields"), ("f.com", 0, "needs_semantic_review")}
    assert corrections.expansion_index(evidence.where("false"), prior).count() == 0
    assert "online presence" in V.GENERIC_TERMS


# --- freshness


def test_digests_and_differences(spark):
    a = spark.createDataFrame([(1, "x", 0.5), (2, None, None), (2, None, None)], "k int, s string, v double")
    one = lambda df: tuple(freshness.digest(df).first())
    assert one(a) == one(a.orderBy("s").select("v", "s", "k").repartition(3)) and one(a)[0] == 3
    assert one(a) != one(a.dropDuplicates()) and one(a) != one(a.withColumn("s", F.lit(None).cast("string"))) and one(a.where("false"))[0] == 0
    swapped = spark.createDataFrame([(1, 2), (2, 1)], "k int, v int")
    assert one(swapped) != one(spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"))
    got = {tuple(r) for r in freshness.differences(a, a.dropDuplicates()).collect()}
    assert got == {(2, None, None, 2, 1)}
    rows = {r["name"]: tuple(r)[1:] for r in freshness.stale({"same": (a, a), "short": (a.dropDuplicates(), a), "columns": (a.drop("v"), a)}).collect()}
    assert rows == {"same": (3, 3, True, 0, 0), "short": (2, 3, False, 1, 0), "columns": (3, 3, False, 0, 0)}
    with pytest.raises(ValueError, match="different columns"):
        freshness.differences(a, a.drop("v"))
    problems = freshness.histogram_problems(a, "s", spark.createDataFrame([("x", 1), (None, 3), ("gone", 2)], "value string, n bigint"))
    assert {tuple(r) for r in problems.collect()} == {(None, 3, 2), ("gone", 2, None)}


# --- published tables


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        published.current(spark, root)
    published.publish(spark.range(3), root)
    assert published.current(spark, root).count() == 3
    # killed between writing and switching
    with monkeypatch.context() as m:
        m.setattr(published, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            published.publish(spark.range(5), root)
    assert published.current(spark, root).count() == 3
    # a task that fails while writing
    with pytest.raises(Exception, match="broken"):
        published.publish(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), root)
    before = published.current(spark, root)
    assert before.count() == 3
    published.publish(before.unionByName(spark.range(10, 12)), root)  # made of the table that it replaces
    assert published.current(spark, root).count() == 5 and before.count() == 3
    assert published.expire(spark, root, 1) == 3 and published.current(spark, root).count() == 5


# --- archives


def packed(text: bytes, name="domain-names.txt", more=()):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, text)
        for other in more:
            z.writestr(other, "x")
    return held.getvalue()


def test_archives(spark, tmp_path):
    caps = archives.Caps(packed=20_000, raw=50_000, least_rows=3)
    good = packed("﻿ A.com \r\n\r\nb.org\nc.net\rd.io".encode())
    crc = bytearray(good)
    crc[good.rindex(b"PK\x01\x02") + 16] ^= 1
    lying = bytearray(packed(b"a\n" * 40_000))  # more than the list says of its size
    at = bytes(lying).rindex(b"PK\x01\x02") + 24
    lying[at : at + 4] = (100).to_bytes(4, "little")
    files = {
        "2026-01-01.zip": good, "2026-01-02.zip": bytes(crc), "2026-01-03.zip": packed(b"a\nb\n"), "2026-01-04.zip": packed(b"a\nb\nc", more=["x"]), "2026-01-05.zip": packed(b"a\nb\nc", name="other"),
        "2026-01-06.zip": packed(b"a\n" * 30_000), "2026-01-07.zip": bytes(lying), "2026-01-08.zip": b"P", "2026-01-09.zip": b"no archive", "2026-01-10.zip": good[:-30], "2026-01-11.zip": packed(b"a\nb\n\xff\xfe\nc"),
        "2026-01-12.zip": good + b"\0" * 20_000, "names.zip": good, "2026-02-30.zip": good, "2026-03-01.zip": good, "2026-01-13.zip": packed(b"x" * 30_000 + b"\ny\nz\n"),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    lines = archives.read_archives(archives.archive_files(spark, str(tmp_path)), caps, "2026-01-01", "2026-01-31")
    got = {r["source_path"].rsplit("/", 1)[1]: r for r in archives.manifest(lines).collect()}
    assert len(got) == len(files)
    assert {k: r["reason"] for k, r in got.items()} == {
        "2026-01-01.zip": None, "2026-01-02.zip": "crc_failed", "2026-01-03.zip": "too_few_rows", "2026-01-04.zip": "unexpected_members", "2026-01-05.zip": "unexpected_members", "2026-01-06.zip": "raw_too_large",
        "2026-01-07.zip": got["2026-01-07.zip"]["reason"], "2026-01-08.zip": "not_an_archive", "2026-01-09.zip": "not_an_archive", "2026-01-10.zip": "not_an_archive", "2026-01-11.zip": "invalid_utf8",
        "2026-01-12.zip": "archive_too_large", "names.zip": "undated", "2026-02-30.zip": "undated", "2026-03-01.zip": "out_of_window", "2026-01-13.zip": None,
    }
    assert got["2026-01-07.zip"]["reason"] in ("raw_too_large", "crc_failed")
    assert [(r["line"], r["name"]) for r in lines.where("source_path like '%2026-01-01.zip'").orderBy("line").collect()] == [(1, "a.com"), (2, "b.org"), (3, "c.net"), (4, "d.io")]
    free = archives.read_archives(archives.archive_files(spark, str(tmp_path)), caps)
    assert free.where("source_path like '%names.zip' and reason is null").count() == 4


# --- bodies


def test_reparse(spark):
    page = "<html><title>T é</title><meta name=description content='D'><h1>One</h1><p>text here</p></html>"
    bodies = {"utf": page.encode(), "latin": page.encode("latin-1"), "none": b""}
    sha = {k: hashlib.sha256(b).hexdigest() for k, b in bodies.items()}
    store = reparse.stored_bodies(spark.createDataFrame([(b,) for b in bodies.values()] * 3 + [(None,)], "body binary"))
    assert store.count() == 3 and {gzip.decompress(r["packed"]) for r in store.collect()} == set(bodies.values())
    text = reparse.pages.read_fields(page)["visible_text"]
    full = ("T é", "D", "", ["One"], text)
    rows = [
        ("same", sha["utf"], "text/html; charset=utf-8", *full), ("latin", sha["latin"], "text/html; charset=iso-8859-1", *full), ("copy", sha["utf"], "text/html; charset=utf-8", *full), ("guess", sha["utf"], None, *full),
        ("title", sha["utf"], None, "T", "D", None, ["One"], text), ("h1", sha["utf"], None, "T é", "D", None, ["One", "Two"], text), ("text", sha["utf"], None, "T é", "D", "", ["One"], "other"),
        ("gone", "0" * 64, None, *full), ("bare", None, None, None, None, None, None, None), ("lost", None, None, "T", None, None, [], ""), ("empty", sha["none"], None, "", "", "", [], ""),
    ]
    df = spark.createDataFrame(rows, "domain string, sha256 string, content_type string, title string, description string, og_description string, h1 array<string>, visible_text string")
    got = {r["domain"]: r for r in reparse.reparse_problems(df, store).collect()}
    assert len(got) == len(rows)
    assert {k: r["problems"] for k, r in got.items()} == {
        "same": [], "latin": [], "copy": [], "guess": [], "title": ["title"], "h1": ["h1"], "text": [], "gone": ["missing_body"], "bare": [], "lost": ["missing_body"], "empty": [],
    }
    assert [k for k, r in got.items() if r["text_varies"]] == ["text"] and got["text"]["saved_characters"] == 5 and got["text"]["parsed_characters"] == len(text)
    broken = store.select("sha256", (F.col("bytes") + 1).alias("bytes"), "packed")
    assert {tuple(r["problems"]) for r in reparse.reparse_problems(df.where("domain = 'same'"), broken).collect()} == {("length_mismatch",)}
    assert reparse.reparse_problems(df.where("false"), store).count() == 0


# --- resumable logs


def test_a_log_goes_on_and_keeps_its_manifest(spark, tmp_path):
    root, schema = f"{tmp_path}/run", "k string, v int, stop boolean"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    queue, policy = spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), {"timeout": 5, "retries": [1, 2]}
    stream = lambda: logs.read_stream(spark, f"{tmp_path}/in", schema)
    write([("a", 1, False), ("a", 2, False), (None, 9, False)])
    logs.resume(stream(), queue, policy, "k", root).awaitTermination(60)
    write([("b", 3, False), ("a", 4, False)])
    q = logs.resume(stream(), queue.orderBy(F.desc("k")), {"retries": [1, 2], "timeout": 5}, "k", root)
    q.awaitTermination(60)
    log = spark.read.parquet(f"{root}/log")
    assert sorted(r["k"] for r in log.collect()) == ["a", "b"]
    assert logs.progress(q)["state_rows"] == 0  # what is written is looked up in the log, so no state grows
    with pytest.raises(ValueError, match="policy has changed"):
        logs.resume(stream(), queue, {"timeout": 6}, "k", root)
    with pytest.raises(ValueError, match="queue has changed"):
        logs.resume(stream(), queue.where("k <> 'c'"), policy, "k", root)
    write([("c", 5, True)])
    logs.resume(stream(), queue, policy, "k", root, "stop").awaitTermination(60)
    with pytest.raises(ValueError, match="stopped"):
        logs.resume(stream(), queue, policy, "k", root, "stop")
    # a batch that was half written is written anew, not twice
    part = sorted(r["batch"] for r in spark.read.parquet(f"{root}/log").select("batch").distinct().collect())[-1]
    logs.append_once(stream(), "k", f"{root}/log", f"{tmp_path}/other").awaitTermination(60)
    assert spark.read.parquet(f"{root}/log").groupBy("k").count().where("count > 1").count() == 0 and part >= 1
