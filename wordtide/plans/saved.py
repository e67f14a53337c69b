"""Queries over what is saved and read back: archives, bodies, published tables and summaries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from wordtide.operators import freshness, pages, reparse
from wordtide.plans.catalogue import _NAMES, derived_names
from wordtide.plans.registry import query, table
from wordtide.sources import archives, published, scratch

CAPS = archives.Caps(packed=6000, raw=4000, least_rows=20)
#: Names in an archive of the query below.
_PER_ARCHIVE = 40


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of name lists; some are broken, as their number says."""
    for batch in batches:
        out = []
        for number, names in zip(batch.column("number").to_pylist(), batch.column("names").to_pylist(), strict=True):
            held, kind = io.BytesIO(), number % 12
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                text = ("﻿" if number % 2 else "") + "".join(f" {n.upper()}\r\n\n" if number % 3 else f"{n}\n" for n in names)
                z.writestr("domain-names.txt", text.encode() + (b"\xff\xfe\n" if kind == 3 else b"") + (b"x" * 5000 if kind == 4 else b""))
                if kind == 5:
                    z.writestr("more.txt", "x")
            data = held.getvalue()
            if kind == 6:
                data = b"PK" + data[:40]
            if kind == 7:  # the checksum of the list's entry
                at = data.rindex(b"PK\x01\x02") + 16
                data = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
            out.append(data + (b"\0" * 7000 if kind == 8 else b""))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(out, pa.binary())], names=["path", "content"])


def daily_archives(spark, sf_dir):
    """Archives of the derived names, some dozens each, made in Spark."""
    n = derived_names(spark, sf_dir).where("name is not null and name <> ''").withColumn("number", F.floor(F.col("doc_id") / _PER_ARCHIVE))
    g = n.groupBy("number").agg(F.array_sort(F.collect_list("name")).alias("names"))
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("number") % 28).cast("int"))
    g = g.withColumn("path", F.concat(F.lit("/in/"), "number", F.when(F.col("number") % 12 == 9, "-undated").otherwise(F.concat(F.lit("-"), day.cast("string"))), F.lit(".zip")))
    return g.select("number", "path", "names").mapInArrow(_zipped, "path string, content binary").withColumn("length", F.octet_length("content").cast("long"))


def _read_archives(spark, sf_dir):
    return archives.read_archives(daily_archives(spark, sf_dir), CAPS, "2026-01-01", "2026-01-25")


_ARCHIVES = f"""WITH {_NAMES}, a0 AS (SELECT *, floor(doc_id / 40)::BIGINT AS k FROM names WHERE name <> ''),
a1 AS (SELECT k, count(*) AS n, sum(length(name) + CASE WHEN k % 3 <> 0 THEN 4 ELSE 1 END) + CASE WHEN k % 2 = 1 THEN 3 ELSE 0 END AS raw FROM a0 GROUP BY k),
a2 AS (SELECT *, DATE '2026-01-01' + (k % 28)::INT AS day, CASE WHEN k % 12 = 9 THEN 'undated' WHEN k % 28 > 24 THEN 'out_of_window' WHEN k % 12 = 8 THEN 'archive_too_large' WHEN k % 12 = 6 THEN 'not_an_archive'
 WHEN k % 12 = 5 THEN 'unexpected_members' WHEN k % 12 = 4 OR raw > 4000 THEN 'raw_too_large' WHEN k % 12 = 7 THEN 'crc_failed' WHEN k % 12 = 3 THEN 'invalid_utf8' WHEN n < 20 THEN 'too_few_rows' END AS reason FROM a1),
a3 AS (SELECT *, '/in/' || k || CASE WHEN k % 12 = 9 THEN '-undated' ELSE '-' || day::VARCHAR END || '.zip' AS source_path, CASE WHEN k % 12 <> 9 THEN day END AS source_date FROM a2)"""


@query(_ARCHIVES + " SELECT source_path, source_date, reason, CASE WHEN reason IS NULL THEN n ELSE 0 END::BIGINT AS rows, CASE WHEN reason IS NULL THEN (SELECT count(DISTINCT name) FROM a0 WHERE a0.k = a3.k) ELSE 0 END::BIGINT AS unique_names, CASE WHEN reason IS NULL THEN 'ok' ELSE 'error' END AS status FROM a3")
def archive_manifest(spark, sf_dir):
    """Good and broken archives, undated ones and those outside the window."""
    return archives.manifest(_read_archives(spark, sf_dir))


@query(_ARCHIVES + " SELECT source_path, row_number() OVER (PARTITION BY a0.k ORDER BY name) AS line, name FROM a3 JOIN a0 ON a0.k = a3.k WHERE reason IS NULL")
def archive_names(spark, sf_dir):
    return _read_archives(spark, sf_dir).where("reason is null").select("source_path", "line", "name")


#: A gzip file of no bytes: not the body that its name says.
_EMPTY_GZIP = "1f8b08000000000000ff03000000000000000000"


@query("""WITH p AS (SELECT page_id, length(html) AS n, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title FROM pages)
SELECT page_id, array_to_string(CASE WHEN n % 11 = 0 THEN ['missing_body'] WHEN n % 13 = 0 THEN ['hash_mismatch'] WHEN n % 17 = 0 THEN ['length_mismatch'] WHEN n % 19 = 0 THEN ['unreadable_body']
 ELSE list_filter([CASE WHEN n % 7 = 1 AND title <> '' THEN 'title' END, CASE WHEN n % 7 IN (2, 3) THEN 'description' END, CASE WHEN n % 7 = 3 THEN 'h1' END], lambda x: x IS NOT NULL) END, ',') AS problems,
 n % 11 <> 0 AND n % 13 <> 0 AND n % 17 <> 0 AND n % 19 <> 0 AND n % 7 = 4 AS text_varies FROM p""")
def reparse_audit(spark, sf_dir):
    """Pages stored by content in two charsets and read back. Some saved fields were changed after saving, some bodies
    are gone or damaged: the page's length says which."""
    n = F.length("html")
    p = table(spark, sf_dir, "pages").select("page_id", "html", n.alias("n"), pages.page_fields("html").alias("f"))
    body = F.when(n % 5 == 0, F.encode("html", "UTF-16")).otherwise(F.encode("html", "UTF-8"))
    p = p.select("page_id", "n", "f.*", body.alias("body"), F.when((n % 2 == 0) & (n % 5 != 0), "text/html; charset=utf-8").alias("content_type")).withColumn("sha256", F.sha2("body", 256))
    changed = lambda c, on: F.when(on, F.concat(F.lit("changed "), c)).otherwise(F.col(c))
    rest = F.col("n") % 7
    saved = p.select(
        "page_id", "sha256", "content_type", F.when(rest == 1, F.lit("")).otherwise(F.col("title")).alias("title"), changed("description", rest.isin(2, 3)).alias("description"), "og_description",
        F.when(rest == 3, F.array_append("h1", F.lit("new"))).otherwise(F.col("h1")).alias("h1"), changed("visible_text", rest == 4).alias("visible_text"),
    )
    store = scratch.written(reparse.stored_bodies(p.where("n % 11 <> 0")), "bodies")
    kinds = p.select("sha256", "n").distinct()
    damaged = store.join(kinds, "sha256").select(
        "sha256", F.when(F.col("n") % 221 == 0, F.col("bytes")).when(F.col("n") % 17 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"),
        F.when(F.col("n") % 13 == 0, F.unhex(F.lit(_EMPTY_GZIP))).when((F.col("n") % 19 == 0) & (F.col("n") % 17 != 0), F.lit(b"no gzip")).otherwise(F.col("packed")).alias("packed"),
    )
    found = reparse.reparse_problems(saved, damaged, "page_id")
    return found.select("page_id", F.array_join("problems", ",").alias("problems"), "text_varies")


@query("""WITH t(name, published_rows, recomputed_rows, missing, surplus) AS (
 SELECT 'orders_by_customer', n, n, 0, 0 FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders)
 UNION ALL SELECT 'events_by_type', (SELECT count(DISTINCT event_type) FROM events WHERE event_id % 100 <> 0), (SELECT count(DISTINCT event_type) FROM events), d, d FROM (SELECT count(*) AS d FROM (SELECT event_type, count(*) AS a, count(*) FILTER (WHERE event_id % 100 <> 0) AS b FROM events GROUP BY 1) WHERE a <> b)
 UNION ALL SELECT 'part_names', (SELECT count(*) FROM part WHERE p_size > 1), (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE p_size <= 1), 0)
SELECT name, published_rows::BIGINT AS published_rows, recomputed_rows::BIGINT AS recomputed_rows, missing + surplus = 0 AS fresh, missing::BIGINT AS missing, surplus::BIGINT AS surplus FROM t""")
def snapshot_freshness(spark, sf_dir):
    """Published tables against what their sources give now: one is as it was, one has old counts, one lacks rows."""
    orders, events, part = (table(spark, sf_dir, t) for t in ("orders", "events", "part"))
    by_customer = orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    by_type = lambda e: e.groupBy("event_type").agg(F.count("*").alias("n"))
    names = part.select("p_partkey", "p_name", "p_size")
    saved = {"orders_by_customer": by_customer.select("total", "o_custkey", "orders").orderBy("total"), "events_by_type": by_type(events.where("event_id % 100 <> 0")), "part_names": names.where("p_size > 1")}
    fresh = {"orders_by_customer": by_customer, "events_by_type": by_type(events), "part_names": names}
    for name, df in saved.items():
        published.publish(df, root := scratch.new_path(spark, name))
        saved[name] = published.current(spark, root)
    return freshness.stale({name: (saved[name], fresh[name]) for name in saved})


@query("""WITH s AS (SELECT lang AS value, count(*) FILTER (WHERE length(text) % 50 <> 0) AS saved, count(*) AS counted FROM documents GROUP BY 1), x AS (SELECT value, nullif(saved, 0)::BIGINT AS saved, counted::BIGINT AS counted FROM s UNION ALL SELECT 'none', 7, NULL)
SELECT * FROM x WHERE saved IS DISTINCT FROM counted""")
def summary_problems(spark, sf_dir):
    """A saved summary of languages that leaves out some documents and names one language too many."""
    d = table(spark, sf_dir, "documents")
    saved = d.where("length(text) % 50 <> 0").groupBy(F.col("lang").alias("value")).agg(F.count("*").alias("n"))
    return freshness.histogram_problems(d, "lang", saved.unionByName(spark.createDataFrame([("none", 7)], "value string, n bigint")))


@query("SELECT n_nationkey, n_name || ' ' || (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)::VARCHAR AS n_name FROM nation")
def replaced_table(spark, sf_dir):
    """A table published, then replaced by one that is made of it."""
    root = scratch.new_path(spark, "nations")
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").count()
    published.publish(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), root)
    old = published.current(spark, root)
    published.publish(old.join(counts, old["n_nationkey"] == counts["c_nationkey"], "left").select("n_nationkey", F.concat_ws(" ", "n_name", F.coalesce("count", F.lit(0)).cast("string")).alias("n_name")), root)
    return published.current(spark, root)
