"""Queries on scopes of queries and searches, and on terms with what belongs to them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordtide.operators import scopes
from wordtide.plans.catalogue import _EVID, _NAMES, derived_names, evidence
from wordtide.plans.registry import query, table


@query("SELECT o_orderkey, (o_orderdate::DATE - 30)::DATE AS first, (o_orderdate::DATE - 1)::DATE AS last FROM orders")
def next_windows(spark, sf_dir):
    w = scopes.next_window(F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", w["first"].alias("first"), w["last"].alias("last"))


@query("""WITH e AS (SELECT event_id, floor(value)::BIGINT AS v FROM events) SELECT event_id, array_to_string(list_filter([CASE WHEN v % 7 = 0 OR v % 23 = 0 THEN 'geo' END, CASE WHEN v % 5 = 0 THEN 'date' END, CASE WHEN v % 17 = 0 THEN 'gprop' END,
 CASE WHEN v % 11 = 0 THEN 'cat' END, CASE WHEN v % 13 = 0 OR v % 19 = 0 THEN 'terms' END], lambda x: x IS NOT NULL), ',') AS problems FROM e""")
def scope_problems(spark, sf_dir):
    """Addresses made of the events; the value says which part is wrong: another or a second place, another day, a property, a category,
    terms encoded twice or in another order. A default category and capitals in terms are right."""
    v = F.floor("value").cast("long")
    day = F.to_date("ts")
    terms = F.array(F.concat(F.col("event_type"), F.lit(" é")), F.concat(F.lit("Ü-"), F.col("user_id").cast("string")))
    said = F.array_join(F.when(v % 19 == 0, F.reverse(terms)).otherwise(F.transform(terms, lambda t: F.upper(t))), ",")
    coded = F.url_encode(said)
    url = F.concat(
        F.lit("https://trends.example/explore?"), F.when(v % 7 == 0, "geo=GB").otherwise("geo=US"), F.when(v % 23 == 0, "&geo=US").otherwise(""), F.lit("&date="),
        F.url_encode(F.concat_ws(" ", F.date_sub(day, 30).cast("string"), F.when(v % 5 == 0, day).otherwise(F.date_sub(day, 1)).cast("string"))),
        F.when(v % 17 == 0, "&gprop=news").otherwise("&gprop="), F.when(v % 11 == 0, "&cat=3").when(v % 2 == 0, "&cat=0").otherwise(""),
        F.lit("&q="), F.when(v % 13 == 0, F.url_encode(coded)).otherwise(coded), F.lit("#x?q=1"),
    )
    w = scopes.next_window(day)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(scopes.scope_problems(url, terms, w["first"], w["last"]), ",").alias("problems"))


@query("""SELECT d.doc_id FROM (SELECT doc_id, list_transform(string_split(text, ' '), lambda w: lower(w)) AS ws, source, lang FROM documents) d JOIN labels l ON d.doc_id = l.doc_id
 WHERE l.quality = 1 AND (contains(lower(source), 'ther') OR contains(lower(lang), 'ther') OR list_bool_or(list_transform(ws, lambda w: contains(w, 'ther'))))""")
def domain_search(spark, sf_dir):
    """Documents as domains, their labels as registration."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("domain"), F.col("lang").alias("title"), F.split("text", " ").alias("keywords"))
    rows = d.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("registration", F.when(F.col("quality") == 1, "verified_recent").otherwise("unknown"))
    return scopes.domain_search(rows, "THER", "verified_recent").select("doc_id")


_SCOPED = f"""WITH {_NAMES}, b AS (SELECT n.doc_id, d.lang AS verdict FROM names n JOIN documents d ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l ON l.doc_id = n.doc_id
 WHERE coalesce(l.toxic, 0) <> 1 AND n.tld = 'com' AND contains(lower(concat_ws(' ', n.domain, d.lang, d.source)), 'en'))"""


def _base(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    toxic = table(spark, sf_dir, "labels").groupBy("doc_id").agg((F.max("toxic") == 1).alias("excluded"))
    rows = derived_names(spark, sf_dir).join(d, "doc_id").join(toxic, "doc_id", "left")
    rows = rows.select("doc_id", F.col("tld").alias("channel"), F.col("lang").alias("verdict"), "excluded", F.concat_ws(" ", "domain", "lang", "source").alias("search"))
    return scopes.scoped(rows, " EN", "research", "com")


@query(_SCOPED + " SELECT verdict, count(*)::BIGINT AS n FROM b GROUP BY 1 UNION ALL SELECT 'all', count(*)::BIGINT FROM b")
def verdict_facets(spark, sf_dir):
    return scopes.verdict_facets(_base(spark, sf_dir))


@query(_SCOPED + " SELECT doc_id FROM b WHERE verdict = 'de'")
def scoped_rows(spark, sf_dir):
    return scopes.of_verdict(_base(spark, sf_dir), "de").select("doc_id")


_BACK = "WITH b AS (SELECT lower(trim(n_name)) AS k, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000)"


@query(_BACK + " SELECT n_name AS keyword, c_custkey, c_acctbal FROM nation LEFT JOIN (SELECT k, arg_max(c_custkey, (c_acctbal, c_custkey)) AS c_custkey, max(c_acctbal) AS c_acctbal FROM b GROUP BY 1) ON k = lower(trim(n_name))")
def term_backgrounds(spark, sf_dir):
    """Nations as terms, their customers of some balance as backgrounds."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    b = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.concat(F.lit(" "), F.lower("n_name")).alias("keyword"), "c_custkey", "c_acctbal")
    out = scopes.with_background(n.select(F.col("n_name").alias("keyword")), b, "c_acctbal", "c_custkey")
    return out.select("keyword", "background.c_custkey", "background.c_acctbal")


@query("WITH s AS (SELECT user_id, bool_or(event_type = 'view' AND value > 60) AS seen FROM events GROUP BY 1) SELECT (count(*) FILTER (WHERE seen))::BIGINT AS recorded, (count(*) FILTER (WHERE NOT seen))::BIGINT AS not_recorded FROM s")
def stage_totals(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return scopes.stage_totals(e.select("user_id", F.when((F.col("event_type") == "view") & (F.col("value") > 60), "homepage").alias("stage")), "user_id")


@query(_EVID + """, s AS (SELECT DISTINCT term, domain, length(term) % 2 = 0 AS queried FROM e) SELECT count(DISTINCT domain)::BIGINT AS domains_with_terms, count(*)::BIGINT AS pairs, count(DISTINCT term)::BIGINT AS terms,
 (count(DISTINCT domain) FILTER (WHERE queried))::BIGINT AS queried_domains, (count(DISTINCT term) FILTER (WHERE queried))::BIGINT AS queried_terms FROM s""")
def source_totals(spark, sf_dir):
    return scopes.source_totals(evidence(spark, sf_dir).withColumn("queried", F.length("term") % 2 == 0))
