"""The catalogue: one query per operator over the given tables, each with its SQL in DuckDB.

Derived inputs, the same in both languages: a *name* is the first two ASCII words of a document, joined
(with a hyphen or digits for some ids), a *domain* is a name and a suffix by id. Corpus vocabularies
stand in for the English word lists, which hardly occur in invented prose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.functions import vocab as V
from wordtide.operators import audit, ledger, lookups, matching, names, pages, phrases, sampling, series
from wordtide.plans.registry import ORACLE_SQL, QUERIES, query, table  # noqa: F401  the registry, by either name
from wordtide.streaming import logs, pacing

FLAGSHIP = "growth_rule_by_user"

LEGACY = ("and", "tion", "ver")
EXTRA = ("ment", "heit", "the")
CORPUS_ROOTS = ("tion", "ther", "and", "the", "en", "her", "ment", "keit", "que", "sch")
BROAD = ("en", "the")
TLDS = ("com", "net", "org", "ai", "io", "co", "xyz")
SEED = T.SEED


# ---- derived inputs -------------------------------------------------------------------------

PAIR = r"([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)"


def derived_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, name, tld, domain."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = F.lower(F.regexp_extract("text", PAIR, 1)), F.lower(F.regexp_extract("text", PAIR, 2))
    joined = (
        F.when(F.col("doc_id") % 11 == 0, F.concat(a, F.lit("-"), b))
        .when(F.col("doc_id") % 13 == 0, F.concat(a, (F.col("doc_id") % 10000).cast("string")))
        .otherwise(F.concat(a, b))
    )
    tld = F.get(T.strings(TLDS), (F.col("doc_id") % 7).cast("int"))
    return d.select("doc_id", joined.alias("name"), tld.alias("tld")).withColumn("domain", F.concat_ws(".", "name", "tld"))


_NAMES = (
    "names AS (SELECT doc_id, name, tld, name || '.' || tld AS domain FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN a || '-' || b "
    "WHEN doc_id % 13 = 0 THEN a || (doc_id % 10000)::VARCHAR ELSE a || b END AS name, ['com','net','org','ai','io','co','xyz'][(doc_id % 7 + 1)::INT] AS tld "
    "FROM (SELECT doc_id, lower(regexp_extract(text, '([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 1)) AS a, lower(regexp_extract(text, '([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 2)) AS b FROM documents)))"
)
_DAILY = (
    "d0 AS (SELECT {k}, CAST(ts AS DATE) AS day, least(count(*), 100) AS v FROM events GROUP BY ALL), "
    "i0 AS (SELECT {k}, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), day) AS i, v FROM d0), "
    "p AS (SELECT {k}, i, v FROM i0 WHERE i BETWEEN 0 AND 29)"
)


def user_series(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return series.daily_series(table(spark, sf_dir, "events"), list(keys or ("user_id",)))


# ---- time series ----------------------------------------------------------------------------

_GROWTH = """
, g AS (SELECT {k}, sum(v) AS total, sum(CASE WHEN i BETWEEN 16 AND 22 THEN v ELSE 0 END) AS p7, sum(CASE WHEN i >= 23 THEN v ELSE 0 END) AS l7,
  count(*) FILTER (WHERE i >= 23 AND v > 0) AS nz, max(CASE WHEN i >= 23 THEN v END) AS mx, min(i) FILTER (WHERE v > 0) AS first_i FROM p GROUP BY ALL),
r AS (SELECT *, nz >= 5 AND coalesce(mx / nullif(l7, 0)::DOUBLE, 9) <= 0.4::DOUBLE AND (p7 = 0 OR l7 / nullif(p7, 0)::DOUBLE >= 2) AS fits FROM g)
SELECT {k}, CASE WHEN total = 0 THEN 'below_reporting_threshold' WHEN NOT fits THEN 'growth_rule_not_met' WHEN p7 = 0 THEN 'zero_baseline_emerging' ELSE 'rapid_growth' END AS status,
  round(p7 / 7.0::DOUBLE, 6) AS previous7_mean, round(l7 / 7.0::DOUBLE, 6) AS last7_mean, round(l7 / nullif(p7, 0)::DOUBLE, 6) AS ratio, nz::BIGINT AS last7_nonzero_days,
  round(mx / nullif(l7, 0)::DOUBLE, 6) AS last7_largest_day_share,
  ((SELECT min(CAST(ts AS DATE)) FROM events) + first_i::INT)::DATE AS first_nonzero
FROM r
"""


def _growth(spark, sf_dir, *keys):
    r6 = lambda c: F.round(c, 6).alias(c)
    out = series.growth_rule(user_series(spark, sf_dir, *keys))
    return out.select(
        *keys, "status", r6("previous7_mean"), r6("last7_mean"), r6("ratio"), F.col("last7_nonzero_days").cast("long").alias("last7_nonzero_days"),
        r6("last7_largest_day_share"), "first_nonzero",
    )


@query("WITH " + _DAILY.format(k="user_id") + _GROWTH.format(k="user_id"))
def growth_rule_by_user(spark, sf_dir):
    return _growth(spark, sf_dir, "user_id")


@query("WITH " + _DAILY.format(k="user_id, event_type") + _GROWTH.format(k="user_id, event_type"))
def growth_rule_by_user_type(spark, sf_dir):
    return _growth(spark, sf_dir, "user_id", "event_type")


_PERSIST = "WITH " + _DAILY.format(k="user_id") + """
, s AS (SELECT user_id, sum(v) AS total, sum(CASE WHEN i < 16 THEN v ELSE 0 END) AS e, sum(CASE WHEN i BETWEEN 16 AND 22 THEN v ELSE 0 END) AS b,
 sum(CASE WHEN i >= 23 THEN v ELSE 0 END) AS r, sum(CASE WHEN i >= 27 THEN v ELSE 0 END) AS t, sum(CASE WHEN i BETWEEN 23 AND 26 THEN v ELSE 0 END) AS q,
 count(*) FILTER (WHERE v > 0) AS nz, count(*) FILTER (WHERE v > 0 AND i < 16) AS nze, count(*) FILTER (WHERE v > 0 AND i BETWEEN 16 AND 22) AS nzp,
 count(*) FILTER (WHERE v > 0 AND i >= 23) AS nzr, max(v) AS peak, coalesce(max(v) FILTER (WHERE i >= 23), 0) AS rpeak FROM p GROUP BY 1),
u AS (SELECT *, nzp >= 4 AND nzr >= 5 AND r > 0 AND 20 * rpeak <= 7 * r AND 40 * t >= 21 * q AND b > 0 AND 5 * r >= 6 * b AND 40 * r >= 21 * e AS up FROM s)
"""


@query(_PERSIST + """SELECT user_id, CASE WHEN total = 0 THEN 'zero' WHEN nz < 5 OR 2 * peak > total THEN 'sparse' WHEN up AND nze <= 2 THEN 'emerging' WHEN up THEN 'rising'
 WHEN (b > 0 AND 5 * r <= 4 * b) OR (q > 0 AND 40 * t < 21 * q) THEN 'cooling' ELSE 'other' END AS status FROM u""")
def persistence_by_user(spark, sf_dir):
    return series.persistence(user_series(spark, sf_dir)).select("user_id", "status")


@query(_PERSIST + """SELECT user_id, total::BIGINT AS total, e::BIGINT AS early_sum, b::BIGINT AS previous_sum, r::BIGINT AS recent_sum, t::BIGINT AS tail_sum, q::BIGINT AS prior_sum,
 nz::BIGINT AS nonzero_days, round(peak / nullif(total, 0)::DOUBLE, 6) AS peak_share, round(rpeak / nullif(r, 0)::DOUBLE, 6) AS recent_peak_share,
 round(r / nullif(b, 0)::DOUBLE, 6) AS recent_ratio, nze <= 2 AND nzp >= 4 AND nzr >= 5 AS recently_visible FROM u""")
def persistence_metrics(spark, sf_dir):
    s = series.persistence(user_series(spark, sf_dir))
    sums = ("total", "early_sum", "previous_sum", "recent_sum", "tail_sum", "prior_sum")
    return s.select(
        "user_id", *[F.col(c).cast("long").alias(c) for c in sums], F.col("nonzero_days").cast("long").alias("nonzero_days"),
        *[F.round(c, 6).alias(c) for c in ("peak_share", "recent_peak_share", "recent_ratio")], "recently_visible",
    )


@query("""WITH a AS (SELECT min(CAST(ts AS DATE)) AS s FROM events), pts AS (SELECT user_id, CAST(ts AS DATE) AS day, least(count(*), 100) AS v FROM events GROUP BY ALL),
w AS (SELECT user_id, day, v, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS nd, s FROM pts, a),
g AS (SELECT user_id, any_value(s) AS s, min(day) AS f, max(day) AS l, count(*) FILTER (WHERE nd <= s + 23) AS intervals, count(*) FILTER (WHERE nd <= s + 23 AND v > 1) AS nz,
 min(day) FILTER (WHERE nd <= s + 23 AND v > 1) AS fe, count(*) FILTER (WHERE nd - day NOT BETWEEN 1 AND 7) AS bad, count(*) FILTER (WHERE v > 1) AS anynz FROM w GROUP BY 1)
SELECT user_id, CASE WHEN NOT (f <= s + 7 AND l >= s + 22 AND l <= s + 29 AND bad = 0 AND intervals >= 1) THEN 'background_incomplete' WHEN nz > 0 THEN 'earlier_signal_requires_review'
 WHEN anynz = 0 THEN 'background_below_threshold' ELSE 'no_earlier_reported_signal' END AS status, nz::BIGINT AS earlier_nonzero, fe AS first_earlier FROM g""")
def background_by_user(spark, sf_dir):
    """A day counts as a signal from its second event on; the window starts on day 23."""
    e = table(spark, sf_dir, "events")
    first = e.agg(F.min(F.to_date("ts")).alias("s"))
    pts = e.groupBy("user_id", F.to_date("ts").alias("day")).agg((F.least(F.count("*"), F.lit(100)) - 1).alias("value")).withColumn("partial", F.lit(False))
    pts = pts.join(F.broadcast(first))
    out = series.background(pts, ["user_id", "s"], F.date_add("s", 23), F.col("s"), F.date_add("s", 29))
    return out.select("user_id", "status", F.col("earlier_nonzero").cast("long").alias("earlier_nonzero"), "first_earlier")


@query("WITH " + _DAILY.format(k="user_id") + " SELECT user_id, sum(v)::BIGINT AS plain, sum(v * (i + 1))::BIGINT AS weighted FROM p GROUP BY 1")
def series_checksums(spark, sf_dir):
    plain, weighted = series.checksums(F.col("values"))
    return user_series(spark, sf_dir).select("user_id", plain.alias("plain"), weighted.alias("weighted"))


_DENSE = "WITH " + _DAILY.format(k="user_id") + ", x AS (SELECT u.user_id, c.i, coalesce(p.v, 0) AS v FROM (SELECT DISTINCT user_id FROM p) u CROSS JOIN range(30) c(i) LEFT JOIN p ON p.user_id = u.user_id AND p.i = c.i)"


@query(_DENSE + " SELECT user_id, string_agg(v::VARCHAR, ',' ORDER BY i) AS series FROM x GROUP BY 1")
def series_rle_roundtrip(spark, sf_dir):
    """Encoded as runs and decoded again."""
    back = series.rle_decode(series.rle_encode(F.col("values")))
    return user_series(spark, sf_dir).select("user_id", F.array_join(back.cast("array<string>"), ",").alias("series"))


@query(_DENSE + " SELECT user_id, sum(v)::BIGINT AS total, string_agg(v::VARCHAR, ',' ORDER BY i) AS series FROM x GROUP BY 1")
def series_sparse_roundtrip(spark, sf_dir):
    """To a map of non-zero days and back: missing days are observed zeros."""
    s = user_series(spark, sf_dir).withColumn("pairs", F.transform("values", lambda v, i: F.struct(i.alias("i"), v.alias("v"))))
    sparse = s.withColumn("m", F.map_from_entries(F.filter("pairs", lambda p: p["v"] > 0)))
    back = series.dense(F.col("m"))
    return sparse.select("user_id", series.total(back).alias("total"), F.array_join(back.cast("array<string>"), ",").alias("series"))


@query("WITH " + _DAILY.format(k="user_id") + _GROWTH.format(k="user_id").replace("SELECT user_id, CASE", ", o AS (SELECT user_id, CASE", 1).rstrip() + """)
SELECT user_id, CASE WHEN status NOT IN ('rapid_growth', 'zero_baseline_emerging') THEN 'ended_at_chart' WHEN user_id % 3 = 0 THEN 'background' WHEN user_id % 3 = 1 THEN 'ended_at_background' ELSE 'repeat' END AS stage,
 false AS auto_match FROM o""")
def stage_gate(spark, sf_dir):
    """Stages by the growth rule and stand-in backgrounds (missing, failed, passed by id)."""
    g = series.growth_rule(user_series(spark, sf_dir)).select("user_id", "eligible")
    back = F.when(F.col("user_id") % 3 == 1, F.lit(False)).when(F.col("user_id") % 3 == 2, F.lit(True))
    repeat = F.lit(None).cast("boolean")
    return g.select("user_id", series.stage_gate(F.col("eligible"), back, repeat).alias("stage"), series.auto_match(F.col("eligible"), back, repeat).alias("auto_match"))


@query(_DENSE + """ SELECT user_id, round(sum(v) FILTER (WHERE i < 29) / 29.0::DOUBLE, 6) AS mean_value, (count(*) FILTER (WHERE i < 29 AND v > 0))::BIGINT AS nonzero_days,
 round(sum(v) FILTER (WHERE i BETWEEN 15 AND 28) / 14.0::DOUBLE, 6) AS recent14_mean, round(sum(v) FILTER (WHERE i BETWEEN 1 AND 14) / 14.0::DOUBLE, 6) AS previous14_mean FROM x GROUP BY 1""")
def summary_recent14(spark, sf_dir):
    s = series.summary(user_series(spark, sf_dir))
    return s.select("user_id", F.round("mean_value", 6).alias("mean_value"), F.col("nonzero_days").cast("long").alias("nonzero_days"), F.round("recent14_mean", 6).alias("recent14_mean"), F.round("previous14_mean", 6).alias("previous14_mean"))


@query(_DENSE + """, m AS (SELECT user_id, max(v) AS peak FROM x GROUP BY 1)
SELECT user_id, round(sum(v) FILTER (WHERE i >= 26) / 4.0::DOUBLE, 6) AS recent_mean, round(sum(v) FILTER (WHERE i BETWEEN 13 AND 25) / 13.0::DOUBLE, 6) AS before_mean,
 any_value(peak)::BIGINT AS peak, (min(i) FILTER (WHERE v = peak))::INT AS peak_index FROM x JOIN m USING (user_id) GROUP BY 1""")
def recent4_vs_13(spark, sf_dir):
    s = series.recent_against_before(user_series(spark, sf_dir))
    return s.select("user_id", F.round("recent_mean", 6).alias("recent_mean"), F.round("before_mean", 6).alias("before_mean"), F.col("peak").cast("long").alias("peak"), "peak_index")


_CAPTURES = """WITH w AS (SELECT o_orderpriority AS term, (year(o_orderdate))::INT AS capture, month(o_orderdate) AS i, count(*) AS v FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL),
k AS (SELECT DISTINCT term, capture FROM w), x AS (SELECT k.term, k.capture, c.i + 1 AS i, coalesce(w.v, 0) AS v FROM k CROSS JOIN range(12) c(i) LEFT JOIN w ON w.term = k.term AND w.capture = k.capture AND w.i = c.i + 1),
s AS (SELECT term, capture, avg(v) AS m, avg(v) FILTER (WHERE i BETWEEN 2 AND 11) AS inner_m FROM x GROUP BY ALL),
e AS (SELECT t.capture, t.term, a.term AS anchor, t.m AS tm, a.m AS am, 14800 * t.m / nullif(a.m, 0) AS estimate, 14800 * t.inner_m / nullif(a.inner_m, 0) AS edge FROM s t JOIN s a USING (capture) WHERE a.term = '1-URGENT' AND t.term <> a.term)
"""


def yearly_captures(spark, sf_dir):
    """Monthly orders by priority, a capture a year."""
    o = table(spark, sf_dir, "orders").where("o_orderdate is not null")
    c = o.groupBy(F.col("o_orderpriority").alias("term"), F.year("o_orderdate").alias("capture"), (F.month("o_orderdate") - 1).alias("i")).agg(F.count("*").alias("v"))
    m = c.groupBy("term", "capture").agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    return m.select("term", "capture", series.dense(F.col("m"), 12).alias("values"))


def _estimates(spark, sf_dir):
    anchors = spark.createDataFrame([("1-URGENT", 14800)], "term string, volume int")
    return series.anchor_estimates(yearly_captures(spark, sf_dir), anchors)


@query(_CAPTURES + "SELECT capture, term, anchor, round(tm, 4) AS target_mean, round(am, 4) AS anchor_mean, round(estimate, 4) AS estimate, round(edge, 4) AS edge_estimate FROM e")
def anchor_estimates(spark, sf_dir):
    e = _estimates(spark, sf_dir)
    return e.select("capture", "term", "anchor", *[F.round(c, 4).alias(c) for c in ("target_mean", "anchor_mean", "estimate", "edge_estimate")])


@query(_CAPTURES + "SELECT term, round(min(least(estimate, edge)), 4) AS low, round(max(greatest(estimate, edge)), 4) AS high, count(*)::BIGINT AS captures FROM e GROUP BY 1")
def estimate_ranges(spark, sf_dir):
    e = _estimates(spark, sf_dir)
    return e.groupBy("term").agg(F.round(F.min(F.least("estimate", "edge_estimate")), 4).alias("low"), F.round(F.max(F.greatest("estimate", "edge_estimate")), 4).alias("high"), F.count("*").alias("captures"))


@query("WITH " + _DAILY.format(k="user_id") + ", f AS (SELECT user_id, min(i) FILTER (WHERE v > 0) AS first_i FROM p GROUP BY 1) SELECT first_i::INT AS first_index, count(*)::BIGINT AS n FROM f GROUP BY 1")
def first_nonzero_histogram(spark, sf_dir):
    first = F.expr("array_position(transform(values, x -> x > 0), true) - 1").cast("int")
    return user_series(spark, sf_dir).groupBy(first.alias("first_index")).agg(F.count("*").alias("n"))


@query(_DENSE + """, s AS (SELECT user_id, sum(v) AS total, sum(v) FILTER (WHERE i < 16) AS e, sum(v) FILTER (WHERE i >= 16) AS l, min(v) FILTER (WHERE i >= 16) AS ml, min(i) FILTER (WHERE v > 0) AS f FROM x GROUP BY 1)
SELECT (count(*))::BIGINT AS charts, (count(*) FILTER (WHERE total = 0))::BIGINT AS all_zero, (count(*) FILTER (WHERE e = 0 AND l > 0))::BIGINT AS early_zero_late_nonzero,
 (count(*) FILTER (WHERE e = 0 AND ml > 0))::BIGINT AS early_zero_late_all, (count(*) FILTER (WHERE f = 16))::BIGINT AS first_on_boundary FROM s""")
def signal_shape_audit(spark, sf_dir):
    v = F.col("values")
    early, late = series.part(v, 0, 16), series.part(v, 16, 30)
    quiet = series.total(early) == 0
    return user_series(spark, sf_dir).agg(
        F.count("*").alias("charts"), F.count_if(series.total(v) == 0).alias("all_zero"), F.count_if(quiet & (series.total(late) > 0)).alias("early_zero_late_nonzero"),
        F.count_if(quiet & (F.array_min(late) > 0)).alias("early_zero_late_all"), F.count_if(quiet & (F.get(v, F.lit(16)) > 0)).alias("first_on_boundary"),
    )


@query("""WITH c AS (SELECT (user_id % 50)::BIGINT AS capture, min(ts) AS at_ts, list(DISTINCT event_type) AS terms FROM events GROUP BY 1),
e AS (SELECT capture, at_ts, len(terms) > 1 AS many, unnest(terms) AS term FROM c),
s AS (SELECT *, NOT many AND coalesce(max(many::INT) OVER (PARTITION BY term ORDER BY at_ts, capture ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS again FROM e),
k AS (SELECT term, bool_or(many) AS multi, bool_or(NOT many) AS single, bool_or(again) AS recheck FROM s GROUP BY 1)
SELECT count(*) FILTER (WHERE multi) AS multi_terms, count(*) FILTER (WHERE single) AS single_terms, count(*) FILTER (WHERE recheck) AS recheck_terms, count(*) FILTER (WHERE multi AND NOT single) AS comparison_only FROM k""")
def capture_coverage(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    c = e.groupBy((F.col("user_id") % 50).alias("capture")).agg(F.min("ts").alias("at"), F.collect_set("event_type").alias("terms"))
    return audit.capture_coverage(c)


@query("WITH " + _DAILY.format(k="user_id") + ", s AS (SELECT user_id, sum(v) AS total FROM p GROUP BY 1) SELECT user_id, 'checksum' AS problem FROM s WHERE user_id % 5 = 0 AND total > 0")
def series_violations(spark, sf_dir):
    """Saved sums that are off by one for every fifth user must be found."""
    plain, weighted = series.checksums(F.col("values"))
    s = user_series(spark, sf_dir).select("user_id", "values", (plain + F.when(F.col("user_id") % 5 == 0, 1).otherwise(0)).alias("plain"), weighted.alias("weighted"))
    return audit.series_violations(s, "user_id", "values", "plain", "weighted")


# ---- names ----------------------------------------------------------------------------------

_ERROR = (
    "CASE WHEN v IS NULL OR v = '' THEN 'blank_line' WHEN regexp_matches(v, '\\s') THEN 'embedded_whitespace' WHEN regexp_matches(v, '[/:@?#\\\\]') THEN 'not_a_bare_domain' "
    "WHEN regexp_matches(n, '(^|\\.)\\.') OR regexp_matches(n, '[^.]{64}') THEN 'idna_encoding_failed' WHEN length(n) > 253 THEN 'hostname_too_long' WHEN NOT contains(n, '.') THEN 'missing_dot' "
    "WHEN NOT regexp_matches(n, '^[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?(\\.[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?)*$') THEN 'invalid_dns_label' "
    "WHEN NOT regexp_matches(split_part(n, '.', -1), '[a-z]') THEN 'numeric_top_level_label' END"
)
#: Labels beyond ASCII that stand before the hosts of some pages, and their ASCII forms.
_IDN = {"bücher": "xn--bcher-kva", "日本語": "xn--wgv71a119e", "ñandú": "xn--and-6ma2c", "россия": "xn--h1alffa9f", "straßen": "strassen", "münchen-ost": "xn--mnchen-ost-9db"}
_PLANTED = "CASE length(html) % 8 " + " ".join(f"WHEN {i} THEN '{w.upper() if i % 2 else w}.'" for i, w in enumerate(_IDN)) + " ELSE '' END"
_CODED = "CASE " + " ".join(f"WHEN starts_with(v, '{w}.') THEN '{c}.' || substr(v, {len(w) + 2})" for w, c in _IDN.items()) + " ELSE v END"
_RAW = "raw AS (SELECT page_id AS id, " + _PLANTED + " || lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) || CASE WHEN page_id % 5 = 0 THEN '.' ELSE '' END AS raw FROM pages UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents), nr0 AS (SELECT id, raw, lower(trim(raw, chr(10) || chr(13) || chr(9) || ' ')) AS v FROM raw), nrm AS (SELECT *, regexp_replace(" + _CODED + ", '\\.$', '') AS n FROM nr0)"


def raw_lines(spark, sf_dir):
    before = F.lit("")
    for i, word in reversed(list(enumerate(_IDN))):
        before = F.when(F.length("html") % 8 == i, (word.upper() if i % 2 else word) + ".").otherwise(before)
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.concat(before, T.host_of(F.col("url")), F.when(F.col("page_id") % 5 == 0, ".").otherwise("")).alias("raw"))
    return p.unionByName(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(F.split("text", "\n", -1)).alias("raw")))


@query(f"WITH {_RAW} SELECT id, CASE WHEN e IS NULL THEN n END AS domain, e AS reason FROM (SELECT *, {_ERROR} AS e FROM nrm)")
def normalize_domains(spark, sf_dir):
    return raw_lines(spark, sf_dir).select("id", T.domain_of(F.col("raw")).alias("domain"), T.domain_error(F.col("raw")).alias("reason"))


@query(f"WITH {_RAW} SELECT coalesce(e, 'valid') AS reason, count(*)::BIGINT AS n FROM (SELECT *, {_ERROR} AS e FROM nrm) GROUP BY 1")
def invalid_reason_counts(spark, sf_dir):
    return audit.histogram(raw_lines(spark, sf_dir).select(F.coalesce(T.domain_error(F.col("raw")), F.lit("valid")).alias("reason")), "reason")


@query("""WITH h AS (SELECT page_id, lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) AS host FROM pages)
SELECT page_id, split_part(host, '.', 1) AS first_label, split_part(host, '.', -1) AS tld FROM h""")
def first_label_tld(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select("page_id", T.host_of(F.col("url")).alias("host"))
    return h.select("page_id", T.first_label(F.col("host")).alias("first_label"), T.top_label(F.col("host")).alias("tld"))


@query("""WITH h AS (SELECT page_id, lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) AS host FROM pages), d AS (SELECT *, regexp_replace(host, '^(www|m|blog)\\.', '') AS domain FROM h)
SELECT page_id, host <> domain AND host <> 'www.' || domain AS redirected, host <> domain AND NOT ends_with(host, '.' || domain) AS redirected_external FROM d""")
def host_redirect_flags(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select("page_id", T.host_of(F.col("url")).alias("host")).withColumn("domain", F.regexp_replace("host", r"^(www|m|blog)\.", ""))
    a, b = pages.redirected(F.col("host"), F.col("domain"))
    return h.select("page_id", a.alias("redirected"), b.alias("redirected_external"))


@query(f"""WITH h AS (SELECT source, doc_id, sha256('{SEED}' || chr(0) || doc_id::VARCHAR) AS sampling_hash FROM documents)
SELECT source, doc_id, sampling_hash, rn::INT AS rank_within_group FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY sampling_hash, doc_id) AS rn FROM h) WHERE rn <= 5""")
def stable_hash_top_k(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("key"), "doc_id")
    return sampling.top_by_hash(d, "source", "key", 5).select("source", "doc_id", "sampling_hash", "rank_within_group")


@query("""WITH f AS (SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1)
SELECT doc_id, row_number() OVER (ORDER BY doc_id)::BIGINT AS discovery_order FROM f""")
def dedup_first_occurrence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return names.discovery_order(names.first_occurrences(d, "key", ["doc_id"]), ["doc_id"]).select("doc_id", "discovery_order")


@query("SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents WHERE text IS NOT NULL) WHERE doc_id <> first_id")
def duplicate_occurrences(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    first = names.first_occurrences(d, "key", ["doc_id"]).withColumnRenamed("doc_id", "first_id")
    return names.duplicates(d, "key", ["doc_id"]).join(first, "key").select("doc_id", "first_id")


@query(f"""WITH {_NAMES} SELECT doc_id, concat_ws('|', CASE WHEN length(name) >= 34 THEN 'long_name' END, CASE WHEN regexp_matches(name, '[0-9]{{3}}') THEN 'three_digits' END, CASE WHEN starts_with(name, 'xn--') THEN 'encoded' END) AS flags FROM names""")
def name_flags(spark, sf_dir):
    n = derived_names(spark, sf_dir)
    return n.select("doc_id", F.array_join(names.name_flags(F.col("name")), "|").alias("flags"))


@query(f"""WITH {_NAMES}, b AS (SELECT doc_id, name, replace(name, '-', '') AS bare FROM names)
SELECT doc_id, coalesce(regexp_matches(bare, '^[a-z]{{5,20}}$') AND length(regexp_replace(bare, '[^aeiouy]', '', 'g')) / nullif(length(bare), 0)::DOUBLE BETWEEN 0.2::DOUBLE AND 0.7::DOUBLE
 AND NOT regexp_matches(bare, '[^aeiouy]{{5}}') AND NOT regexp_matches(bare, '[aeiouy]{{4}}') AND NOT regexp_matches('-' || name || '-', '-.?-'), false) AS readable FROM b""")
def readable_shape(spark, sf_dir):
    return derived_names(spark, sf_dir).select("doc_id", names.readable(F.col("name")).alias("readable"))


_HITS = lambda terms: "concat_ws('|', " + ", ".join(f"CASE WHEN contains(name, '{t}') THEN '{t}' END" for t in terms) + ")"
_CHANNEL = f"""WITH {_NAMES}, m AS (SELECT *, {_HITS(LEGACY)} AS lm, {_HITS(EXTRA)} AS em FROM names),
ch AS (SELECT *, CASE WHEN starts_with(name, 'xn--') THEN 'unrestricted_exploration' WHEN lm <> '' AND length(name) < 34 AND NOT regexp_matches(name, '[0-9]{{3}}') THEN 'legacy_terms'
 WHEN lm = '' AND em <> '' AND length(name) <= 40 AND NOT regexp_matches(name, '[0-9]{{3}}') THEN 'expanded_terms'
 WHEN lm = '' AND em = '' AND length(name) BETWEEN 5 AND 30 AND regexp_matches(name, '^[a-z]+(-[a-z]+){{0,2}}$') AND regexp_matches(name, '[aeiou]') THEN 'name_exploration'
 ELSE 'unrestricted_exploration' END AS channel FROM m)"""


def channels(spark, sf_dir):
    return names.classify_channel(derived_names(spark, sf_dir), LEGACY, EXTRA)


@query(_CHANNEL + " SELECT doc_id, channel, lm AS name_matches, em AS additional_matches, lm <> '' AND length(name) < 34 AND NOT regexp_matches(name, '[0-9]{3}') AS original_rule_pass FROM ch")
def channel_classify(spark, sf_dir):
    c = channels(spark, sf_dir)
    return c.select("doc_id", "channel", F.array_join("name_matches", "|").alias("name_matches"), F.array_join("additional_matches", "|").alias("additional_matches"), "original_rule_pass")


@query(_CHANNEL + " SELECT channel, count(*)::BIGINT AS n FROM ch GROUP BY 1")
def channel_counts(spark, sf_dir):
    return audit.histogram(channels(spark, sf_dir), "channel")


@query(f"WITH {_NAMES} SELECT doc_id, name FROM names WHERE ({_HITS(LEGACY)}) <> '' AND length(name) < 34 AND NOT regexp_matches(name, '[0-9]{{3}}')")
def simple_screen(spark, sf_dir):
    return derived_names(spark, sf_dir).where(names.simple_screen(F.col("name"), LEGACY)).select("doc_id", "name")


_SAMPLE = _CHANNEL + f""", u AS (SELECT DISTINCT channel, domain FROM ch), r AS (SELECT channel, domain, row_number() OVER (PARTITION BY channel ORDER BY sha256('{SEED}' || chr(0) || domain), domain) AS rn FROM u),
q AS (SELECT * FROM (VALUES ('legacy_terms', 0, 30), ('expanded_terms', 1, 15), ('name_exploration', 2, 12), ('unrestricted_exploration', 3, 3)) v(channel, o, quota)),
pl AS (SELECT channel, domain, rn, o, row_number() OVER (ORDER BY greatest(0, rn - quota), o, rn) AS place FROM r JOIN q USING (channel)),
sel AS (SELECT channel, domain, rn, row_number() OVER (ORDER BY o, rn) AS queue_rank FROM pl WHERE place <= 60)"""


def _sample(spark, sf_dir):
    rows = channels(spark, sf_dir).select("channel", "domain").distinct()
    return sampling.quota_sample(rows, "channel", "domain", 60)


@query(_SAMPLE + " SELECT channel, domain, rn::INT AS rank_within_group, queue_rank::INT AS queue_rank FROM sel")
def quota_sample(spark, sf_dir):
    return _sample(spark, sf_dir).select("channel", "domain", "rank_within_group", "queue_rank")


@query(_SAMPLE + " SELECT channel, count(*)::BIGINT AS selected, arg_max(domain, rn) AS last_key FROM sel GROUP BY 1")
def channel_boundaries(spark, sf_dir):
    return sampling.boundaries(_sample(spark, sf_dir), "channel", "domain")


#: All ways to make up the forms f, and the best of each.
_WAYS = """lx AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM benchmark), pc AS (SELECT w, 1 AS cost FROM lx UNION ALL SELECT '-', 0),
ways AS (SELECT form, 0 AS pos, 0 AS n, []::VARCHAR[] AS words FROM f WHERE form <> '' AND NOT regexp_matches(form, '^-|-$|--')
 UNION ALL SELECT form, pos + length(w)::INT, n + cost, CASE WHEN cost = 1 THEN list_append(words, w) ELSE words END FROM ways JOIN pc ON substr(form, pos + 1, length(w)) = w AND n + cost <= 5 AND (cost = 1 OR pos > 0)),
best AS (SELECT form, words FROM ways WHERE pos = length(form) QUALIFY row_number() OVER (PARTITION BY form ORDER BY n, words) = 1)"""
_GROUPED = f"""WITH {_NAMES}, g AS (SELECT n.*, CASE WHEN tld IN ('com', 'net', 'org') THEN 'traditional' WHEN tld IN ('ai', 'io', 'app', 'dev', 'tech') THEN 'product_technology' WHEN tld IN ('co', 'me', 'cc', 'tv') THEN 'other_common' ELSE 'remaining' END AS suffix_group,
 doc_id IN (SELECT doc_id FROM labels) AS probed FROM names n)"""


@query(_GROUPED + " SELECT suffix_group, tld, count(*)::BIGINT AS n FROM g GROUP BY ALL")
def suffix_group_join(spark, sf_dir):
    return audit.histogram(names.with_suffix_group(derived_names(spark, sf_dir)), "suffix_group", "tld")


@query(f"""WITH {_NAMES} SELECT n.doc_id, n.domain FROM names n WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = n.doc_id)""")
def anti_probed(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return derived_names(spark, sf_dir).join(done, "doc_id", "left_anti").select("doc_id", "domain")


_P3 = _GROUPED.replace("WITH", "WITH RECURSIVE", 1) + """, lf AS (SELECT *, CASE WHEN regexp_matches(name, '[0-9]') THEN regexp_replace(name, '[0-9-]', '', 'g') ELSE name END AS lex FROM g), f AS (SELECT DISTINCT lex AS form FROM lf),
""" + _WAYS + """, c AS (SELECT lf.*, best.words IS NOT NULL AS seg, regexp_replace(name, '[^a-z]', '', 'g') AS lt, length(regexp_replace(name, '[^0-9]', '', 'g')) AS dg, replace(name, '-', '') AS bare FROM lf LEFT JOIN best ON lf.lex = best.form),
rd AS (SELECT *, {a} AS rl, {b} AS rn FROM c),
x AS (SELECT *, CASE WHEN starts_with(name, 'xn--') THEN 'encoded_idn' WHEN length(name) NOT BETWEEN 2 AND 32 THEN 'length' WHEN length(regexp_replace(name, '[^-]', '', 'g')) > 2 OR contains(name, '--') THEN 'hyphens'
 WHEN regexp_matches(name, '^[0-9-]+$') THEN 'numeric_only' WHEN regexp_matches(name, '{runs}') THEN 'repeated_characters' WHEN dg > 2 OR dg / length(bare)::DOUBLE > 0.4::DOUBLE THEN 'many_digits' WHEN dg > 0 AND length(name) > 16 THEN 'long_name_with_digits'
 WHEN dg > 0 AND NOT (seg OR rl OR length(lt) BETWEEN 2 AND 5) THEN 'unreadable_with_digits' END AS e FROM rd),
n3 AS (SELECT *, CASE WHEN e IS NOT NULL THEN NULL WHEN dg > 0 THEN 'alphanumeric_exploration' WHEN seg THEN 'dictionary_segments' WHEN length(name) BETWEEN 2 AND 5 AND NOT contains(name, '-') THEN 'short_abbreviation' WHEN rn THEN 'readable_coinage' END AS path FROM x)"""
_READ = lambda c, n: f"coalesce(regexp_matches({c}, '^[a-z]{{5,20}}$') AND length(regexp_replace({c}, '[^aeiouy]', '', 'g')) / nullif(length({c}), 0)::DOUBLE BETWEEN 0.2::DOUBLE AND 0.7::DOUBLE AND NOT regexp_matches({c}, '[^aeiouy]{{5}}') AND NOT regexp_matches({c}, '[aeiouy]{{4}}') AND NOT regexp_matches('-' || {n} || '-', '-.?-'), false)"
_P3 = _P3.replace("{a}", _READ("lt", "lt")).replace("{b}", _READ("bare", "name")).replace("{runs}", "|".join(f"{c}{{4}}" for c in "abcdefghijklmnopqrstuvwxyz0123456789-"))


def lexicon(spark, sf_dir):
    """The words of three letters or more of the benchmark's texts."""
    return table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), 0)).alias("word"))


def classified(spark, sf_dir):
    n = names.with_segments(derived_names(spark, sf_dir), lexicon(spark, sf_dir), names.lexical_form(F.col("name")))
    done = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("previously_probed", F.lit(True))
    n = n.join(done, "doc_id", "left").withColumn("previously_probed", F.coalesce("previously_probed", F.lit(False)))
    return names.classify_name(n)


@query(_P3 + " SELECT doc_id, path, coalesce(e, CASE WHEN path IS NULL THEN 'not_readable' END) AS reason FROM n3")
def name_paths(spark, sf_dir):
    return classified(spark, sf_dir).select("doc_id", "path", "reason")


@query(_P3 + " SELECT tld, count(*)::BIGINT AS input, count(path)::BIGINT AS eligible, (count(*) FILTER (WHERE path IS NOT NULL AND NOT probed))::BIGINT AS unprobed, (count(*) FILTER (WHERE path IS NOT NULL AND probed))::BIGINT AS overlap FROM n3 GROUP BY 1")
def tld_measures(spark, sf_dir):
    return names.tld_measures(classified(spark, sf_dir))


@query(_P3 + " SELECT tld, path, count(*)::BIGINT AS n FROM n3 GROUP BY ALL")
def tld_path_counts(spark, sf_dir):
    return audit.histogram(classified(spark, sf_dir), "tld", "path")


@query(f"WITH RECURSIVE {_NAMES}, f AS (SELECT DISTINCT name AS form FROM names), " + _WAYS + " SELECT n.doc_id, n.name, array_to_string(b.words, '|') AS segments FROM names n LEFT JOIN best b ON n.name = b.form")
def name_segments(spark, sf_dir):
    """Names as words of the lexicon."""
    return names.with_segments(derived_names(spark, sf_dir), lexicon(spark, sf_dir)).select("doc_id", "name", F.array_join("segments", "|").alias("segments"))


# ---- matching -------------------------------------------------------------------------------

_ALT = matching.alternation(CORPUS_ROOTS)
_ROOTS = f"WITH {_NAMES}, r AS (SELECT doc_id, name, domain, regexp_extract_all(name, '({_ALT})') AS texts FROM names)"
_HAS = "concat_ws('|', " + ", ".join(f"CASE WHEN list_contains(texts, '{t}') THEN '{t}' END" for t in CORPUS_ROOTS) + ")"


def root_hits(spark, sf_dir):
    n = derived_names(spark, sf_dir).withColumn("texts", matching.root_texts(F.col("name"), CORPUS_ROOTS))
    return n.withColumn("roots", matching.distinct_roots(F.col("texts"), CORPUS_ROOTS))


@query(_ROOTS + f" SELECT doc_id, array_to_string(texts, '|') AS texts, {_HAS} AS roots FROM r")
def root_hits_domain(spark, sf_dir):
    return root_hits(spark, sf_dir).select("doc_id", F.array_join("texts", "|").alias("texts"), F.array_join("roots", "|").alias("roots"))


@query("SELECT item_id, array_to_string(regexp_extract_all(lower(text), '\\b(the|and|of|in|on)\\b'), '|') AS texts FROM (SELECT item_id, regexp_replace(text, '[^\\x00-\\x7F]', '_', 'g') AS text FROM benchmark)")
def root_hits_keyword(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_replace("text", r"[^\x00-\x7F]", "_").alias("t"))
    return b.select("item_id", F.array_join(matching.root_texts(F.col("t"), ("the", "and", "of", "in", "on"), whole_words=True), "|").alias("texts"))


@query(_ROOTS + ", v AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in CORPUS_ROOTS) + "]) AS root), h AS (SELECT DISTINCT domain, unnest(texts) AS root FROM r) SELECT v.root, count(DISTINCT h.domain)::BIGINT AS n FROM v LEFT JOIN h USING (root) GROUP BY 1")
def root_counts(spark, sf_dir):
    return matching.root_counts(root_hits(spark, sf_dir), "domain", CORPUS_ROOTS).select("root", "n")


@query()
def root_spans(spark, sf_dir):
    n = derived_names(spark, sf_dir).withColumn("spans", matching.root_spans(F.col("name"), CORPUS_ROOTS))
    return n.select("doc_id", "name", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["root"], s["start"].cast("string"), s["end"].cast("string"))), "|").alias("spans"))


_MATCHED = _ROOTS + f""", pr AS (SELECT doc_id, name, domain, concat_ws('|', CASE WHEN len(list_filter(texts, lambda t: t NOT IN ('en', 'the'))) = 0 THEN 'broad_roots_only' END,
 CASE WHEN NOT (regexp_matches(name, '^({_ALT})') AND texts[1] NOT IN ('en', 'the') OR len(texts) > 0 AND ends_with(name, texts[-1]) AND texts[-1] NOT IN ('en', 'the') AND regexp_matches(regexp_replace(name, '({_ALT})', chr(1), 'g'), chr(1) || '$')) THEN 'no_specific_root_at_name_edge' END,
 CASE WHEN length(name) > 24 THEN 'long_name' END, CASE WHEN length(regexp_replace(name, '[^0-9]', '', 'g')) > 2 THEN 'many_digits' END,
 CASE WHEN length(regexp_replace(name, '[^-]', '', 'g')) > 1 OR contains(name, '--') THEN 'many_hyphens' END,
 CASE WHEN regexp_matches(name, '{"|".join(f"{c}{{4}}" for c in "abcdefghijklmnopqrstuvwxyz0123456789-")}') THEN 'repeated_characters' END) AS reasons FROM r WHERE len(texts) > 0)"""


def prioritised(spark, sf_dir):
    n = root_hits(spark, sf_dir).where(F.size("texts") > 0).withColumn("matches", matching.root_spans(F.col("name"), CORPUS_ROOTS))
    return names.priority_reasons(n, BROAD)


@query(_MATCHED + " SELECT doc_id, reasons FROM pr")
def priority_reasons(spark, sf_dir):
    return prioritised(spark, sf_dir).select("doc_id", F.array_join("reasons", "|").alias("reasons"))


@query(f"""WITH {_NAMES}, u AS (SELECT DISTINCT name, domain FROM names) SELECT name, arg_min(domain, sha256('{SEED}' || chr(0) || domain)) AS representative, (count(*) - 1)::BIGINT AS alternatives FROM u GROUP BY 1""")
def same_name_representative(spark, sf_dir):
    rows = derived_names(spark, sf_dir).select("name", "domain").distinct()
    return sampling.representatives(rows, "name", "domain")


_LANES = _MATCHED + f""", l AS (SELECT DISTINCT domain, CASE WHEN reasons = '' THEN 'priority' ELSE 'exploration' END AS lane FROM pr),
h AS (SELECT domain, lane, row_number() OVER (PARTITION BY lane ORDER BY sha256('{SEED}' || chr(0) || domain), domain) AS rn FROM l),
c AS (SELECT *, CASE WHEN lane = 'priority' THEN (rn - 1) // 4 ELSE rn - 1 END AS b, CASE WHEN lane = 'priority' THEN 0 ELSE 1 END AS s FROM h WHERE rn <= 80)"""


@query(_LANES + " SELECT domain, lane, row_number() OVER (ORDER BY b, s, rn)::INT AS queue_rank FROM c")
def lane_interleave(spark, sf_dir):
    """Top 80 of each lane by hash, four priority rows to one exploration row."""
    lane = F.when(F.size("reasons") == 0, "priority").otherwise("exploration")
    rows = prioritised(spark, sf_dir).select("domain", lane.alias("lane")).distinct()
    return sampling.interleave(sampling.top_by_hash(rows, "lane", "domain", 80), "lane", ["sampling_hash", "domain"]).select("domain", "lane", "queue_rank")


@query()
def root_round_robin(spark, sf_dir):
    rows = root_hits(spark, sf_dir).where(F.size("roots") > 0)
    return sampling.root_round_robin(rows, CORPUS_ROOTS, "domain", 100)


# ---- joins over event logs ------------------------------------------------------------------



@query("""SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND user_id IS NOT NULL""")
def latest_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return audit.latest(e, "user_id", ["ts", "event_id"])


@query("""WITH m AS (SELECT max(CAST(ts AS DATE)) AS day0 FROM events), l AS (SELECT user_id, max(CAST(ts AS DATE)) AS day FROM events WHERE event_type = 'purchase' GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, CASE WHEN l.day BETWEEN day0 - 7 AND day0 THEN 'reused' ELSE 'due' END AS state FROM u LEFT JOIN l USING (user_id), m""")
def cache_reuse_window(spark, sf_dir):
    """A record of the last seven days is reused."""
    e = table(spark, sf_dir, "events")
    asof = e.agg(F.max(F.to_date("ts")).alias("asof"))
    last = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max(F.to_date("ts")).alias("day"))
    u = e.select("user_id").distinct().join(last, "user_id", "left").join(F.broadcast(asof))
    return u.select("user_id", F.when(F.col("day").between(F.date_sub("asof", 7), F.col("asof")), "reused").otherwise("due").alias("state"))


@query("""WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_id % 2 = 0) WHERE rn = 1),
b AS (SELECT user_id, event_id, ts, 1 AS old FROM c UNION ALL SELECT * FROM (SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, 0 AS old FROM events WHERE event_id % 2 = 1 GROUP BY 1))
SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, old DESC) AS k FROM b) WHERE k = 1""")
def merge_latest(spark, sf_dir):
    """A monotone merge of two halves of the log (L4)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    even, odd = (audit.latest(e.where(f"event_id % 2 = {k}"), "user_id", ["ts", "event_id"]) for k in (0, 1))
    return logs.merge_latest(even, odd, "user_id", "ts").select("user_id", "event_id", "ts")


_RUNS = """WITH w AS (SELECT event_id, user_id, ts, event_type = 'error' AS hit, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
r AS (SELECT *, sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id) AS run_length FROM w)"""


@query(_RUNS + " SELECT event_id, run_length::BIGINT AS run_length FROM r WHERE hit")
def failure_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    hit = F.col("event_type") == "error"
    return sampling.runs(e, ["user_id"], ["ts", "event_id"], hit, F.to_date("ts")).where(hit).select("event_id", "run_length")


@query(_RUNS + " SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, count(*)::BIGINT AS rows_at_limit FROM r WHERE run_length >= 2 GROUP BY 1")
def circuit_breaker(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return logs.breaker(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 2, F.to_date("ts")).select("user_id", "event_id", "rows_at_limit")


@query("""WITH g AS (SELECT event_id, user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events)
SELECT event_id, user_id FROM g WHERE d < 3600000000""")
def rate_spacing_violations(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return audit.spacing_violations(e, "ts", 3600.0, ["user_id"], "event_id", F.to_date("ts")).select("event_id", "user_id")


_OPS = {"signup": "resume", "click": "claim", "view": "claim", "purchase": "success", "error": "cooldown"}


@query()
def pacing_replay(spark, sf_dir):
    """Events as a log of pacing operations, a user being a root."""
    e = table(spark, sf_dir, "events")
    op = F.create_map(*[F.lit(x) for kv in _OPS.items() for x in kv])[F.col("event_type")]
    log = e.where("user_id is not null and ts is not null").select(F.col("user_id").cast("string").alias("root"), F.col("ts").alias("at"), op.alias("op"), F.lit(None).cast("string").alias("retry_after"), F.col("event_id").alias("seq"))
    return pacing.replay(log)


@query("""SELECT event_id, greatest(ts, CASE event_type WHEN 'click' THEN ts + to_seconds(greatest(floor(value)::BIGINT, 0)) WHEN 'view' THEN date_trunc('second', ts) + INTERVAL 2 MINUTE ELSE ts END) AS retry_at FROM events""")
def retry_times(spark, sf_dir):
    """Retry-After values made of the events: seconds, dates and others."""
    e = table(spark, sf_dir, "events")
    said = F.date_format(F.date_trunc("second", "ts") + F.expr("INTERVAL 2 MINUTES"), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    value = F.when(F.col("event_type") == "click", F.floor("value").cast("string")).when(F.col("event_type") == "view", said).when(F.col("event_type") == "error", "later")
    return e.select("event_id", T.retry_at(value, F.col("ts")).alias("retry_at"))


@query("""WITH g AS (SELECT o_orderkey, o_orderdate AS at_ts, TIMESTAMP '1998-01-01' AS ref FROM orders) SELECT o_orderkey, CASE WHEN at_ts IS NULL OR at_ts > ref THEN 'unknown' WHEN epoch(ref) - epoch(at_ts) <= 90 * 86400 THEN 'verified_recent' ELSE 'verified_old' END AS status FROM g""")
def registration_status(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    events = F.array(F.struct(F.lit("registration").alias("action"), F.col("o_orderdate").cast("timestamp").alias("at")), F.struct(F.lit("last changed").alias("action"), F.lit("1990-01-01").cast("timestamp").alias("at")))
    status, _ = pages.registration(events, F.lit("1998-01-01").cast("timestamp"), 90)
    return o.select("o_orderkey", status.alias("status"))


# ---- pages ----------------------------------------------------------------------------------

def with_fields(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", "html", pages.page_fields("html").alias("f")).select("page_id", "url", "html", "f.*")


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS title,
 trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS h1 FROM pages""")
def page_title_h1(spark, sf_dir):
    t, h = pages.quick_fields(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", t.alias("title"), h.alias("h1"))


@query()
def page_fields_full(spark, sf_dir):
    f = with_fields(spark, sf_dir)
    return f.select("page_id", "title", "description", F.array_join("h1", "|").alias("h1"), F.length("visible_text").alias("text_length"), T.page_fingerprint(F.col("title"), F.col("description"), F.col("h1")).alias("fingerprint"))


@query()
def page_classify(spark, sf_dir):
    f = with_fields(spark, sf_dir)
    decision, reason = pages.classify_full(T.host_of(F.col("url")), F.col("title"), F.col("h1"), F.col("description"), F.col("visible_text"), F.col("html"))
    return f.select("page_id", decision.alias("decision"), reason.alias("reason"))


@query()
def page_verdict(spark, sf_dir):
    f = with_fields(spark, sf_dir)
    recent = F.when(F.col("page_id") % 3 == 0, "verified_old").when(F.col("page_id") % 3 == 1, "verified_recent").otherwise("unknown")
    v = pages.verdict(F.col("title"), F.col("h1"), F.col("description"), F.col("visible_text"), recent, F.col("url").contains("://m."), T.host_of(F.col("url")))
    return f.select("page_id", v.alias("verdict"))


@query("""WITH e AS (SELECT page_id, (page_id * 37 % 6)::INT AS k FROM pages), r AS (SELECT page_id, [200, 429, 403, 404, 500, NULL][k + 1] AS s FROM e)
SELECT page_id, CASE WHEN s = 200 THEN NULL WHEN s = 404 THEN 'skip' ELSE 'recheck' END AS decision, CASE WHEN s = 429 THEN 'rate_limited' WHEN s = 403 THEN 'http_blocked' WHEN s = 404 THEN 'homepage_missing' WHEN s = 500 THEN 'homepage_500' WHEN s IS NULL THEN 'timeout' END AS reason FROM r""")
def response_disposition(spark, sf_dir):
    k = (F.col("page_id") * 37 % 6).cast("int")
    s = F.get(F.array(*[F.lit(v).cast("int") for v in (200, 429, 403, 404, 500, None)]), k)
    d, r = pages.disposition(s, F.when(s.isNull(), T.error_kind(F.lit(28))), F.lit("homepage"))
    return table(spark, sf_dir, "pages").select("page_id", d.alias("decision"), r.alias("reason"))


@query("""SELECT page_id, starts_with(url, 'https://') AND NOT contains(split_part(split_part(url, '://', 2), '/', 1), '@') AND NOT contains(split_part(split_part(url, '://', 2), '/', 1), ':') AND regexp_replace(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1), '^www\\.', '') = regexp_replace(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1), '^(www|m|blog)\\.', '') AS admitted FROM pages""")
def url_admission(spark, sf_dir):
    domain = F.regexp_replace(T.host_of(F.col("url")), r"^(www|m|blog)\.", "")
    return table(spark, sf_dir, "pages").select("page_id", pages.admitted(F.col("url"), domain).alias("admitted"))


@query("""SELECT page_id, regexp_extract(url, '[?&]([a-z_]+)=([^&#]*)', 1) AS name, regexp_extract(url, '[?&]([a-z_]+)=([^&#]*)', 2) AS value FROM pages WHERE contains(url, '=')""")
def url_scope_check(spark, sf_dir):
    """First query parameter, decoded once."""
    p = table(spark, sf_dir, "pages").where(F.col("url").contains("="))
    rx = r"[?&]([a-z_]+)=([^&#]*)"
    return p.select("page_id", F.regexp_extract("url", rx, 1).alias("name"), F.try_url_decode(F.regexp_extract("url", rx, 2)).alias("value"))


@query()
def safe_targets(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", pages.safe_target("url").alias("safe"))


# ---- phrases --------------------------------------------------------------------------------

@query()
def page_fragments(spark, sf_dir):
    f = with_fields(spark, sf_dir)
    return phrases.page_fragments(f, "page_id", [("h1", "h1"), ("title", "title"), ("description", "description")])


PHRASE_ROOTS = ("and", "the", "inan", "with")


def _sql_list(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


#: White space as Unicode has it, and with ASCII's four separators too; in DuckDB's patterns it is that of ASCII without the vertical tab.
SQL_SPACE = r"[\s\x0B\x{85}\p{Z}]"
_GAP = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
#: Case folded, as the rules say: ß is ss, and so are the other letters that fold to ASCII.
SQL_FOLDED = lambda c: "".join("replace(" for _ in T.FOLDED) + f"lower({c})" + "".join(f", '{a}', '{b}')" for a, b in T.FOLDED)
_ADDRESS = r"(?i)https?://|www\.|\.(?:com|net|org)(?:[^\p{L}\p{M}\p{N}\p{Pc}]|$)"
#: Segments of a text; a dot ends one only before white space, which stays.
_SEGS = r"string_split(regexp_replace(regexp_replace(coalesce({t}, ''), '\.({gap}|$)', '|\1', 'g'), '[|:;!?\n\r•{wide}]|{gap}[-–—]{gap}', '|', 'g'), '|')".replace("{gap}", _GAP)
_SHORT = (
    r"SELECT {k}, sid, seg, regexp_replace(seg, '^{gap}+|{gap}+$', '', 'g') AS phrase FROM (SELECT {k}, unnest(g) AS seg, generate_subscripts(g, 1) AS sid FROM (SELECT {k}, "
    + _SEGS.replace("{wide}", "。！？")
    + r" AS g FROM {rows}))"
).replace("{gap}", _GAP)
_SHORT_GOOD = (
    r"length(phrase) BETWEEN 4 AND 120 AND (len(regexp_extract_all(phrase, '[\p{L}\p{N}_]+')) BETWEEN 2 AND 10 OR (regexp_matches(phrase, '[^\x00-\x7F]') AND length(phrase) BETWEEN 4 AND 60))"
    r" AND lower(regexp_replace(phrase, '" + SQL_SPACE + "+', ' ', 'g')) NOT IN (" + _sql_list(V.SHELL_PHRASES) + r") AND NOT regexp_matches(phrase, '" + _ADDRESS + "')"
)
_ROOT_SPANS = (
    r"""WITH s AS (SELECT doc_id, unnest(g) AS seg, generate_subscripts(g, 1) AS sid FROM (SELECT doc_id, """
    + _SEGS.replace("{t}", "text").replace("{wide}", "")
    + r""" AS g FROM documents)),
t AS (SELECT doc_id, sid, regexp_extract_all(seg, '{tok}') AS toks, regexp_split_to_array(seg, '{tok}') AS gaps FROM s WHERE regexp_matches(seg, '(^|[^A-Za-z0-9])(?i:{roots})([^A-Za-z0-9]|$)')),
w AS (SELECT *, lower(tok) AS low, lower(tok) IN ({stop}) AS stop, lower(tok) IN ({known}) AS root FROM (SELECT doc_id, sid, unnest(toks) AS tok, unnest(gaps[1:len(toks)]) AS gap, generate_subscripts(toks, 1) AS i FROM t)),
c AS (SELECT h.i AS hit, x.*, coalesce(max(x.i) FILTER (WHERE x.i < h.i AND x.low IN ({boundary})) OVER (PARTITION BY h.doc_id, h.sid, h.i), 0) AS cut FROM w h JOIN w x ON h.doc_id = x.doc_id AND h.sid = x.sid AND h.root
  AND x.i BETWEEN h.i - 5 AND CASE WHEN h.i = 1 OR h.low IN ({right}) THEN h.i + 3 ELSE h.i END UNION ALL SELECT 0, w.*, 0 FROM w),
l AS (SELECT *, min(i) FILTER (WHERE NOT stop) OVER (PARTITION BY doc_id, sid, hit) AS lo, max(i) FILTER (WHERE NOT stop) OVER (PARTITION BY doc_id, sid, hit) AS hi FROM c WHERE i > cut),
p AS (SELECT doc_id, {fold} AS phrase FROM l WHERE i BETWEEN lo AND hi GROUP BY doc_id, sid, hit
  HAVING count(*) BETWEEN 2 AND 7 AND CASE WHEN hit = 0 THEN bool_or(root) AND bool_or(NOT stop AND NOT root) ELSE bool_or(NOT stop AND NOT root AND low <> 'online') END),
r AS (SELECT DISTINCT doc_id, phrase FROM p WHERE length(phrase) BETWEEN 4 AND 80 AND regexp_full_match(phrase, '[a-z0-9+'' &/().-]+') AND NOT regexp_matches(phrase, '{address}'))"""
    .replace("{fold}", SQL_FOLDED("regexp_replace(string_agg(CASE WHEN i = lo THEN tok ELSE gap || tok END, '' ORDER BY i), '" + _GAP + "+', ' ', 'g')")).replace("{address}", _ADDRESS)
    .replace("{tok}", "[A-Za-z0-9]+(?:[+''-][A-Za-z0-9]+)*").replace("{roots}", "|".join(PHRASE_ROOTS)).replace("{stop}", _sql_list(V.STOP_WORDS))
    .replace("{known}", _sql_list(PHRASE_ROOTS)).replace("{boundary}", _sql_list(V.BOUNDARY_WORDS)).replace("{right}", _sql_list(V.RIGHT_EXTENDING))
)


@query("SELECT DISTINCT doc_id, phrase FROM (" + _SHORT.replace("{k}", "doc_id").replace("{t}", "text").replace("{rows}", "documents") + ") WHERE " + _SHORT_GOOD)
def literal_segments(spark, sf_dir):
    return phrases.literal_segments(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(_ROOT_SPANS + " SELECT doc_id, phrase FROM r")
def literal_root_phrases(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.explode(phrases.root_phrases(F.col("text"), PHRASE_ROOTS)).alias("phrase"))


@query(
    _ROOT_SPANS + ", b AS (SELECT DISTINCT doc_id, phrase FROM (" + _SHORT.replace("{k}", "doc_id").replace("{t}", "text").replace("{rows}", "documents") + ") WHERE " + _SHORT_GOOD
    + ") SELECT doc_id, phrase, 'short_literal_segment' AS method FROM b UNION ALL SELECT doc_id, phrase, 'literal_root_span' FROM r WHERE (doc_id, phrase) NOT IN (SELECT (doc_id, phrase) FROM b)"
)
def literal_phrases(spark, sf_dir):
    """Both forms of literal phrases, each with the method that found it."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.explode(phrases.literal_phrases(F.col("text"), PHRASE_ROOTS)).alias("p")).select("doc_id", "p.phrase", "p.method")


_EVID = """WITH w AS (SELECT page_id, lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) AS domain, page_id % 2 = 0 AS ok,
 trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS title FROM pages),
e AS (SELECT DISTINCT unnest(regexp_extract_all(lower(title), '[a-z]{4,}')) AS term, domain, CASE WHEN page_id % 5 = 0 THEN 'description' ELSE 'title' END AS field, title AS quote, ok FROM w),
g AS (SELECT term, domain, field, quote, bool_or(ok) AS ok FROM e GROUP BY ALL), h AS (SELECT DISTINCT domain FROM g WHERE field = 'title'),
i AS (SELECT term, count(*) AS evidence, count(DISTINCT domain) AS domains, count(*) FILTER (WHERE field = 'title') AS strong_evidence, bool_or(ok) AS any_ok FROM g WHERE field = 'title' OR domain NOT IN (SELECT domain FROM h) GROUP BY 1)"""


def evidence(spark, sf_dir):
    t, _ = pages.quick_fields(F.col("html"))
    p = table(spark, sf_dir, "pages").select(T.host_of(F.col("url")).alias("domain"), (F.col("page_id") % 2 == 0).alias("ok"), t.alias("quote"), F.when(F.col("page_id") % 5 == 0, "description").otherwise("title").alias("field"))
    return p.select(F.explode(F.regexp_extract_all(F.lower("quote"), F.lit("[a-z]{4,}"), 0)).alias("term"), "domain", "field", "quote", "ok")


@query(_EVID + " SELECT term, evidence::BIGINT AS evidence, domains::BIGINT AS domains, strong_evidence::BIGINT AS strong_evidence, any_ok FROM i")
def phrase_index(spark, sf_dir):
    return phrases.term_index(evidence(spark, sf_dir))


@query(_EVID + " SELECT term, CASE WHEN strong_evidence = 0 THEN 'no_usable_source' WHEN term IN ('this', 'that', 'with') THEN 'phrase_review' WHEN NOT any_ok THEN 'metadata_only' ELSE 'ready' END AS triage FROM i")
def phrase_triage(spark, sf_dir):
    i = phrases.term_index(evidence(spark, sf_dir))
    return i.select("term", phrases.triage(F.col("term"), F.col("strong_evidence") > 0, F.col("any_ok"), ("this", "that", "with")).alias("triage"))


@query(_EVID + " SELECT term, row_number() OVER (ORDER BY -strong_evidence, sha256(term))::INT AS position FROM i QUALIFY position <= 100")
def candidate_order(spark, sf_dir):
    """The first hundred candidates, in order."""
    o = phrases.ordered_candidates(phrases.term_index(evidence(spark, sf_dir)))
    top = o.orderBy("order_strong", "order_hash").limit(100)
    return top.select("term", F.row_number().over(Window.orderBy("order_strong", "order_hash")).alias("position"))


@query(_EVID + """, s AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term, 'item' || (item_id % 9)::VARCHAR AS domain FROM benchmark),
a AS (SELECT term, domain, 1 AS own FROM g UNION ALL SELECT term, domain, 0 FROM s) SELECT term AS keyword, count(DISTINCT domain)::BIGINT AS domains, CASE WHEN max(own) = 0 THEN 'inserted' WHEN min(own) = 0 THEN 'extended' ELSE 'kept' END AS origin FROM a GROUP BY 1""")
def supplement_upsert(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    s = b.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0)).alias("keyword"), F.concat(F.lit("item"), (F.col("item_id") % 9).cast("string")).alias("domain"))
    t = evidence(spark, sf_dir).select(F.col("term").alias("keyword"), "domain")
    return phrases.upsert_supplements(t, s)


@query("""SELECT page_id::VARCHAR AS domain, CASE WHEN page_id % 6 = 0 THEN 'changed' ELSE 'missing' END AS problem FROM pages WHERE page_id % 6 IN (0, 1)""")
def ledger_validation(spark, sf_dir):
    """Reviews of changed and of missing pages must be found."""
    t, h = pages.quick_fields(F.col("html"))
    p = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("domain"), T.page_fingerprint(t, F.lit(""), F.array(h)).alias("fingerprint"))
    ledger = p.select("domain", F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("old"), F.col("fingerprint"))).otherwise(F.col("fingerprint")).alias("fingerprint"))
    return phrases.stale_reviews(ledger, p.where("page_id % 6 <> 1").select("domain", "fingerprint"))


@query("""WITH f AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS t FROM pages) SELECT page_id::VARCHAR AS domain FROM f WHERE page_id % 4 = 0""")
def evidence_in_field(spark, sf_dir):
    """Quotes that are not in their field: every fourth has been altered."""
    t, _ = pages.quick_fields(F.col("html"))
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("domain"), F.lit("title").alias("field"), t.alias("value"), "page_id")
    q = F.when(F.col("page_id") % 4 == 0, F.concat("value", F.lit(" #"))).otherwise(F.col("value"))
    e = p.select("domain", "field", q.alias("quote"), F.col("value").alias("term"))
    return phrases.quotes_missing(e, p.select("domain", "field", "value")).select("domain")


# ---- audits ---------------------------------------------------------------------------------

_REASONS = {"click": "html_with_content", "view": "thin_or_empty", "error": "timeout", "signup": "http_blocked", "purchase": "no_such_reason"}


def access_rows(spark, sf_dir):
    m = F.create_map(*[F.lit(x) for kv in _REASONS.items() for x in kv])
    return table(spark, sf_dir, "events").select("event_id", "user_id", m[F.col("event_type")].alias("reason"), F.when(F.col("value") > 10, F.col("value").cast("int")).alias("requests"))


_ACCESS = "WITH r AS (SELECT user_id, event_type, CASE event_type WHEN 'click' THEN 'page_candidate' WHEN 'view' THEN 'limited_content' WHEN 'error' THEN 'network' WHEN 'signup' THEN 'access_restriction' ELSE 'unmapped' END AS outcome FROM events)"


@query(_ACCESS + " SELECT outcome, count(DISTINCT user_id)::BIGINT AS n, round(100.0::DOUBLE * count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events), 2) AS percent FROM r GROUP BY 1")
def access_outcomes(spark, sf_dir):
    return audit.access_outcomes(access_rows(spark, sf_dir), "user_id", "reason")


@query("SELECT DISTINCT 'no_such_reason' AS reason FROM events WHERE event_type = 'purchase'")
def unmapped_reasons(spark, sf_dir):
    return audit.unmapped(access_rows(spark, sf_dir), "reason")


@query("SELECT event_type, coalesce(sum(CASE WHEN value > 10 THEN trunc(value)::BIGINT END), 0)::BIGINT AS known_requests, (count(*) FILTER (WHERE NOT coalesce(value > 10, false)))::BIGINT AS unknown_rows, count(*)::BIGINT AS all_rows FROM events GROUP BY 1")
def request_totals(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.when(F.col("value") > 10, F.col("value").cast("long")).alias("requests"))
    return audit.request_totals(e, ["event_type"], "requests")


@query("""WITH b AS (SELECT lang = 'en' AS a, n_chars >= 500 AS b, contains(text, 'the') AS c FROM documents), s AS (SELECT count(*) AS s0, count(*) FILTER (WHERE a) AS s1, count(*) FILTER (WHERE a AND b) AS s2, count(*) FILTER (WHERE a AND b AND c) AS s3 FROM b)
SELECT * FROM (SELECT 0 AS step, 'all' AS name, s0::BIGINT AS kept, 0::BIGINT AS removed FROM s UNION ALL SELECT 1, 'english', s1, s0 - s1 FROM s UNION ALL SELECT 2, 'long', s2, s1 - s2 FROM s UNION ALL SELECT 3, 'with_the', s3, s2 - s3 FROM s)""")
def funnel(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return audit.funnel(d, [("english", F.col("lang") == "en"), ("long", F.col("n_chars") >= 500), ("with_the", F.contains(F.col("text"), F.lit("the")))])


_SETS = "WITH a AS (SELECT doc_id FROM documents), b AS (SELECT doc_id FROM labels)"


@query(_SETS + " SELECT (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS unions, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS common, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_left, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_right")
def set_operations(spark, sf_dir):
    a, b = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    parts = [("unions", a.union(b).distinct()), ("common", a.intersect(b)), ("only_left", a.subtract(b)), ("only_right", b.subtract(a))]
    out = None
    for name, df in parts:
        one = df.agg(F.count("*").alias(name))
        out = one if out is None else out.join(F.broadcast(one))
    return out


@query("""WITH a AS (SELECT source, lang FROM documents), b AS (SELECT source, lang FROM documents WHERE doc_id % 10 <> 0) SELECT source, lang, 'left' AS side, count(*)::BIGINT AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL""")
def multiset_difference(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    diff = audit.differing(d.select("source", "lang"), d.where("doc_id % 10 <> 0").select("source", "lang"))
    return audit.histogram(diff, "source", "lang", "side")


@query("SELECT l_orderkey, l_partkey, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_key_violations(spark, sf_dir):
    return audit.not_unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query("SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 9 <> 0)")
def subset_violations(spark, sf_dir):
    return audit.outside(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").where("doc_id % 9 <> 0"), "doc_id")


@query("SELECT (SELECT count(*) FROM lineitem) AS whole, (SELECT sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus))::BIGINT AS parts, true AS conserved")
def conservation_check(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    parts = audit.histogram(l, "l_returnflag", "l_linestatus").agg(F.sum("n").alias("parts"))
    return l.agg(F.count("*").alias("whole")).join(F.broadcast(parts)).select("whole", "parts", (F.col("whole") == F.col("parts")).alias("conserved"))


# ---- interactive ----------------------------------------------------------------------------

@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'license') OR contains(lower(source), 'license')")
def text_search(spark, sf_dir):
    return audit.search(table(spark, sf_dir, "documents"), ["text", "source"], "License").select("doc_id")


@query("SELECT lang, count(*)::BIGINT AS n FROM documents WHERE contains(lower(text), 'the') GROUP BY 1")
def facet_counts(spark, sf_dir):
    return audit.histogram(audit.search(table(spark, sf_dir, "documents"), ["text"], "the"), "lang")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50 OFFSET 50")
def paginate(spark, sf_dir):
    """The second page of fifty."""
    return audit.page_of(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), F.asc("doc_id")], 2)


@query("SELECT event_id FROM events WHERE contains(lower(event_type), 'purchase') OR contains(lower(props), '\"k\": 7')")
def record_search(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return audit.search(e, ["event_type"], "purchase").select("event_id").union(audit.search(e, ["props"], '"k": 7').select("event_id")).distinct()


@query("SELECT doc_id, CASE WHEN regexp_matches(cell, '^ *[=+@\\t\\r\\n-]') THEN '''' || cell ELSE cell END AS cell FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '=' ELSE '' END || text AS cell FROM documents)")
def csv_guard(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "=").otherwise(""), F.col("text")).alias("cell"))
    return d.select("doc_id", T.guarded_cell(F.col("cell")).alias("cell"))


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS rn FROM conversations) WHERE rn = 1 AND conv_id IS NOT NULL")
def dialogue_window(spark, sf_dir):
    """The last turn of each conversation."""
    return audit.latest(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", ["turn", "role", "text"])


# ---- ledgers --------------------------------------------------------------------------------

def user_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.concat("user_id", F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("walk"), "event_type")


@query("""WITH w AS (SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS walk, count(*) AS r, count(DISTINCT event_type) AS u FROM events GROUP BY 1) SELECT walk, CASE WHEN u < r THEN 'loop' ELSE 'too_many_hops' END AS problem FROM w WHERE u < r OR r > 3""")
def redirect_walk(spark, sf_dir):
    """A walk is the events of a user on a day, a URL an event's type."""
    return ledger.redirect_problems(user_days(spark, sf_dir), "walk", "event_type")


@query("""SELECT event_id, CASE WHEN event_type <> 'click' AND NOT coalesce([200, 404, 429, 500, NULL][(event_id % 5 + 1)::INT] IN (401, 403, 404, 410, 429), false) AND event_type <> 'view' THEN 'retry' ELSE 'reuse' END AS action FROM events""")
def retry_split(spark, sf_dir):
    status = F.get(F.array(*[F.lit(v).cast("int") for v in (200, 404, 429, 500, None)]), (F.col("event_id") % 5).cast("int"))
    action = ledger.retry_split(F.col("event_type") == "click", status, F.col("event_type") != "view")
    return table(spark, sf_dir, "events").select("event_id", action.alias("action"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND coalesce(o_orderdate < TIMESTAMP '1997-06-01', true) THEN 'observe' WHEN o_orderstatus = 'O' THEN 'candidate' ELSE 'other' END AS state FROM orders""")
def demotion(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "O", "candidate").otherwise("other")
    registered = F.when(F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp_ntz"), "verified_recent").when(F.col("o_orderdate").isNotNull(), "verified_old")
    return table(spark, sf_dir, "orders").select("o_orderkey", ledger.demoted(state, registered).alias("state"))


@query("""SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'reuse' WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'retry' WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'reuse' ELSE 'never' END AS action FROM documents""")
def universe_partition(spark, sf_dir):
    """Pilot: labels of good quality; history: all labels, to be tried again where toxic."""
    lab = table(spark, sf_dir, "labels")
    history = lab.select("doc_id", F.when(F.col("toxic") == 1, "retry").otherwise("reuse").alias("action"))
    return ledger.universe(table(spark, sf_dir, "documents"), lab.where("quality = 1"), history, "doc_id")


_CAPS = "caps AS (SELECT (user_id % 50)::BIGINT AS capture, min(ts) AS at_ts, list_sort(list(DISTINCT event_type)) AS terms FROM events GROUP BY 1)"


def captures_of(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 50).alias("capture")).agg(F.min("ts").alias("at"), F.sort_array(F.collect_set("event_type")).alias("terms"))


@query(f"WITH {_CAPS}, x AS (SELECT capture, at_ts, unnest(terms) AS term FROM caps), t AS (SELECT DISTINCT event_type AS term FROM events UNION SELECT 'unknown') SELECT t.term, arg_min(x.capture, (x.at_ts, x.capture)) AS capture FROM t LEFT JOIN x USING (term) GROUP BY 1")
def term_first_capture(spark, sf_dir):
    t = table(spark, sf_dir, "events").select(F.col("event_type").alias("term"))
    t = t.union(spark.createDataFrame([("unknown",)], "term string"))
    return ledger.first_capture(t, captures_of(spark, sf_dir))


@query(f"WITH {_CAPS} SELECT capture AS group_id, CASE WHEN capture % 4 = 0 THEN 'open' WHEN capture % 4 = 1 AND len(terms) > 1 THEN 'terms_differ' ELSE 'covered' END AS state, len(terms)::INT AS terms FROM caps")
def queue_coverage(spark, sf_dir):
    """Every fourth group has not been captured, every fourth in another order."""
    c = captures_of(spark, sf_dir).select(F.col("capture").alias("group_id"), "terms")
    done = c.where("group_id % 4 <> 0").select("group_id", F.when(F.col("group_id") % 4 == 1, F.reverse("terms")).otherwise(F.col("terms")).alias("terms"))
    return ledger.queue_coverage(c, done)


@query(_CHANNEL + ", t AS (SELECT unnest(['ment', 'heit', 'the', 'en']) AS term) SELECT term, count(*)::BIGINT AS any_rows, (count(*) FILTER (WHERE lm <> ''))::BIGINT AS with_listed, (count(*) FILTER (WHERE lm = ''))::BIGINT AS without_listed FROM ch JOIN t ON contains(ch.name, t.term) GROUP BY 1")
def term_diagnostics(spark, sf_dir):
    return ledger.term_diagnostics(channels(spark, sf_dir), ("ment", "heit", "the", "en"))


@query("SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS walk, CASE WHEN count(DISTINCT event_type) > 1 THEN 'mixed' ELSE min(event_type) END AS mode FROM events GROUP BY 1")
def execution_mix(spark, sf_dir):
    return ledger.execution_mix(user_days(spark, sf_dir), "walk", "event_type")


@query("SELECT source, count(DISTINCT lang)::BIGINT AS members FROM documents GROUP BY 1 HAVING count(DISTINCT lang) > 2")
def cardinality_violations(spark, sf_dir):
    return ledger.over_cardinality(table(spark, sf_dir, "documents"), "source", "lang", 2)


@query(_CAPTURES + "SELECT capture, term, round(100.0::DOUBLE * (estimate - 14000) / 14000, 4) AS error_percent FROM e")
def anchor_crosscheck(spark, sf_dir):
    e = _estimates(spark, sf_dir)
    return e.select("capture", "term", F.round(ledger.anchor_crosscheck(F.col("estimate"), F.lit(14000.0)), 4).alias("error_percent"))


@query(_PERSIST + """, st AS (SELECT user_id, CASE WHEN total = 0 THEN 'zero' WHEN nz < 5 OR 2 * peak > total THEN 'sparse' WHEN up AND nze <= 2 THEN 'emerging' WHEN up THEN 'rising'
 WHEN (b > 0 AND 5 * r <= 4 * b) OR (q > 0 AND 40 * t < 21 * q) THEN 'cooling' ELSE 'other' END AS status FROM u)
SELECT user_id, status, row_number() OVER (ORDER BY CASE WHEN status IN ('rising', 'emerging') THEN 0 WHEN user_id % 2 = 0 THEN 1 ELSE 2 END, user_id)::INT AS position FROM st QUALIFY position <= 50""")
def pinned_first_page(spark, sf_dir):
    """The first fifty users: rising ones, then queried ones (even ids), then the others."""
    s = series.persistence(user_series(spark, sf_dir)).select("user_id", "status", ledger.pinned_order(F.col("status"), F.col("user_id") % 2 == 0).alias("pin"))
    top = s.orderBy("pin", "user_id").limit(50)
    return top.select("user_id", "status", F.row_number().over(Window.orderBy("pin", "user_id")).alias("position"))


@query(_ROOTS + " SELECT doc_id, name FROM r WHERE list_contains(texts, 'tion') AND contains(name, 'an')")
def root_membership(spark, sf_dir):
    return ledger.with_member(root_hits(spark, sf_dir), "roots", "tion", ["name"], "an").select("doc_id", "name")


@query(f"WITH {_NAMES} SELECT doc_id, 'https://trends.example.com/explore?date=2026-01-01+2026-01-30&geo=US&q=' || name AS url FROM names")
def query_urls(spark, sf_dir):
    return derived_names(spark, sf_dir).select("doc_id", ledger.query_url("https://trends.example.com/explore", F.col("name"), "2026-01-01", "2026-01-30").alias("url"))


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run FROM orders WHERE o_orderdate IS NOT NULL) SELECT run, (run - 1)::DATE AS window_end, (run - 30)::DATE AS window_start, ((run - 1) - INTERVAL 6 MONTH)::DATE AS background_start FROM d""")
def window_arithmetic(spark, sf_dir):
    end, start, back = ledger.window_bounds(F.col("run"))
    d = table(spark, sf_dir, "orders").where("o_orderdate is not null").select(F.to_date("o_orderdate").alias("run")).distinct()
    return d.select("run", end.alias("window_end"), start.alias("window_start"), back.alias("background_start"))


@query("""SELECT conv_id, turn, replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss') AS canonical, left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 40) AS short FROM conversations""")
def canonical_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.canonical(F.col("text")).alias("canonical"), T.clean_text(F.col("text"), 40).alias("short"))


@query("SELECT source, count(*)::BIGINT AS pages, sum(octet_length(encode(text)))::BIGINT AS body_bytes, min(doc_id) AS first_id, max(doc_id) AS last_id, count(DISTINCT lower(text))::BIGINT AS phrases FROM documents GROUP BY 1")
def body_totals(spark, sf_dir):
    """Bytes, bounds and distinct folded texts by source."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy("source").agg(F.count("*").alias("pages"), F.sum(F.octet_length("text")).alias("body_bytes"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.countDistinct(F.sha2(F.lower("text"), 256)).alias("phrases"))


# ---- totals, lookups and guards -------------------------------------------------------------


@query(f"""WITH {_RAW}, e AS (SELECT n, {_ERROR} AS e FROM nrm)
SELECT count(*)::BIGINT AS raw, count(*) FILTER (WHERE e IS NULL)::BIGINT AS valid, count(DISTINCT n) FILTER (WHERE e IS NULL)::BIGINT AS unique,
 (count(*) FILTER (WHERE e IS NULL) - count(DISTINCT n) FILTER (WHERE e IS NULL))::BIGINT AS duplicate, count(*) FILTER (WHERE e IS NOT NULL)::BIGINT AS invalid FROM e""")
def list_totals(spark, sf_dir):
    return lookups.run_totals(raw_lines(spark, sf_dir), T.domain_of(F.col("raw")), T.domain_error(F.col("raw")))


@query(f"""WITH {_RAW}, d AS (SELECT DISTINCT coalesce({_ERROR}, 'valid') AS reason, sha256(coalesce(raw, '')) AS line_id FROM nrm)
SELECT reason, line_id, row_number() OVER (PARTITION BY reason ORDER BY line_id)::INT AS position FROM d QUALIFY position <= 5""")
def reason_examples(spark, sf_dir):
    raw = F.col("raw")
    rows = raw_lines(spark, sf_dir).select(F.coalesce(T.domain_error(raw), F.lit("valid")).alias("reason"), F.sha2(F.coalesce(raw, F.lit("")), 256).alias("line_id"))
    return lookups.examples(rows, "reason", "line_id")


@query("""WITH k AS (SELECT doc_id AS key FROM documents UNION SELECT doc_id FROM labels UNION SELECT conv_id FROM conversations)
SELECT key, concat_ws(',', CASE WHEN key NOT IN (SELECT doc_id FROM documents) THEN 'selected' END, CASE WHEN key NOT IN (SELECT doc_id FROM labels) THEN 'probes' END,
 CASE WHEN key NOT IN (SELECT conv_id FROM conversations) THEN 'reviews' END) AS missing FROM k""")
def key_equality(spark, sf_dir):
    key = lambda name, c: table(spark, sf_dir, name).select(c)
    return lookups.missing_keys(selected=key("documents", "doc_id"), probes=key("labels", "doc_id"), reviews=key("conversations", "conv_id"))


@query("""WITH w AS (SELECT doc_id, length(text) - length(replace(text, 'e', '')) + 1 AS line, string_split(text, chr(10)) AS lines FROM documents),
v AS (SELECT doc_id, (line % 4 + 1)::INT AS line, lines FROM w) SELECT doc_id, line, lines[line] AS content FROM v WHERE line <= len(lines)""")
def line_lookup(spark, sf_dir):
    """The line that the number of letters e in a text points at."""
    d = table(spark, sf_dir, "documents")
    wanted = d.select("doc_id", ((F.length("text") - F.length(F.replace("text", F.lit("e"), F.lit(""))) + 1) % 4 + 1).cast("int").alias("line"))
    return lookups.lines_at(d, wanted, "doc_id")


@query(_ROOTS + """, h AS (SELECT DISTINCT unnest(texts) AS keyword, domain FROM r WHERE domain IS NOT NULL)
SELECT keyword, domain, count(*) OVER (PARTITION BY keyword)::BIGINT AS of_keyword, count(*) OVER (PARTITION BY domain)::BIGINT AS of_domain FROM h""")
def keyword_navigation(spark, sf_dir):
    return lookups.navigation(root_hits(spark, sf_dir).select(F.explode("texts").alias("keyword"), "domain"), "keyword", "domain")


_TERMS = """WITH w AS (SELECT doc_id, text, regexp_extract(text, '([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 1) AS a, regexp_extract(text, '([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 2) AS b,
 regexp_extract(text, '([A-Za-z]+)[^A-Za-z]*$', 1) AS z FROM documents),
t AS (SELECT doc_id, text, a AS keyword, 0 AS part FROM w UNION ALL SELECT doc_id, text, b, 0 FROM w UNION ALL SELECT doc_id, text, z, 0 FROM w WHERE length(z) > 8 UNION ALL SELECT doc_id, text, upper(b), 1 FROM w),
s AS (SELECT *, contains(text, keyword) AS holds FROM t WHERE keyword <> '')
"""


def _terms(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    a, b, z = F.regexp_extract("text", PAIR, 1), F.regexp_extract("text", PAIR, 2), F.regexp_extract("text", r"([A-Za-z]+)[^A-Za-z]*$", 1)
    row = lambda c, part: F.struct(c.alias("keyword"), c.alias("quote"), F.lit(part).alias("part"))
    rows = d.select("doc_id", F.explode(F.array(row(a, 0), row(b, 0), row(F.when(F.length(z) > 8, z), 0), row(F.upper(b), 1))).alias("t"))
    return lookups.quoted_terms(rows.select("doc_id", "t.*").where("keyword <> ''"), d, "doc_id")


@query(_TERMS + """, f AS (SELECT lower(keyword) AS term_key, keyword, count(*) OVER (PARTITION BY lower(keyword))::BIGINT AS sources, row_number() OVER (PARTITION BY lower(keyword) ORDER BY part, doc_id, keyword) AS rn FROM s WHERE holds),
n AS (SELECT lower(keyword) AS term_key, count(DISTINCT doc_id)::BIGINT AS domains FROM s WHERE holds GROUP BY 1)
SELECT term_key, keyword, sources, domains FROM f JOIN n USING (term_key) WHERE rn = 1""")
def merged_terms(spark, sf_dir):
    return _terms(spark, sf_dir)[0]


@query(_TERMS + """SELECT doc_id, 'quote_not_found' AS problem, count(*)::BIGINT AS n FROM s WHERE NOT holds GROUP BY 1
UNION ALL SELECT doc_id, 'too_many_terms', count(*)::BIGINT FROM s WHERE part = 0 GROUP BY 1 HAVING count(*) > 2""")
def term_evidence_problems(spark, sf_dir):
    return _terms(spark, sf_dir)[1]


@query("""WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') = 0 THEN 'no_data' WHEN count(*) FILTER (WHERE event_type = 'signup') > 1 THEN 'open' ELSE 'chart' END AS status,
 max(props) FILTER (WHERE event_type = 'error') AS message, count(*) FILTER (WHERE event_type = 'view') AS points FROM events GROUP BY ALL)
SELECT * FROM (SELECT user_id, day, CASE WHEN status = 'open' THEN 'unknown_status' WHEN status = 'no_data' AND trim(coalesce(message, '')) = '' THEN 'message_missing'
 WHEN status = 'no_data' AND points > 0 THEN 'synthetic_series' END AS problem FROM c) WHERE problem IS NOT NULL""")
def no_data_guard(spark, sf_dir):
    of = lambda kind, c: F.when(F.col("event_type") == kind, c)
    status = F.when(F.count(of("purchase", F.lit(1))) == 0, "no_data").when(F.count(of("signup", F.lit(1))) > 1, "open").otherwise("chart")
    captures = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        status.alias("status"), F.max(of("error", F.col("props"))).alias("message"), F.count(of("view", F.lit(1))).alias("points")
    )
    problem = lookups.no_data_problem(F.col("status"), F.col("message"), F.col("points"))
    return captures.select("user_id", "day", problem.alias("problem")).where("problem is not null")


@query("""WITH l AS (SELECT user_id, ts, event_type, greatest(count(*) FILTER (WHERE event_type = 'click') OVER u - count(*) FILTER (WHERE event_type = 'view') OVER u, 0) AS pending,
 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, max(ts) OVER () AS now FROM events WINDOW u AS (PARTITION BY user_id))
SELECT user_id, pending::BIGINT AS pending, CASE WHEN event_type IN ('purchase', 'view') AND pending = 0 THEN 'start' WHEN event_type = 'error' OR epoch_us(now) - epoch_us(ts) > 300000000 THEN 'pause' ELSE 'wait' END AS step FROM l WHERE rn = 1""")
def stage_barrier(spark, sf_dir):
    """Users as runs: the last event is the state, clicks without a view are pending."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    runs = e.groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id", "event_type")).alias("last"),
        F.greatest(F.count(F.when(kind == "click", 1)) - F.count(F.when(kind == "view", 1)), F.lit(0)).alias("pending"),
    )
    last = F.col("last.event_type")
    status = F.when(last.isin("purchase", "view"), lookups.COMPLETE).when(last == "error", "interrupted").otherwise("running")
    step = lookups.barrier(status, F.col("pending"), F.col("last.ts"), F.col("now"))
    return runs.join(F.broadcast(e.agg(F.max("ts").alias("now")))).select("user_id", "pending", step.alias("step"))


@query("""WITH v AS (SELECT user_id, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL)
SELECT v.user_id, v.event_type, v.n, round(v.n / nullif(b.n, 0)::DOUBLE, 6) AS ratio FROM v LEFT JOIN v AS b ON b.user_id = v.user_id AND b.event_type = 'view'""")
def same_chart_ratios(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return lookups.same_chart_ratio(counts, "user_id", "event_type", "n", "view").select("user_id", "event_type", "n", F.round("ratio", 6).alias("ratio"))


from wordtide.plans import evidence as _evidence  # noqa: E402, F401  these register the queries that build on the ones above
from wordtide.plans import saved as _saved  # noqa: E402, F401
from wordtide.plans import scopes as _scopes  # noqa: E402, F401
