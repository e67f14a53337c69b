"""Queries over corrected rows and their evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.operators import corrections, pages
from wordtide.plans.catalogue import _ROOT_SPANS, _SHORT, _SHORT_GOOD, PHRASE_ROOTS, SQL_SPACE
from wordtide.plans.registry import query, table

#: Headings of the given pages that stand in for the known phrases, which invented prose does not hold.
CORPUS_RULES = (
    (r"nicht .*|.*\bcher\b.*", "recheck", "review_challenge"),
    (r"[a-z ]+ that .*", "skip", "review_parking"),
    (r"(?:to|in) .*[.]", "skip", "review_placeholder"),
)

_STRIPPED = lambda tag: f"trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1), '<[^>]*>', '', 'g'), '{SQL_SPACE}+', ' ', 'g'))"
#: Whatever is no part of a word; the word boundary of DuckDB's patterns knows ASCII only, that of the rules all letters.
_NO_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}]"
_BOUNDED = lambda p: p.replace(r".*\b", f"(?:.*{_NO_WORD})?").replace(r"\b.*", f"(?:{_NO_WORD}.*)?")
_FULL = lambda c, p: f"regexp_full_match({c}, '(?is){_BOUNDED(p)}')"
_RULE = lambda c: "CASE " + " ".join(f"WHEN {_FULL(c, p)} THEN {i}" for i, (p, _, _) in enumerate(CORPUS_RULES)) + " END"


def fetched(spark, sf_dir):
    """Pages with quick fields and a first decision that follows from the page: its size and its links."""
    t, h = pages.quick_fields(F.col("html"))
    text = lambda rx: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("html", rx, 1), "<[^>]*>", ""), r"(?U)\s+", " "))
    n = F.length("html")
    reason = F.when(n < 900, "thin_or_empty").when(F.regexp_count("html", F.lit("<a ")) < 6, "javascript_or_thin").when(n > 12000, "homepage_too_large").otherwise("html_with_content")
    decision = F.when(reason == "html_with_content", "pass").otherwise("recheck")
    p = table(spark, sf_dir, "pages")
    return p.select(
        "page_id", F.concat(F.col("page_id").cast("string"), F.lit("."), T.host_of(F.col("url"))).alias("domain"), t.alias("title"), F.array(h, F.lower(h)).alias("h1"),
        text(r'(?is)<div class="ad">(.*?)</div>').alias("description"), decision.alias("decision"), reason.alias("reason"), (n % 4 == 0).alias("incomplete"),
    )


def review_ledger(spark, sf_dir):
    """An append-only ledger: reviews of headings, then two passes of a labelling by the labels table, the later of which takes
    some corrections back."""
    p = fetched(spark, sf_dir).select("page_id", "domain", corrections.heading_review(F.col("title"), F.col("h1"), CORPUS_RULES).alias("r")).where("r is not null")
    both = F.explode(F.array(F.struct(F.lit("decision").alias("field"), F.col("r.decision").alias("value")), F.struct(F.lit("reason").alias("field"), F.col("r.reason").alias("value"))))
    first = p.select("domain", F.lit(1).cast("long").alias("version"), both.alias("x"), F.lit("headings").alias("origin")).select("domain", "version", "x.field", "x.value", "origin")
    l = table(spark, sf_dir, "labels").join(fetched(spark, sf_dir).select(F.col("page_id").alias("doc_id"), "domain"), "doc_id")
    second = l.where("quality = 0").select("domain", F.lit(2).cast("long").alias("version"), F.lit("reason").alias("field"), F.lit("low_quality").alias("value"), F.lit("labels").alias("origin"))
    third = l.where("quality = 1").select("domain", F.lit(3).cast("long").alias("version"), F.lit("decision").alias("field"), F.when(F.col("toxic") == 1, "skip").alias("value"), F.lit("labels").alias("origin"))
    return first.unionByName(second).unionByName(third)


def corrected(spark, sf_dir):
    return corrections.overlay(fetched(spark, sf_dir), review_ledger(spark, sf_dir), "domain", ("decision", "reason"))


_FETCHED = (
    "pg AS (SELECT page_id, page_id::VARCHAR || '.' || lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS domain, " + _STRIPPED("title") + " AS title, " + _STRIPPED("h1") + " AS h,"
    " trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<div class=\"ad\">(.*?)</div>', 1), '<[^>]*>', '', 'g'), '" + SQL_SPACE + "+', ' ', 'g')) AS description, length(html) AS n, len(regexp_extract_all(html, '<a ')) AS links FROM pages),"
    " ft AS (SELECT *, CASE WHEN n < 900 THEN 'thin_or_empty' WHEN links < 6 THEN 'javascript_or_thin' WHEN n > 12000 THEN 'homepage_too_large' ELSE 'html_with_content' END AS reason0 FROM pg),"
    " fe AS (SELECT *, CASE WHEN reason0 = 'html_with_content' THEN 'pass' ELSE 'recheck' END AS decision0, n % 4 = 0 AS incomplete FROM ft),"
    f" hr AS (SELECT page_id, domain, CASE WHEN rt IS NOT NULL THEN 'title' WHEN coalesce(rh, ru) IS NOT NULL THEN 'h1' END AS field, CASE WHEN rt IS NOT NULL THEN title WHEN rh IS NOT NULL THEN h WHEN ru IS NOT NULL THEN lower(h) END AS quote, coalesce(rt, rh, ru) AS rule"
    f" FROM (SELECT *, {_RULE('title')} AS rt, {_RULE('h')} AS rh, {_RULE('lower(h)')} AS ru FROM fe)),"
    " lb AS (SELECT f.domain, l.quality, l.toxic FROM labels l JOIN fe f ON l.doc_id = f.page_id),"
    " hj AS (SELECT page_id, domain, field, quote, rule, ['" + "','".join(d for _, d, _ in CORPUS_RULES) + "'][rule + 1] AS decision, ['" + "','".join(r for _, _, r in CORPUS_RULES) + "'][rule + 1] AS reason FROM hr),"
    " hv AS (SELECT * FROM hj WHERE rule IS NOT NULL),"
    " lg AS (SELECT domain, 1 AS version, 'decision' AS field, decision AS value, 'headings' AS origin FROM hv UNION ALL SELECT domain, 1, 'reason', reason, 'headings' FROM hv"
    " UNION ALL SELECT domain, 2, 'reason', 'low_quality', 'labels' FROM lb WHERE quality = 0 UNION ALL SELECT domain, 3, 'decision', CASE WHEN toxic = 1 THEN 'skip' END, 'labels' FROM lb WHERE quality = 1),"
    " la AS (SELECT * FROM lg QUALIFY row_number() OVER (PARTITION BY domain, field ORDER BY version DESC, origin DESC, value DESC NULLS LAST) = 1),"
    " co AS (SELECT fe.*, coalesce(d.value, decision0) AS decision, coalesce(r.value, reason0) AS reason, concat_ws('|', CASE WHEN d.value IS NOT NULL THEN 'decision@' || d.version || ':' || d.origin END, CASE WHEN r.value IS NOT NULL THEN 'reason@' || r.version || ':' || r.origin END) AS provenance"
    " FROM fe LEFT JOIN la d ON d.domain = fe.domain AND d.field = 'decision' LEFT JOIN la r ON r.domain = fe.domain AND r.field = 'reason')"
)


@query("WITH " + _FETCHED + " SELECT page_id, decision, reason, field, quote FROM hj")
def heading_corrections(spark, sf_dir):
    """The review of every page's headings."""
    r = corrections.heading_review(F.col("title"), F.col("h1"), CORPUS_RULES)
    return fetched(spark, sf_dir).select("page_id", r.alias("r")).select("page_id", "r.decision", "r.reason", "r.field", "r.quote")


@query("WITH " + _FETCHED + " SELECT page_id, decision, reason, decision0 AS original_decision, reason0 AS original_reason, provenance FROM co")
def corrected_pages(spark, sf_dir):
    """The last correction of each field, with where it comes from."""
    said = F.array_join(F.transform("provenance", lambda p: F.concat(p["field"], F.lit("@"), p["version"].cast("string"), F.lit(":"), p["origin"])), "|")
    return corrected(spark, sf_dir).select("page_id", "decision", "reason", "original_decision", "original_reason", said.alias("provenance"))


@query("WITH " + _FETCHED + """, ce AS (SELECT reason0 AS original, reason AS corrected, count(*) AS n FROM co GROUP BY ALL)
SELECT original, corrected, n::BIGINT AS n, (sum(n) OVER (PARTITION BY original))::BIGINT AS original_total, (sum(n) OVER (PARTITION BY corrected))::BIGINT AS corrected_total FROM ce""")
def corrected_histogram(spark, sf_dir):
    return corrections.contingency(corrected(spark, sf_dir), "reason")


FIELDS = (("title", "title"), ("h1", "h1"), ("description", "description"))
MARKETING = r"(?:^| )(?:the|che|sch)(?: |$)"
GENERIC = ("and the", "the and")


def _index(spark, sf_dir):
    return corrections.field_evidence(corrected(spark, sf_dir), FIELDS, order="page_id", roots=PHRASE_ROOTS)


_CANON = lambda c: f"replace(lower(trim(regexp_replace({c}, '{SQL_SPACE}+', ' ', 'g'))), 'ß', 'ss')"
_SIGHTS = (
    _ROOT_SPANS.replace("WITH s AS", "WITH " + _FETCHED.replace("\\", "\\") + """,
so AS (SELECT page_id, domain, decision, reason, incomplete, 0 AS fo, 'title' AS field, 0 AS vo, title AS quote FROM co UNION ALL SELECT page_id, domain, decision, reason, incomplete, 1, 'h1', 0, h FROM co
 UNION ALL SELECT page_id, domain, decision, reason, incomplete, 1, 'h1', 1, lower(h) FROM co UNION ALL SELECT page_id, domain, decision, reason, incomplete, 2, 'description', 0, description FROM co),
us AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY page_id, fo, vo) AS doc_id, quote AS text FROM so WHERE decision = 'pass' OR reason IN ('javascript_or_thin', 'thin_or_empty', 'homepage_too_large')), s AS""", 1).replace("FROM documents", "FROM us")
    + ", b AS (SELECT doc_id, phrase, min(sid) AS sid FROM (" + _SHORT.replace("{k}", "doc_id").replace("{t}", "text").replace("{rows}", "us") + ") WHERE " + _SHORT_GOOD + " GROUP BY ALL),"
    " rr AS (SELECT doc_id, phrase, row_number() OVER (PARTITION BY doc_id ORDER BY phrase) AS po FROM r),"
    " ph AS (SELECT coalesce(rr.doc_id, b.doc_id) AS doc_id, coalesce(rr.phrase, b.phrase) AS phrase, (rr.po IS NULL, coalesce(rr.po, b.sid)) AS po, CASE WHEN b.phrase IS NULL THEN 'literal_root_span' ELSE 'short_literal_segment' END AS method FROM rr FULL JOIN b ON rr.doc_id = b.doc_id AND rr.phrase = b.phrase),"
    f" si AS (SELECT {_CANON('phrase')} AS term, us.domain, us.field, us.quote, phrase AS keyword, method, us.decision, us.reason, us.incomplete, page_id, fo, vo, po FROM ph JOIN us USING (doc_id)),"
    " ev AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY page_id, fo, vo, po, domain NULLS FIRST, field, quote) AS sight FROM (SELECT * FROM si QUALIFY row_number() OVER (PARTITION BY term, domain, field, quote ORDER BY page_id, fo, vo, po, keyword, method, decision, reason, incomplete NULLS FIRST) = 1))"
)


@query(_SIGHTS + " SELECT term, domain, field, quote, keyword, method, decision FROM ev")
def expansion_evidence(spark, sf_dir):
    """Literal phrases of all fields of usable pages, after corrections, with their evidence."""
    return _index(spark, sf_dir).select("term", "domain", "field", "quote", "keyword", "method", "decision")


@query(_SIGHTS + f""", ti AS (SELECT term, arg_min(keyword, (page_id, fo, vo, po, keyword)) AS keyword, count(*)::BIGINT AS evidence, count(DISTINCT domain)::BIGINT AS domains, bool_or(decision = 'pass' AND NOT incomplete) AS complete,
 string_agg(domain || ' ' || field || ' ' || method, ',' ORDER BY sight) FILTER (WHERE sight <= 10) AS first_evidence FROM ev GROUP BY 1),
pr AS (SELECT DISTINCT {_CANON("unnest(regexp_extract_all(text, '[A-Za-z]+ [A-Za-z]+'))")} AS term FROM benchmark)
SELECT term, keyword, evidence, domains, term NOT IN (SELECT term FROM pr) AS is_new, CASE WHEN regexp_matches(keyword, '(?i){MARKETING}') OR term IN ('and the', 'the and') THEN 'phrase_review' WHEN complete THEN 'ready_for_semantic_review' ELSE 'metadata_only' END AS review_status, first_evidence FROM ti""")
def expansion_terms(spark, sf_dir):
    """The index of terms; those of the benchmark's texts count as known before."""
    prior = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+ [A-Za-z]+"), 0)).alias("keyword"))
    terms = corrections.expansion_index(_index(spark, sf_dir), prior, marketing=MARKETING, generic=GENERIC)
    said = F.array_join(F.transform("first_evidence", lambda e: F.concat_ws(" ", e["domain"], e["field"], e["method"])), ",")
    return terms.withColumn("first_evidence", said)


@query(_SIGHTS + """, n AS (SELECT domain, count(DISTINCT term)::BIGINT AS keywords FROM ev GROUP BY 1)
SELECT co.domain, coalesce(keywords, 0)::BIGINT AS keywords, CASE WHEN keywords > 0 THEN 'literal_candidates' WHEN (decision = 'pass' OR reason IN ('javascript_or_thin', 'thin_or_empty', 'homepage_too_large')) AND (title <> '' OR h <> '' OR description <> '') THEN 'needs_semantic_review' ELSE 'no_usable_page_fields' END AS keyword_status
FROM co LEFT JOIN n USING (domain)""")
def page_keywords(spark, sf_dir):
    return corrections.page_keywords(corrected(spark, sf_dir), _index(spark, sf_dir), FIELDS)
