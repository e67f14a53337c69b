"""Corrections laid over saved rows, and the index of phrases that follows from the corrected rows
(P10, F7, G10, E8, E9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.functions import vocab as V
from wordtide.operators import phrases

#: Reasons of pages whose fields are used although the page did not pass.
USABLE = ("javascript_or_thin", "thin_or_empty", "homepage_too_large")


def heading_review(title: Column, h1: Column, rules: Sequence[tuple[str, str, str]] = V.REVIEW_RULES) -> Column:
    """P10: struct(decision, reason, field, quote) of the first heading, title first, that is one of the known phrases as a
    whole; at one heading the first of ``rules(pattern, decision, reason)`` counts. Null if there is none."""

    def judged(field: str):
        def one(h: Column) -> Column:
            found = F.lit(None)
            for pattern, decision, reason in reversed(rules):
                hit = F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"), F.lit(field).alias("field"), h.alias("quote"))
                found = F.when(T.full_match(F.trim(h), pattern), hit).otherwise(found)
            return found

        return one

    heads = F.concat(F.transform(F.array(title), judged("title")), F.transform(F.coalesce(h1, F.array().cast("array<string>")), judged("h1")))
    return F.get(F.filter(heads, lambda x: x.isNotNull()), F.lit(0))


def latest_corrections(corrections: DataFrame, key: str) -> DataFrame:
    """One row per key: map of field -> struct(value, version, origin), each field's last version only.

    ``corrections(key, version, field, value, origin)`` is an append-only ledger; a field's versions are reduced with a
    partial maximum, so one much-corrected row is no problem. Of one version twice the greater (origin, value) counts. A last
    version with a null value takes the correction back. Fields are as few as the columns of the corrected table.
    """
    last = F.max(F.struct("version", "origin", F.col("value").isNotNull().alias("given"), "value")).alias("l")
    per_field = corrections.where(F.col(key).isNotNull() & F.col("field").isNotNull()).groupBy(key, "field").agg(last).where("l.given")
    entry = F.struct("field", F.struct("l.value", "l.version", "l.origin").alias("c"))
    return per_field.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("corrections"))


def overlay(rows: DataFrame, corrections: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``fields`` as corrected, what they were (``original_*``), and ``provenance``: struct(field, version, origin) of every
    correction that was applied, by field. Rows without corrections stay; corrections of unknown rows or fields do nothing.
    A correction that says what the field says already is applied, and shows in the provenance.
    """
    found = rows.join(latest_corrections(corrections, key), key, "left")
    given = lambda f: F.try_element_at("corrections", F.lit(f))
    kinds = dict(rows.dtypes)
    fixed = {f: F.coalesce(given(f)["value"].cast(kinds[f]), F.col(f)) for f in fields}
    before = {f"original_{f}": F.col(f) for f in fields}
    known = F.filter(F.map_entries(F.coalesce("corrections", F.map_from_entries(F.array().cast("array<struct<k:string,v:struct<value:string,version:bigint,origin:string>>>")))), lambda e: e["key"].isin(*fields))
    provenance = F.transform(known, lambda e: F.struct(e["key"].alias("field"), e["value"]["version"].alias("version"), e["value"]["origin"].alias("origin")))
    rest = [c for c in rows.columns if c not in fields]
    return found.select(*rest, *[fixed[f].alias(f) for f in fields], *[c.alias(n) for n, c in before.items()], F.array_sort(provenance).alias("provenance"))


def contingency(corrected: DataFrame, field: str) -> DataFrame:
    """Rows per (original, corrected) value of a field, with the totals of either side, nulls as their own value."""
    cells = corrected.groupBy(F.col(f"original_{field}").alias("original"), F.col(field).alias("corrected")).agg(F.count("*").alias("n"))
    total = lambda side: F.sum("n").over(Window.partitionBy(side))  # noqa: E731  over cells, not rows
    return cells.withColumn("original_total", total("original")).withColumn("corrected_total", total("corrected"))


def usable(decision: Column, reason: Column) -> Column:
    return F.coalesce(decision == "pass", F.lit(False)) | F.coalesce(reason.isin(*USABLE), F.lit(False))


def field_evidence(rows: DataFrame, fields: Sequence[tuple[str, str]], key: str = "domain", order: str = "row_order", roots: Sequence[str] = V.ROOTS) -> DataFrame:
    """The evidence of every literal phrase (E6) in ``fields`` (name, column) of usable rows, told apart by (term, key, field,
    quote): term, key, field, quote, keyword, method, decision, reason, incomplete, seen.

    ``term`` is the canonical keyword; ``seen`` places the first sight of it (row, field, value, phrase), ``keyword`` and
    ``method`` are those of that sight. ``rows`` are corrected already: key, order, decision, reason, incomplete, and the columns.
    """
    kinds = dict(rows.dtypes)
    sources = [
        F.transform(
            F.coalesce(column, F.array().cast("array<string>")) if kinds[column].startswith("array") else F.array(column),
            (lambda at, name: lambda v, i: F.struct(F.lit(at).alias("field_order"), F.lit(name).alias("field"), i.alias("value_order"), v.alias("quote")))(at, name),
        )
        for at, (name, column) in enumerate(fields)
    ]
    values = rows.where(usable(F.col("decision"), F.col("reason"))).select(key, order, "decision", "reason", "incomplete", F.explode(F.concat(*sources)).alias("s"))
    found = values.where("s.quote is not null").select(
        key, order, "decision", "reason", "incomplete", "s.*", F.posexplode(phrases.literal_phrases(F.col("s.quote"), roots)).alias("phrase_order", "p")
    )
    seen = F.struct(F.col(order).alias("row"), "field_order", "value_order", "phrase_order")
    first = F.min(F.struct(seen.alias("seen"), F.col("p.phrase").alias("keyword"), F.col("p.method").alias("method"), "decision", "reason", "incomplete"))
    return found.groupBy(T.canonical(F.col("p.phrase")).alias("term"), key, "field", "quote").agg(first.alias("e")).select("term", key, "field", "quote", "e.*")


def expansion_index(evidence: DataFrame, prior: DataFrame, key: str = "domain", marketing: str = V.MARKETING, generic: Sequence[str] = V.GENERIC_TERMS, examples: int = 10) -> DataFrame:
    """Per term its keyword as first spelt, counts of evidence and keys, whether it is new to ``prior(keyword)``, its review
    status, and the first ``examples`` pieces of evidence as an array. The whole evidence stays a table of its own: a common term
    has as many rows there as it likes, and only counts, a minimum and a bounded list of each group are brought together.
    """
    whole = (F.col("decision") == "pass") & ~F.coalesce("incomplete", F.lit(False))
    terms = evidence.groupBy("term").agg(
        F.min(F.struct("seen", "keyword"))["keyword"].alias("keyword"), F.count("*").alias("evidence"), F.countDistinct(key).alias("domains"),
        F.coalesce(F.max(whole), F.lit(False)).alias("complete"),
    )
    rank = F.row_number().over(Window.partitionBy("term").orderBy("seen", key, "field", "quote"))
    some = evidence.withColumn("_rank", rank).where(F.col("_rank") <= examples)
    some = some.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("_rank", key, "field", "quote", "method"))).alias("e"))
    some = some.select("term", F.transform("e", lambda x: x.dropFields("_rank")).alias("first_evidence"))
    known = prior.select(T.canonical(F.col("keyword")).alias("term")).distinct().withColumn("_known", F.lit(True))
    status = (
        F.when(T.found_in(F.col("keyword"), marketing) | F.col("term").isin(*generic), "phrase_review")
        .when(F.col("complete"), "ready_for_semantic_review")
        .otherwise("metadata_only")
    )
    out = terms.join(some, "term").join(known, "term", "left")
    return out.select("term", "keyword", "evidence", "domains", F.col("_known").isNull().alias("is_new"), status.alias("review_status"), "first_evidence")


def page_keywords(rows: DataFrame, evidence: DataFrame, fields: Sequence[tuple[str, str]], key: str = "domain") -> DataFrame:
    """Per row its number of terms and what is to be done: literal_candidates, needs_semantic_review (usable fields without a
    term) or no_usable_page_fields."""
    terms = evidence.groupBy(key).agg(F.countDistinct("term").alias("keywords"))
    kinds = dict(rows.dtypes)
    filled = F.lit(False)
    for _, c in fields:
        filled = filled | F.coalesce(F.exists(c, lambda v: v != "") if kinds[c].startswith("array") else F.col(c) != "", F.lit(False))
    n = F.coalesce("keywords", F.lit(0).cast("long"))
    status = F.when(n > 0, "literal_candidates").when(usable(F.col("decision"), F.col("reason")) & filled, "needs_semantic_review").otherwise("no_usable_page_fields")
    return rows.join(terms, key, "left").select(key, n.alias("keywords"), status.alias("keyword_status"))
