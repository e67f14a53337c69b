"""Queries against their SQL on texts that the given tables hardly hold: letters, white space and ties beyond the plain ones."""

import duckdb
import pytest

from wordtide.plans import catalogue
from wordtide.plans import evidence  # noqa: F401  registers its queries

from .test_catalogue import rows

SCHEMAS = {
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, text string",
    "benchmark": "item_id bigint, text string",
}


def page(i, title, h1="", ad="", url="https://www.a.example/x"):
    filler = "<p>" + "x" * 900 + "</p>" + "<a href='#'>y</a>" * 7
    return (i, url and url.replace("a.", f"a{i}."), f"<title>{title}</title><h1>{h1}</h1><div class=\"ad\">{ad}</div>{filler}")


def agree(spark, folder, name, **tables):
    for t, schema in SCHEMAS.items():
        spark.createDataFrame(tables.get(t, []), schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, str(folder))
    got, result = [r.asDict() for r in df.collect()], con.sql(catalogue.ORACLE_SQL[name])
    assert rows(df.columns, [tuple(r.values()) for r in got]) == rows(result.columns, result.fetchall())
    return got


TEXTS = [
    (1, "ench ßheitte the ungerung"), (2, "bright the sky. one two"), (3, "ﬁne\u000bthe day - x"), (4, "red the.comö blue"), (5, " plain words "),
    (6, "one two.\u0085three four"), (7, "a – the new one"), (8, "see x.com here"), (9, "Groß and klein İ"), (10, None),
]


def test_literal_root_phrases(spark, tmp_path):
    """phrases are case folded, so ß is two letters, and white space is Unicode's."""
    got = {(r["doc_id"], r["phrase"]) for r in agree(spark, tmp_path, "literal_root_phrases", documents=TEXTS)}
    assert (1, "ench ssheitte the ungerung") in got and (2, "bright the sky") in got


def test_literal_phrases(spark, tmp_path):
    """both kinds, split and stripped at the same white space; an address ends with its word."""
    got = {(r["doc_id"], r["phrase"], r["method"]) for r in agree(spark, tmp_path, "literal_phrases", documents=TEXTS)}
    assert {(1, "ench ssheitte the ungerung", "literal_root_span"), (5, "plain words", "short_literal_segment"), (4, "red the.comö blue", "short_literal_segment")} <= got


HEADINGS = [
    page(1, "Der enausch cherö, ä"), page(2, "cher ami"), page(3, "Ächer"), page(4, "in", "x  cher"), page(5, "acher", "Nicht so"),
    page(6, "cher", url=None), page(7, "z", "cher_"), (8, "https://b.example/", None),
]


def test_heading_corrections(spark, tmp_path):
    """a letter beyond ASCII is part of a word, and a page without a host has a review too."""
    got = agree(spark, tmp_path, "heading_corrections", pages=HEADINGS)
    assert {r["page_id"]: r["quote"] for r in got} == {1: None, 2: "cher ami", 3: None, 4: "x cher", 5: "Nicht so", 6: "cher", 7: None, 8: None}


def test_corrected_pages(spark, tmp_path):
    """the corrections follow the same headings; of one version twice the greater value counts."""
    labels = [(2, 1, 0), (2, 1, 1), (3, 1, 1), (3, 1, 0), (4, 0, 1)]
    got = {r["page_id"]: r for r in agree(spark, tmp_path, "corrected_pages", pages=HEADINGS, labels=labels)}
    assert (got[1]["decision"], got[1]["provenance"]) == ("pass", "")
    assert got[2]["decision"] == got[3]["decision"] == "skip" and got[4]["reason"] == "low_quality"


def test_corrected_histogram(spark, tmp_path):
    """the table of reasons follows the corrected pages."""
    got = agree(spark, tmp_path, "corrected_histogram", pages=HEADINGS)
    assert {r["corrected"]: r["n"] for r in got} == {"html_with_content": 5, "review_challenge": 3}


SIGHTS = [
    page(1, "Der enausch cherö ä", "Weiß and süß", "one line"), page(2, "ench ßheitte the ungerung", "One  Line"), page(3, "cher ami", "one line"),
    page(4, "weiß and süß", "", "ench ssheitte the ungerung"), page(5, "ONE LINE", "one line"), page(5, "one line", url="https://b.a.example/"),
]


@pytest.mark.parametrize("name", ["expansion_evidence", "expansion_terms", "page_keywords"])
def test_sights(spark, tmp_path, name):
    """Evidence of fields whose words hold letters beyond ASCII, with a page id that occurs twice."""
    got = agree(spark, tmp_path, name, pages=SIGHTS, benchmark=[(1, "one line")])
    if name == "page_keywords":
        assert {r["domain"]: r["keyword_status"] for r in got}["1.www.a1.example"] == "literal_candidates"
    else:
        assert "ench ssheitte the ungerung" in {r["term"] for r in got}
