"""Page fields in bounded pieces, and fragments of all fields in one pass."""

import tracemalloc

import pyarrow as pa

from wordtide.operators import pages, phrases
from wordtide.plans import catalogue

from .conftest import DATA


def test_pages_of_a_batch_are_read_a_few_at_a_time():
    """what is held of a batch as Python objects does not grow with its pages."""
    html = pa.array(["<title>A %d</title><h1>B</h1><p>%s</p>" % (i, "ä€x " * 5000) for i in range(20 * pages.SLICE)] + [None])
    tracemalloc.start()
    got = pages._fields_batch(html)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == len(html) and got[0]["title"].as_py() == "A 0" and got[-1].as_py() == pages.read_fields(None)
    assert peak < 20e6  # all pages at once are 51 MB
    assert len(pages._fields_batch(html.slice(0, 0))) == 0


def test_fragments_read_the_fields_once(spark):
    """one pass over the pages, whatever the number of fields."""
    plan = catalogue.QUERIES["page_fragments"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_fragments_of_missing_fields(spark):
    df = spark.createDataFrame([(1, None, None, "One two. Three four"), (2, ["Alpha beta", None, "alpha BETA | Gamma ray"], "Title", None), (3, [], None, None)], "k int, h1 array<string>, title string, description string")
    got = phrases.page_fragments(df, "k", [("h1", "h1"), ("title", "title"), ("description", "description")]).orderBy("k", "rank").collect()
    assert [tuple(r) for r in got] == [
        (1, 1, "description", "One two."), (1, 2, "description", "Three four"), (2, 1, "h1", "Alpha beta"), (2, 2, "h1", "Gamma ray"), (2, 3, "title", "Title"),
    ]
