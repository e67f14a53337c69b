import pytest

#: Columns that operators use inside; inputs may have them too.
CLASH = "n int, h string, score double, size bigint, taken bigint, rep bigint, rank double, key string, base int, closing boolean, mix_size int, pii_spans string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty texts, repeated rows, ties, a very long text and clashing columns."""
    texts = [
        (1, "the quick brown fox jumps over the lazy dog and runs far away today", "en", "a", 10),
        (2, "the quick brown fox jumps over the lazy dog and runs far away now", "en", "a", 10),
        (3, None, None, None, None), (4, "", "en", "b", 0), (5, "   \n ", "de", None, 3),
        (6, "mail jo@x.example.com or +1 (017) 555-7713 from 97.51.17.173 to 4539578763621486\n" * 3, "en", "c", 5),
        (6, "mail jo@x.example.com or +1 (017) 555-7713 from 97.51.17.173 to 4539578763621486\n" * 3, "en", "c", 5),
        (7, "word " * 30_000, "fr", "a", 150_000), (8, "x" * 90_000, "fr", "a", 1), (None, "no id here", "en", "a", 2),
        (9, "\u0001 mark é🙂   1.2.3.4.5.6.7.8 a@b.c_d@e.fg", "en", "b", 1), (10, "short", "en", "a", 5), (11, "short", "en", "b", 5),
    ]
    rows = [(*t, 1, "h", 0.5, 2, 3, 4, 0.1, "k", 0, True, 1, "s") for t in texts]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
