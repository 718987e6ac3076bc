import pytest

from samples import sentence

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, length int, "
    "_doc string, _digest string, _spans int, _copies int, _rows int, _own_digest string, _nth int, _quality double, "
    "doc string, size double, copy int, spans string, place int, `a.b` string, nested array<map<string,int>>"
)
EXTRA = (0.5, "x", 7, "d", None, 1, 2, 3, "o", 4, 0.9, "e", 1.5, 6, "s", 8, None, [{"k": 1}, None])

@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = sentence(1, 60_000)
    rows = [
        (1, "", "en", "a", 0), (2, None, None, None, None), (None, sentence(2, 40), "en", "a", 5), (None, None, None, "b", None),
        (3, sentence(3, 300), "en", "a", 9), (3, sentence(3, 300), "en", "a", 9), (3, sentence(4, 30), "de", "b", 9),
        (4, long, "en", "b", 1), (5, long, "en", "b", 1), (6, " \n\t ", "fr", "c", 3), (7, "one two", "en", None, -1),
        (8, "One  TWO", "en", "c", 0), (9, sentence(3, 300).upper(), None, "c", 2), (10, "\n".join([sentence(5, 9)] * 40), "en", "a", 1),
    ]
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
