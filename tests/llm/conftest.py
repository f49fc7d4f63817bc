import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, _row string, scan string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) tuples; further columns carry clashing names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1]), "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = " ".join(f"word{k % 977} tail{k % 13}" for k in range(30_000))

# Null, empty, blank and very long texts, ties, repeated rows, null and repeated ids.
EDGES = [
    (1, None, None),
    (2, "", "en"),
    (3, " \t\n ", "en"),
    (4, LONG, "en"),
    (5, "the same words stand here twice in this row", "en"),
    (5, "the same words stand here twice in this row", "en"),
    (5, "but this row has other words under the same id", "fr"),
    (None, "a row without an id", "en"),
    (None, None, None),
    (6, "12345 67890 !!! ???", "en"),
    (7, "Ünïcode wörds ñandú 北京 \U0001f600 \x1c\x85 end", "de"),
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGES)


@pytest.fixture(scope="session")
def edge_rows():
    return EDGES
