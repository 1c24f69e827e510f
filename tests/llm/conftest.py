import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Makes a ``documents`` table from ``(doc_id, text, source)`` rows, over a few partitions."""

    def make(rows, parts=3):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture
def folder_of(tmp_path):
    """Writes tables where a registered query reads them."""

    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make


# Nulls, empties, blanks, copies, repeated and null ids, and one long text.
ODD = [
    (1, "one two three four five six", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \t\n ", "b"),
    (5, "one two three four five six", "b"),
    (5, "one two three four five six", "b"),
    (None, "word", "c"),
    (7, "Ünï " * 4000, "c"),
    (8, "one", "ä"),
]


@pytest.fixture
def odd():
    return list(ODD)
