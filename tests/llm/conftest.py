"""Small hostile tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, n_words string"



@pytest.fixture
def table(spark):
    """Documents of (id, text) pairs, with columns whose names clash with results."""
    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return build


@pytest.fixture(scope="session")
def sample(spark):
    """Texts of the driver's smallest table, for comparisons on realistic input."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


EDGES = [(None, "a null id"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "é漢\U0001f600  x"), (6, "\n\n")]


@pytest.fixture
def edges():
    return list(EDGES)


def by_id(df):
    """Rows as sorted tuples without the order of nulls."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
