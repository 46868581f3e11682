import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or full rows."""

    def build(rows):
        full = [
            (*row, "en", "a", len(row[1] or "")) if len(row) == 2 else row for row in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return build


# Texts that every operator has to take: null, empty, blank, one word, ties, a very long one.
ODD_TEXTS = [None, "", " \t\n", "word", "word", "É ü ñ", "a" * 300, "one two " * 20_000]


@pytest.fixture
def odd_documents(documents):
    rows = [(k, text) for k, text in enumerate(ODD_TEXTS)]
    return documents([*rows, (None, "no id here"), rows[3], (3, "word")])


@pytest.fixture
def clashing():
    """Adds columns named as the operators name their own."""
    from pyspark.sql import functions as F

    def add(df):
        for name in ("id", "row", "words", "fp", "key", "kept", "spans", "label", "host", "of_id",
                     "score", "weight", "copy_id", "told", "first", "tokens", "topic"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit("mine"))
        return df

    return add
