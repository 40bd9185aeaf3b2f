import pytest


def bag(df):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of doc_id, text and columns whose names the operators use themselves."""

    def make(rows):
        schema = (
            "doc_id long, text string, source string, lang string, keep_id string, digest string, size int, "
            "text_hash string, class_key string, label string, _metadata string, locator_row string, score string"
        )
        full = [(i, t, s, "en", "k", "d", 1, "h", "c", "l", "m", "r", "s") for i, t, s in rows]
        return spark.createDataFrame(full, schema)

    return make


LONG = " ".join(f"word{i % 997} and{i % 89}" for i in range(60_000))
ODD_ROWS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "   \n\t ", None),
    (None, "null id text one two three four five six", "b"),
    (None, "null id text one two three four five six", "b"),
    (4, "same words here for a tie of two documents", "b"),
    (5, "same words here for a tie of two documents", None),
    (5, "same words here for a tie of two documents", None),
    (6, LONG, "a"),
    (7, LONG + " end", "c"),
    (8, "naïve Größe ÀÉ 日本語 😀 words beyond ascii", ""),
    (9, "a b", "c"),
]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD_ROWS)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
