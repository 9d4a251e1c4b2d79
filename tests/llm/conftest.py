import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text) or (doc_id, text, lang); optional extra columns."""
    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or "")) + (7,) * len(extra) for r in rows]
        return spark.createDataFrame(full, ", ".join([COLUMNS, *(f"`{c}` long" for c in extra)]))

    return make


# Nulls, empty and blank texts, repeated rows, ties, a long text, several scripts.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "words without an id here"), (4, "same text"), (4, "same text"),
       (5, "same text"), (6, "naïve 日本語 🙂🙂 ß"), (7, "long " * 300_000), (8, "x" * 200_000), (9, "a  b\n c d")]
CLASH = ("key", "fp", "score", "word", "n_words", "sample_id", "keep_id", "rid")
