import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from texts or (doc_id, text[, lang]) tuples, with the columns of the table."""

    def build(*rows):
        full = []
        for at, row in enumerate(rows):
            doc_id, text, *lang = row if isinstance(row, tuple) else (at, row)
            full.append((doc_id, text, lang[0] if lang else None, "s", None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return build


#: Texts that every operator must take: missing, empty, blank, without words of any kind, very long, not ASCII.
ODD = [None, "", " \n\t ", "...", "a", "é", "word " * 30_000, " ", "line\n\n\nline", "🙂 🙂", "x" * 50_000, "\r\n"]
