import pytest

from tidewater.llm.registry import on_workers

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, word string, run int"


@pytest.fixture
def make(spark):
    """A documents table with clashing extra columns from (doc_id, text[, source])."""
    on_workers(spark)

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or ""), "x", "y", 1)
                for r in rows]
        return spark.createDataFrame(full, COLUMNS)
    return build


#: nulls, empty texts, repeated rows, ties and a very long text
ODD = [(1, None), (2, ""), (3, "one two three four five six seven"),
       (3, "one two three four five six seven"), (4, "one two three four five six seven"),
       (None, "a null id"), (5, "word " * 30_000), (6, " \n\t "), (7, "Ünï cödé tëxt ± 日本 x")]


@pytest.fixture
def odd(make):
    return make(ODD)
