import pytest

from tests.llm.brute import LONG

#: Ids, texts, langs and sources with nulls, an empty text, ties, repeated rows and a very long text.
ODD = [
    (1, "One two three four five six seven eight nine ten.\nA line that is long enough to count", "en", "a"),
    (1, "One two three four five six seven eight nine ten.\nA line that is long enough to count", "en", "a"),
    (2, "one TWO three four five six seven eight nine ten.\n  a LINE that is long enough to count \t", "en", "a"),
    (3, "un deux trois quatre cinq six\na line that is long enough to count\n\n", "fr", None),
    (4, None, "fr", "b"),
    (5, "", None, "b"),
    (6, " \n\t ", "de", ""),
    (None, "one two three", "de", "b"),
    (None, None, None, None),
    (7, LONG, "de", "a"),
    (8, LONG + " tail", "de", "c"),
    (9, "é ü <|endoftext|> \x1c\x85  don't 123 ½ 😀 </s>[INST]", None, "c"),
    (10, "a b", "en", "c"),
    (11, "A  B", "en", "c"),
    (12, "1234 %% !!", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns that have the names of results and of intermediate columns."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    clash = "n_words kept size copies target lost_id lost_digests shortened host mix_target ids id digest a b component"
    return rows.selectExpr("*", *[f"'x' AS {name}" for name in clash.split()], "length(text) AS n_chars")


@pytest.fixture(scope="session")
def none(odd):
    """The same columns without rows."""
    return odd.limit(0)
