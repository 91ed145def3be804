"""Documents with everything that may go wrong in a table."""

from __future__ import annotations

import pytest

# Columns whose names the operators use inside.
CLASHES = (
    "_text", "row", "key", "line", "id", "h", "g", "fp", "kept", "failures", "n_words", "start", "n", "rank",
    "shingle", "gone", "_all", "_c0", "_kept", "part", "left", "component_id", "closed", "ids",
)


@pytest.fixture(scope="session")
def clashing():
    def add(df):
        for name in CLASHES:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return add


@pytest.fixture(scope="session")
def make(spark, clashing):
    """A frame of (doc_id, text) rows with columns of clashing names."""

    def build(rows, schema="doc_id long, text string"):
        return clashing(spark.createDataFrame(list(rows), schema))

    return build


@pytest.fixture(scope="session")
def awkward(make):
    """NULL id, NULL text, empty and blank texts, a repeated row, a repeated id, a very long text."""
    long = "word " * 60_000 + "end"
    rows = [
        (1, "one two three four five six seven eight nine ten\nsecond line of the text is here"),
        (1, "one two three four five six seven eight nine ten\nsecond line of the text is here"),
        (1, "another text under the same id, of which nothing is repeated"),
        (None, "a text without an id\na text without an id"),
        (2, None), (3, ""), (4, " \n\t "), (5, long), (6, "é😀 ß​Ａ"),
    ]
    return make(rows), rows


@pytest.fixture(scope="session")
def empty(make):
    return make([])
