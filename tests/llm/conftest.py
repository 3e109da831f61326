import pytest

#: Names that operators use inside, as extra columns of the input.
EXTRA = ("id", "held", "raw", "words", "score", "node", "n", "size", "bytes", "n_tokens", "kept", "items", "host", "label", "th", "h")


@pytest.fixture(scope="session")
def documents(spark):
    """(rows of (doc_id, text)) to a frame with clashing extra columns."""

    def make(rows, extra=True):
        names = EXTRA if extra else ()
        schema = "doc_id bigint, text string" + "".join(f", `{n}` string" for n in names)
        return spark.createDataFrame([(i, t, *(["x"] * len(names))) for i, t in rows], schema)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and white texts, repeated rows, odd characters, a very long text."""
    long = " ".join(f"word{k % 977} and, the {k}." for k in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t \n"), (4, "one two three four five six seven eight nine ten eleven."), (4, "one two three four five six seven eight nine ten eleven."), (None, "null id here"), (5, "é à ü 日本語 <|endoftext|> 'll don't\u00a0x \x1c y"), (6, long), (7, "a" * 5000), (8, "\x00 nul")]
