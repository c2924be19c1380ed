import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """A documents frame of (doc_id, text) pairs or whole rows."""

    def build(rows, schema=DOCS):
        width = schema.count(",") + 1
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)

    return build


#: Rows that every operator on documents must answer: nulls, empty and white-space texts,
#: repeated rows, a very long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one two three four five six seven eight nine ten"),
    (4, "one two three four five six seven eight nine ten"),
    (5, "one two  three four five six seven eight nine ten"),
    (None, "a text without a key"),
    (6, "word " * 40_000),
]


@pytest.fixture
def odd(frame):
    return frame(ODD)


@pytest.fixture
def clashing(frame):
    """Documents with more columns, named like those that operators make."""
    names = "bits root score predicted ids part at block rank target kept uid ord row item_id seed chunks".split()
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names)
    return frame([(1, "alpha beta gamma", "a"), (2, "alpha beta gamma", None)], schema)
