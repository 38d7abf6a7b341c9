import os

import pytest

from martlet.session import build_session, tune


@pytest.fixture(scope="session")
def spark():
    session = build_session("llm-tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)  # shared with the other tests, which stop it


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and a column
    named like results."""
    a = "One two three four five six seven. " * 3
    rows = [
        (1, a, "en", "x", 1), (1, a, "en", "x", 1), (2, a.upper(), None, "x", None),
        (3, "", "en", None, 0), (None, None, None, None, None), (None, a + "eight", "en", "y", 5),
        (4, "ab " * 30000, "en", "x", 90000), (5, "a" * 50000, "de", "y", 50000),
        (6, " \t\n\x0b\x0c\r ", "en", "y", 7), (7, "mail me: a.b+c@d-e.co.uk now", "en", "x", 3),
        (8, "Zwölf große Boxkämpfer jagen Viktor quer über den Sylter Deich", "de", "y", 60),
    ]
    names = SCHEMA + ", size long, spans string, kept boolean, shard int, cls long, `row` long"
    return spark.createDataFrame([r + (9, "s", False, 3, 4, 0) for r in rows], names)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
