from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def llm(spark):
    """The session with this package shipped to its workers."""
    from wagegrid.llm.shared import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def queries():
    import __spark_entry__

    return __spark_entry__.queries()


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, g int"


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    extra columns whose names the operators use themselves."""
    long = " ".join(f"word{i % 977} und{i % 31}" for i in range(9000))
    line = "this very passage of more than fifty bytes is found in several documents "
    rows = [
        (1, "Hello  world <|endoftext|> again\n\nand again", "en", "a", 1, "x", 1),
        (2, None, "en", None, None, None, None), (3, "", None, "a", 0, "y", 2),
        (4, long, "de", "b", 9, "z", 3), (5, long, "de", "b", 9, "z", 3),
        (6, line + "one", "en", "c", 5, "x", 4), (7, "two " + line, "en", "c", 5, "x", 4),
        (7, "two " + line, "en", "c", 5, "x", 4), (8, "é" * 120, None, None, 3, None, None),
        (9, "a" * 3000, None, None, 3, None, None), (10, "  \t\n ", "en", "q", 4, "", 0),
        (None, line + "no id", "en", "c", 5, "x", 4), (11, "12345 !!! $$$", "fr", "d", 2, "x", 9),
        (12, "x" * 200 + " " + "y" * 90000, "en", "c", 5, "x", 4),
    ]
    return llm.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)
