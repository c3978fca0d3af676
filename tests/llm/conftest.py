import re

import pytest

SPACE = re.compile(r"[\x20\x09-\x0D]+")

DOCS_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, chunk int, "
               "text_sha256 string, n long, f1 string, component_id string, x string, start string, t string")


def make_docs(spark, texts, extra=()):
    """A documents table with columns whose names the operators use inside."""
    rows = [(i, t, "en", "src0", len(t or ""), "k", 1, "s", 2, "f", "c", "x", "s", "t")
            for i, t in [*enumerate(texts), *extra]]
    return spark.createDataFrame(rows, DOCS_SCHEMA)


EDGE_TEXTS = [None, "", "  \n\t ", "word", "same  text here", "same text\there", "Same text here", "ß É 中文 🎉",
              "a" * 5000, "long words " * 4000, "long  words " * 4000, None, "x y z", "x y z"]


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty and long texts, ties, and a row that is there twice."""
    return make_docs(spark, EDGE_TEXTS, extra=[(13, "x y z"), (None, "no id at all"), (None, None)])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)
