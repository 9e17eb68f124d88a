import hashlib
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Texts as a documents table; ids are given or counted."""

    def build(*texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture(scope="session")
def awkward(docs_of):
    """Null id and text, empty and blank texts, a repeated row, a long text."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return docs_of("a b c d e f", None, "", " \n ", "a b c d e f", "a b c d e f", long, ids=[1, 2, 3, 4, 1, None, 7])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clash(awkward):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("fp", "score", "ids", "spans", "_text", "own", "hits", "base", "_row_key", "_copy", "payload")
    return awkward.select("*", *[F.lit(f"x-{n}").alias(n) for n in names])


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
