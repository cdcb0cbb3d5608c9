import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, source) of the smallest documents table."""
    return duckdb.sql(f"SELECT doc_id, coalesce(text, ''), source FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns named like results."""
    long = " ".join(f"word{k} mail{k % 7}@example.com" for k in range(30_000))
    prose = "the quick brown fox jumps over the lazy dog and runs away into the deep dark wood"
    rows = [
        (1, prose, "en", "a"), (2, prose, "en", "a"), (2, prose, "en", "a"), (3, prose + " today", None, "a"),
        (4, None, "en", None), (5, "", "fr", "b"), (6, " \t\n\x0b ", "en", "b"), (7, "one two", "de", "b"),
        (8, "ONE two", "de", None), (9, long, "en", "a"), (None, prose, "en", "a"), (None, None, None, None),
        (10, "Released under the MIT License.\n" + "tail\n" * 40, "en", "a"), (11, "x" * 50_000, "en", "a"),
        (12, "héllo ﬁ\x1c ▁ <|endoftext|> 'll\r\n  double  space\n\n", "en", "a"),
    ]
    return spark.createDataFrame(
        [(*r, "z", True, -1, "q", 9) for r in rows],
        "doc_id long, text string, lang string, source string, keep_id string, kept boolean, shard int, queue string, _id int",
    )


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")
