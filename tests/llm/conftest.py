import re

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def words():
    return lambda text: re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and a column with a clashing name."""
    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(30_000))
    body = " ".join(f"alpha{k} beta{k % 7}" for k in range(60))
    rows = [
        (1, body, "en", "a", 1), (2, body, "en", "a", 2), (2, body, "en", "a", 2), (3, body + " tail", "en", None, 3),
        (4, None, "de", "b", 4), (5, "", None, "b", 5), (6, " \n\t ", "fr", "b", 6), (7, long, "en", "c", 7),
        (None, body, "en", "a", 8), (9, "two words", "en", None, 9), (10, "two words", None, "z", None),
        (11, "12 34 * # $", "en", "b", 11), (12, "x" * 50_000, "en", "c", 12),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr("*", "'clash' as rep", "1 as size", "'q' as _text")
