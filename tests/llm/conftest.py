import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from lapse.session import local_session

    return local_session("*", 8, app="lapse-tests")


@pytest.fixture(scope="session")
def documents(spark):
    """Whole ``documents`` at sf0.001 as (DataFrame, rows)."""
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    return df, df.collect()


def prose(n: int, seed: int = 0, words: int = 500) -> list[str]:
    """n pseudo-random words, the same for the same arguments."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(f"w{(x >> 33) % words}")
    return out


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, white space only."""
    long = " ".join(prose(30_000, 5, 5000))
    base = " ".join(prose(120, 1))
    return [
        (1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, None, "a", None), (None, base, "en", None, 3),
        (None, None, None, None, None), (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (6, long, "en", "b", 9), (7, "one", "en", "b", 3), (8, "ONE", "en", "b", 3), (9, "same " * 400, "en", "b", 1),
        (10, "é😀\x00中 \x1c x", "fr", "b", 1), (11, base + " " + " ".join(prose(60, 2)), "en", "a", 5), (7, " ".join(prose(60, 2)), "en", "a", 5),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    rows = odd_rows()
    return spark.createDataFrame(rows, DOCS), rows
