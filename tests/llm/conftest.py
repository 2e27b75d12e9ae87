"""Odd documents: nulls in every column, empty and very long texts, ties,
repeated rows, and extra columns whose names clash with internal ones."""

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
BASE = " ".join(f"word{i}" for i in range(80))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "k1 string, size int, row string, target string, bad int"
)


def odd_rows():
    texts = [
        None, "", " \t\n ", "one", "One two", BASE, BASE, BASE + " tail", "head " + BASE, LONG, LONG,
        "line a\n\nLINE A \nline b\n" + BASE, "line a\nline c", "a " * 200, "é ü\nLine A",
    ]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[5], rows[3], (None, "one", None, None, None), (None, None, None, None, None)]
    return [(*r, "x", 7, "y", None, 1) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, expected):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, map(tuple, expected)))
