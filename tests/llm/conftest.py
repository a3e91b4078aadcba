from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from barloom.llm.common import ship  # noqa: E402

COLUMNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("lang", T.StringType()),
        # Names that operators use inside.
        T.StructField("id", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("group", T.IntegerType()),
    ]
)
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
#: Nulls, empty and very long texts, ties, a repeated row.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog by the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog by the river bank today"),
    (3, "The quick brown  fox jumps over the lazy dog by the river bank\ttoday"),
    (3, "The quick brown  fox jumps over the lazy dog by the river bank\ttoday"),
    (4, ""),
    (5, None),
    (6, "one"),
    (7, "Ünïcode 'twas it's 12 345 ��� \U0001f600\n\n  x"),
    (8, LONG),
    (9, LONG + " tail"),
    (None, "no id here but some words to read"),
    (10, "   \t\n "),
]


@pytest.fixture
def frame(spark):
    """Builds a table with extra columns whose names clash with inner ones."""
    ship(spark)

    def build(rows):
        full = [(i, t, f"src{(i or 0) % 3}", "en", "x", "y", 7) for i, t in rows]
        return spark.createDataFrame(full, COLUMNS)

    return build


@pytest.fixture
def odd(frame):
    return frame(ODD)


@pytest.fixture
def empty(frame):
    return frame([])
