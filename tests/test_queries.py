"""The driver's contract: every query runs, and agrees with its SQL at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

SMALL = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="driver tables not present")

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check import connect, difference  # noqa: E402

# Trained models are covered by test_model.py and have no SQL.
CHECKED = sorted(oracle_sql())


def test_sql_names_are_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 5


@pytest.fixture(scope="module")
def duck():
    return connect(str(SMALL))


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, duck, name):
    found = queries()[name](spark, str(SMALL)).toPandas()
    assert difference(found, duck.execute(oracle_sql()[name]).df()) == ""
