"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SF
from oracle_check import compare

import __spark_entry__ as entry


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(name, spark, duck):
    message = compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql().get(name))
    if message == "no rows":
        # an empty result is a match when the SQL is empty too
        assert name in entry.oracle_sql() and duck.execute(entry.oracle_sql()[name]).fetchone() is None
    else:
        assert message is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["decision", "email_type", "n"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
