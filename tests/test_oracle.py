"""Every query with an oracle, against DuckDB on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    got = entry.entry(spark)
    assert got.columns[:4] == ["subject_id", "icustay_id", "charttime", "label"] and got.limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert check.differences(got, con.execute(entry.oracle_sql()[name]).df()) == ""
