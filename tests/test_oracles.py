"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

from tallyspan.plans import ORACLES, QUERIES

from conftest import SF_DIR


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, sql, key):
    _, notes = oracle.differences(spark, sql, SF_DIR, key)
    assert not notes, notes


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
