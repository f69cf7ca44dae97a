"""Every query against its SQL on the smallest tables; the others must give rows."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference, oracle_rows

SMALL = entry.SMALL
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), SMALL, ORACLES[name]) is None
    assert oracle_rows(SMALL, ORACLES[name])[1], "a check without rows shows nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).columns == [
        "batch_id", "batch_name", "source_id", "source_code", "required_ind", "expected_count", "existing_count",
    ]
    assert set(ORACLES) <= set(QUERIES)
