"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare

from sfdirs import SF_SMALL


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._ORACLE_BODIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, name):
    rec = compare(spark, SF_SMALL, [name])[name]
    assert rec["spark_rows"] == rec["oracle_rows"], rec
    assert rec["values_match"], rec


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "host", "count"] and df.count() == 278
