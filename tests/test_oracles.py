"""Every registered query against its DuckDB oracle (the driver's check), at sf0.001."""

import pytest

from lodestar.plans import NOTES, ORACLES, QUERIES
from lodestar.plans.check import compare

from conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    result = compare(QUERIES[name](spark, SMALL), duck_small, ORACLES[name])
    assert result["ok"], result
    assert result["oracle_rows"] > 0, "an empty result proves nothing"


def test_every_query_has_oracle_or_note():
    for name in QUERIES:
        assert name in ORACLES or name in NOTES, name


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["c_mktsegment", "avg_o_totalprice", "max_o_totalprice", "n_rows"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
