"""Every registered query against its DuckDB oracle (the correctness gate)."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

from .conftest import SF_CHECK, SF_SMALL

NAMES = sorted(entry.oracle_sql())
# the heaviest plans are also checked on the gate's own scale
GATE = ["g11_interact_before_buy", "g12_customer_feature", "g4_interest_profile", "g8_top_sell_product_all_time"]


def test_every_reference_query_has_an_oracle():
    rest = set(entry.queries()) - set(entry.oracle_sql())
    assert all(n == "pipeline" or n.startswith("op") for n in rest)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(entry.oracle_sql()[name]).df()
    assert compare(got, want) is None


@pytest.mark.parametrize("name", GATE)
def test_query_matches_oracle_gate_scale(spark, name):
    got = entry.queries()[name](spark, SF_CHECK).toPandas()
    want = duck(SF_CHECK).execute(entry.oracle_sql()[name]).df()
    assert compare(got, want) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["customer_id", "avg_view_duration_before_buy"]
