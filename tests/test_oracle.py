"""Every registered query against its DuckDB oracle (driver-style comparison)."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare

import __spark_entry__ as E
from hazardlens.plans import registry


def test_registry_is_complete():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(registry.queries()) >= 86 and set(registry.queries()) <= set(qs)


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, list(registry.queries()), verbose=False)


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if not v.get("values_match", False)}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["establishment_id", "dynamic_risk_score", "dba_name", "address"]
