"""The queries that SQL can express, against DuckDB."""

import pytest

from hazardlens.llm import registry
from oracle_compare import compare


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_queries_match_oracle(spark, sf):
    result = compare(spark, sf, list(registry.oracle_sql()), verbose=False)
    assert set(result) == {"op4_substring_dedup", "op5_vector_search", "op11_ranked_search", "op13_line_dedup"}
    bad = {k: v for k, v in result.items() if not v.get("values_match", False)}
    assert not bad, bad


def test_all_queries():
    names = [n.split("_")[0] for n in registry.queries()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
