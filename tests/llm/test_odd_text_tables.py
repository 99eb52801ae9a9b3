import pytest

from strataq.llm.catalogue import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_and_null_rows(spark, odd_tables, name):
    assert QUERIES[name](spark, odd_tables["empty"]).count() == 0
    rows = QUERIES[name](spark, odd_tables["nulls"]).collect()
    if name.endswith("_found"):
        assert len(rows) == len(set(map(tuple, rows)))
