import pytest

from strataq.queries.core_problems import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_and_null_rows(spark, odd_tables, name):
    assert QUERIES[name](spark, odd_tables["empty"]).count() == 0
    got = QUERIES[name](spark, odd_tables["nulls"])
    assert len(got.collect()) == len(set(map(tuple, got.collect())))
