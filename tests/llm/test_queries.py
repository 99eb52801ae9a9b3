import pytest

from strataq.llm import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, name):
    from tests.oracle import connect, spark_rows, sql_rows

    assert spark_rows(catalogue.QUERIES[name](spark, SF)) == sql_rows(connect(SF), catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() >= 0
