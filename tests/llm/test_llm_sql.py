import pytest

from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, data, matches, name):
    matches(spark, name, queries.QUERIES[name], queries.SQL[name], data)
