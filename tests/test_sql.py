import pytest

from tidemark.plans import files, problems, relational, streams

CASES = [(n, m.QUERIES[n], m.SQL[n]) for m in (relational, problems, streams, files) for n in m.SQL]


@pytest.mark.parametrize("name,query,sql", CASES, ids=[c[0] for c in CASES])
def test_query_matches_sql(spark, data, matches, name, query, sql):
    matches(spark, name, query, sql, data)


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
