import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def matches():
    """Asserts that a query's rows are those of its SQL."""
    import glob
    import numbers

    import duckdb
    import pandas as pd

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "NULL"
        if isinstance(v, numbers.Number) and not isinstance(v, bool):
            return repr(round(float(v), 6))
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str(list(v))
        return str(v).replace(" 00:00:00", "")

    def rows(df):
        df = df[sorted(df.columns)]
        return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))

    def check(spark, name, query, sql, folder):
        con = duckdb.connect()
        for f in glob.glob(folder + "/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
        mine, theirs = query(spark, folder).toPandas(), con.execute(sql).df()
        assert sorted(mine.columns) == sorted(theirs.columns), name
        assert rows(mine) == rows(theirs), name

    return check
