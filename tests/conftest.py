import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from plumbline.session import get_session

    session = get_session(4, "4g", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


DATA = os.environ.get("TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA


def plain(rows, columns):
    def one(v):
        if isinstance(v, float):
            return "None" if v != v else f"{v:.6f}"
        return str(v)

    return sorted(tuple(one(r[c]) for c in sorted(columns)) for r in rows)


def against_sql(spark, data, query, sql):
    """The query's rows equal those of its SQL."""
    import glob

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got = query(spark, data)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = [dict(zip(names, r)) for r in cur.fetchall()]
    assert plain([r.asDict() for r in got.collect()], got.columns) == plain(want, names)
