import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from quillmesh.session import local_session

    s = local_session("tests", "4", 4, "4g")
    yield s


def oracle(sf_dir):
    """A DuckDB connection with a view for each table of a folder."""
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{sf_dir}/{f}')")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if getattr(value, "tzinfo", None):
        return value.replace(tzinfo=None)
    return value


def compare(spark, query, sql, sf_dir):
    """The rows of a query and of its SQL as sorted texts, by column name."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    mine = sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())
    r = oracle(sf_dir).execute(sql)
    at = {c[0]: i for i, c in enumerate(r.description)}
    assert sorted(at) == names
    theirs = sorted(repr(tuple(plain(x[at[c]]) for c in names)) for x in r.fetchall())
    return mine, theirs
