from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skylode.session import local_session

    s = local_session(4, shuffle_partitions=4, **{"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return c


def plain(v):
    """Comparable values: floats to 9 digits, NaN as text, lists as tuples."""
    if isinstance(v, float):
        return "nan" if v != v else round(v + 0.0, 9)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same_rows(df, relation) -> None:
    """A Spark result and a DuckDB relation have the same columns and rows, in whatever order."""
    columns = sorted(df.columns)
    names = relation.columns
    assert columns == sorted(names)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert got == want
