from __future__ import annotations

import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quarrymill.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g", "spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def same_rows(spark, sf, duck):
    """Compares a query's rows with its SQL counterpart's."""

    def compare(query, sql):
        df = query(spark, sf)
        cur = duck.execute(sql)
        want = cur.fetchall()
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(df.columns)
        at = [names.index(c) for c in df.columns]
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in want)

    return compare
