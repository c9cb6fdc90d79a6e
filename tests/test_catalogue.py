"""Every query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline.catalogue import ORACLES, QUERIES
from compare import TABLES, rows_of



@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan
    if name in ORACLES:
        answer = db.execute(ORACLES[name])
        names = [d[0] for d in answer.description]
        assert sorted(names) == sorted(frame.columns)
        assert got == rows_of(names, answer.fetchall())
    else:
        assert got


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 8
