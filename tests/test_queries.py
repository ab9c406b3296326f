"""Each query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from postmill.plans import queries as plan_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


def rounded(row):
    return repr(tuple(round(x, 9) if isinstance(x, float) else x for x in row))


@pytest.mark.parametrize("name", sorted(plan_queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    found = plan_queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    said = duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({plan_queries.ORACLE[name]})")
    assert sorted(map(rounded, found.select(*columns).collect())) == sorted(map(rounded, said.fetchall()))


@pytest.mark.parametrize("name", sorted(set(plan_queries.QUERIES) - set(plan_queries.ORACLE)))
def test_query_has_rows(spark, name):
    assert plan_queries.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 75
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
