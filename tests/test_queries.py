"""Every query with SQL is held against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from traitloom.plans import io_queries, pipelines  # noqa: F401  (they register queries)
from traitloom.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    return round(float(value), 5) if hasattr(value, "as_tuple") else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_against_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cursor = duck.execute(plans.SQL[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in cursor.description], cursor.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
