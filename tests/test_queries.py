"""Every registered query against its SQL, on the smallest data folder."""

import os

import pytest

import __spark_entry__ as entry

SMOKE = entry.SMOKE_DATA
TABLES = ["events", "part", "documents", "benchmark", "pages", "conversations", "labels",
          "embeddings"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMOKE}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        repr(tuple(row[i] for i in order)) for row in rows
    )


def test_every_query_has_sql():
    """All but those of the corpus package that SQL cannot express."""
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) <= set(entry.LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    frame = entry.queries()[name](spark, SMOKE)
    found = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = oracle.execute(entry.oracle_sql()[name])
    expected = comparable([c[0] for c in cursor.description], cursor.fetchall())
    assert found == expected
    assert found[1]


def test_flagship(spark):
    levels = {r["alarm_level_cd"]: r["count"]
              for r in entry.entry(spark).groupBy("alarm_level_cd").count().collect()}
    assert levels == {"0": 378, "1": 12, "2": 61}
