"""Every registered query against its reference SQL on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
OWN = set(entry.training_data_queries())  # tested in their own folder
QUERIES = {n: q for n, q in entry.queries().items() if n not in OWN} if os.path.isdir(SF_DIR) else {}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, Decimal)) and not isinstance(value, bool):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_reference_sql():
    assert set(entry.oracle_sql()) - OWN == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["risk_category", "firm_count", "percentage", "avg_score"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_reference_sql(spark, oracle, name):
    result = QUERIES[name](spark, SF_DIR)
    assert not any(t in ("date",) or t.startswith("decimal") for _, t in result.dtypes), "not a plain result"
    answer = oracle.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    expected = answer.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert rows_of(result.columns, result.collect()) == rows_of(columns, expected)
