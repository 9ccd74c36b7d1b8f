"""Every registered query against its SQL on the smallest given tables."""

import datetime
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from suite.oracle import ORACLE
from suite.queries import registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"bigint": {int}, "int": {int}, "string": {str}, "boolean": {bool}, "double": {float},
         "date": {datetime.date}}

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def in_order(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in places) for row in rows), key=str)


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLE)
    assert set(registered()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registered()))
def test_query_matches_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = database.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    got = [tuple(row) for row in df.collect()]
    assert sorted(df.columns) == sorted(columns)
    assert in_order(got, df.columns) == in_order(expected, columns)
    assert got, "a query without rows checks nothing"
    for place, (column, kind) in enumerate(df.dtypes):
        seen = {type(row[place]) for row in got} - {type(None)}
        assert seen <= KINDS[kind], (column, kind)


@pytest.mark.parametrize("hidden", ["ahocorasick", "corpus_pipeline", "tidings.llm"])
def test_queries_stay_where_an_operator_cannot_be_imported(hidden):
    """In a new process one library or folder is hidden; all queries on the given tables stay."""
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "print(len(entry.queries()), len(entry.oracle_sql()), 'op6_bpe' in entry.queries())"
    )
    root = os.path.dirname(os.path.abspath(entry.__file__))
    found = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert found.stdout.split() == [str(len(ORACLE)), str(len(ORACLE)), "False"], found.stderr


def test_entry(spark):
    assert entry.entry(spark).columns == ["url_hash", "cluster_id"]
