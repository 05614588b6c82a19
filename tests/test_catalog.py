"""Every query equals its SQL."""

import collections
import math
import os
import subprocess
import sys

import duckdb
import pytest

from spanweave import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(row):
    return tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in row)


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf, db, name):
    cursor = db.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    found = catalog.QUERIES[name](spark, sf)
    assert sorted(found.columns) == sorted(columns)
    assert collections.Counter(map(plain, found.select(*[f"`{c}`" for c in columns]).collect())) == collections.Counter(map(plain, cursor.fetchall()))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_give_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_is_imported_without_a_session():
    """And the queries are there also where the training-data operators or what they import are not."""
    for block in ("", "spanweave.llm", "xxhash", "public_tokenizers"):
        code = f"import sys; sys.modules[{block!r}] = None if {block!r} else sys; import __spark_entry__ as e; print(len(e.queries()), 'op1_quality' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"
        said = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True, timeout=120).stdout.split()
        assert int(said[0]) >= len(catalog.QUERIES) and said[2] == "True"
        if block:
            assert said[1] == "False"
