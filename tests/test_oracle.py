"""Every registered query against its SQL twin; those without a twin must run."""
import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical

TWINS = entry.oracle_sql()


@pytest.fixture(scope="session")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, sf, con, name):
    got = entry.queries()[name](spark, sf).toPandas()
    ref = con.execute(TWINS[name]).fetchdf()
    assert sorted(got.columns) == sorted(ref.columns)
    assert canonical(got) == canonical(ref)


@pytest.mark.parametrize("name", sorted(n for n in entry.load()[0] if n not in TWINS))
def test_without_twin(spark, sf, name):
    got = entry.queries()[name](spark, sf)
    assert got.count() > 0 and len(set(got.columns)) == len(got.columns)


def test_names():
    assert set(TWINS) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
