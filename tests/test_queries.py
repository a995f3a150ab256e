"""Every query of the retail engine against its SQL in DuckDB."""

import math

import duckdb
import pytest

from shelfwise.plans.queries import QUERIES, SQL

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value if value is None or isinstance(value, bool) else float(value) if isinstance(value, int) else str(value)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    assert found == ordered([tuple(plain(r[k]) for k in at) for r in cursor.fetchall()])


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 4
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())
