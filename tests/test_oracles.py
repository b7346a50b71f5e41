"""Every registered query against its SQL on the smallest data set."""

import math

import duckdb
import pytest

from checks import CHECKS
from tests.conftest import DATA_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA_DIR}/{name}.parquet'")
    return connection


def _text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value)


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, duck, name):
    check = CHECKS[name]
    df = check.run(spark, DATA_DIR)
    rows = df.collect()
    if check.sql is None:
        assert rows
        return
    cursor = duck.execute(check.oracle())
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(rows, df.columns) == _sorted(cursor.fetchall(), columns)
