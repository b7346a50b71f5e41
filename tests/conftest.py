import datetime as dt

import pytest

from plandrift import schemas as S
from plandrift.session import local_session

DATA_DIR = "/root/testdata/sf0.001"
NOON = dt.datetime(2024, 3, 10, 12, 0)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


def _default(field):
    kind = field.dataType.simpleString()
    return {
        "string": "x", "bigint": 1, "int": 1, "double": 1.0, "boolean": False,
        "timestamp": NOON, "date": NOON.date(), "binary": None,
    }[kind]


@pytest.fixture(scope="session")
def make(spark):
    """Rows of a table: given columns as named, required others filled in."""
    def build(table, rows, columns=None):
        schema = columns or table.schema
        data = [
            tuple(row.get(f.name, None if f.nullable else _default(f)) for f in schema.fields)
            for row in rows
        ]
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture(scope="session")
def runtime(make):
    """Runtime rows from (tenant, query, plan, interval, duration[, extra columns])."""
    def build(*rows):
        filled = []
        for tenant, query, plan, interval, duration, *extra in rows:
            filled.append({
                "TenantName": tenant, "ServerName": "s", "DatabaseName": "d", "QueryId": query,
                "PlanId": plan, "RuntimeStatsIntervalId": interval, "AvgDurationMs": duration,
                "ExecutionType": 0, **(extra[0] if extra else {}),
            })
        return make(S.RUNTIME, filled)

    return build
