"""Row filters: tenant scope, optional slices, relative windows, report slicers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plandrift.functions.columns import AsOf, ago, as_of_column, start_of_day
from plandrift.schemas import INTERVAL_KEY, QUERY_KEY


# Fixed value: the report slicers' period unless dates are chosen.
DEFAULT_DAYS = 30


def slice_source(df: DataFrame, tenant: str, server: str, database: str) -> DataFrame:
    """Rows of one source database; the tenant predicate prunes partitions."""
    return df.filter(
        (F.col("TenantName") == tenant)
        & (F.col("ServerName") == server)
        & (F.col("DatabaseName") == database)
    )


def optional_scope(df: DataFrame, tenant: str | None = None, server: str | None = None) -> DataFrame:
    """Apply only the filters that were given, so an absent one costs nothing."""
    if tenant is not None:
        df = df.filter(F.col("TenantName") == tenant)
    if server is not None:
        df = df.filter(F.col("ServerName") == server)
    return df


def tenant_scope(df: DataFrame, tenant: str) -> DataFrame:
    """Row-level security: what a user of ``tenant`` may see. Apply it first."""
    return df.filter(F.col("TenantName") == tenant)


def since_days(df: DataFrame, column: str, as_of: AsOf, days: int) -> DataFrame:
    """Rows from ``days`` whole days before the start of the ``as_of`` day."""
    return df.filter(F.col(column) >= ago(start_of_day(as_of), days, "day"))


def since_exact(df: DataFrame, column: str, as_of: AsOf, amount: int, unit: str) -> DataFrame:
    """Rows from exactly ``amount`` units before ``as_of``."""
    return df.filter(F.col(column) >= ago(as_of_column(as_of), amount, unit))


def slice_facts(
    fact: DataFrame,
    dim_interval: DataFrame,
    dim_query: DataFrame | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    tenants: Sequence[str] | None = None,
    servers: Sequence[str] | None = None,
    databases: Sequence[str] | None = None,
    query_id: int | None = None,
    text_contains: str | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """The report slicers; without dates, those of the last 30 days. Adds ``IntervalDate``; keeps the fact's columns.

    Column filters are applied before the joins so that they reach the scan,
    and the same tenant and server filters narrow both dimensions.
    """
    for column, wanted in (
        ("TenantName", tenants), ("ServerName", servers), ("DatabaseName", databases),
    ):
        if wanted is not None:
            fact = fact.filter(F.col(column).isin(list(wanted)))
    if query_id is not None:
        fact = fact.filter(F.col("QueryId") == query_id)

    dates = dim_interval.select(*INTERVAL_KEY, "IntervalDate")
    if tenants is not None:
        dates = dates.filter(F.col("TenantName").isin(list(tenants)))
    if date_from is None and date_to is None:
        dates = since_days(dates, "IntervalDate", as_of, DEFAULT_DAYS)
    if date_from is not None:
        dates = dates.filter(F.col("IntervalDate") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        dates = dates.filter(F.col("IntervalDate") <= F.lit(date_to).cast("date"))
    fact = fact.join(dates, INTERVAL_KEY)

    if text_contains is not None:
        wanted = dim_query.filter(
            F.contains(F.lower("QueryText"), F.lit(text_contains.lower()))
        ).select(*QUERY_KEY)
        fact = fact.join(wanted, QUERY_KEY, "left_semi")
    return fact
