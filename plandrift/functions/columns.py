"""Column expressions shared by views, reports and jobs. All stay JVM-side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession, functions as F

from plandrift.schemas import KEYS, Table

AsOf = str | dt.datetime | Column | None


def as_of_column(as_of: AsOf) -> Column:
    """Turn the caller's "now" into a timestamp column; ``None`` is the wall clock."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp")


def pinned(spark: SparkSession, as_of: AsOf) -> str:
    """``as_of`` as one fixed moment, for jobs whose steps must agree on "now"."""
    return spark.range(1).select(as_of_column(as_of).cast("string")).first()[0]


def start_of_day(as_of: AsOf) -> Column:
    return F.to_date(as_of_column(as_of)).cast("timestamp")


def ago(moment: Column, amount: int, unit: str) -> Column:
    """``moment`` minus a whole number of ``unit`` (day, hour or minute)."""
    return moment - F.expr(f"INTERVAL {int(amount)} {unit.upper()}")


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries crossed between two moments.

    00:59 to 01:01 crosses one hour boundary, although only two minutes pass;
    Spark's own ``timestampdiff`` counts completed units and would give 0.
    """
    if unit == "day":
        return F.datediff(F.to_date(end), F.to_date(start))
    seconds = {"hour": 3600, "minute": 60}[unit]

    def ticks(moment: Column) -> Column:
        return F.floor(F.unix_timestamp(F.date_trunc(unit, moment)) / F.lit(seconds))

    return (ticks(end) - ticks(start)).cast("int")


def divide(numerator: Column, denominator: Column, alternate=None) -> Column:
    """Safe ratio: ``alternate`` where the denominator is zero or missing."""
    return F.when(
        denominator.isNull() | (denominator == 0), F.lit(alternate).cast("double")
    ).otherwise(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def dim_key(id_column: str) -> Column:
    """Display key ``tenant_server_database_id``.

    Names may themselves contain ``_``, so joins use the separate columns.
    """
    return F.concat_ws("_", *KEYS, F.col(id_column).cast("string"))


def wait_category_group(category: Column) -> Column:
    """Reporting group of a wait category; the first matching rule wins.

    Matching ignores case, so "Replication", "Compilation" and "Network IO"
    fall under IO because they contain the letters "io".
    """
    name = F.upper(category)
    return (
        F.when(name.like("%CPU%"), "CPU Contention")
        .when(name.like("%MEMORY%") | name.like("%RESOURCE_SEMAPHORE%"), "Memory Pressure")
        .when(name.like("%IO%"), "IO Contention")
        .when(name.like("%LOCK%"), "Lock Contention")
        .when(name.like("%LATCH%"), "Latch Contention")
        .when(name.like("%NETWORK%"), "Network")
        .otherwise("Other")
    )


def wait_minutes(total_ms: str = "TotalWaitTimeMs") -> Column:
    return F.col(total_ms).cast("double") / F.lit(1000.0) / F.lit(60.0)


def query_type(object_id: Column) -> Column:
    return (
        F.when(object_id > 0, "Stored Procedure")
        .when(object_id == 0, "Ad-hoc Query")
        .otherwise("Unknown")
    )


def execution_type_desc(code: Column) -> Column:
    return F.when(code == 0, "Regular").when(code == 1, "Aborted").when(code == 2, "Exception")


def partition_bucket(table: Table) -> Column:
    """The range that a row's id falls into (see ``Table.bucket``)."""
    name, column, width = table.bucket
    return F.floor(F.col(column) / F.lit(width)).cast("int").alias(name)


def preview(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)
