"""Data-quality checks: orphans, nulls, key violations, row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plandrift import schemas as S
from plandrift.schemas import INTERVAL_KEY, KEYS, QUERY_KEY, Table
from plandrift.sources.warehouse import Telemetry


def _labelled_counts(frames: Mapping[str, DataFrame], label: str, count: str) -> DataFrame:
    """One row per frame: its name and its number of rows."""
    rows = [
        df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def row_counts(t: Telemetry) -> DataFrame:
    frames = {
        S.QUERY.name: t.queries, S.QUERY_TEXT.name: t.texts, S.PLAN.name: t.plans,
        S.RUNTIME.name: t.runtime, S.WAIT.name: t.waits, S.INTERVAL.name: t.intervals,
        S.REGRESSION.name: t.regressions,
    }
    return _labelled_counts(frames, "TableName", "RowCount")


def _count_missing(df: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a parent, counted per key before the join.

    Reducing to one row per key first keeps a hot key from travelling to a
    single task with all of its rows.
    """
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(*key).distinct()
    return per_key.join(known, list(key), "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Count")
    )


def orphan_counts(t: Telemetry) -> DataFrame:
    text_key = [*KEYS, "QueryTextId"]
    checks = {
        "Orphaned Runtime Stats": _count_missing(t.runtime, t.queries, QUERY_KEY),
        "Orphaned Wait Stats": _count_missing(t.waits, t.queries, QUERY_KEY),
        "Missing Query Text": _count_missing(t.queries, t.texts, text_key),
    }
    rows = [df.select(F.lit(name).alias("IssueType"), "Count") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def null_counts(df: DataFrame, table_name: str, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "ColumnName", "NullCount").select(
        F.lit(table_name).alias("TableName"), "ColumnName", "NullCount"
    )


def required_null_counts(df: DataFrame, table: Table) -> DataFrame:
    """Nulls in the columns the schema declares as required."""
    required = [f.name for f in table.schema.fields if not f.nullable]
    return null_counts(df, table.name, required)


def duplicate_keys(df: DataFrame, table: Table) -> DataFrame:
    """Violations of the natural key."""
    return (
        df.groupBy(*table.keys).agg(F.count(F.lit(1)).alias("Copies")).filter(F.col("Copies") > 1)
    )


def interval_conflicts(extracted: DataFrame) -> DataFrame:
    """Interval ids that two databases of one server report with different times."""
    return (
        extracted.groupBy(*INTERVAL_KEY)
        .agg(
            F.count_distinct("IntervalStartTime", "IntervalEndTime").alias("Versions"),
            F.min("IntervalStartTime").alias("FirstStart"),
            F.max("IntervalStartTime").alias("LastStart"),
        )
        .filter(F.col("Versions") > 1)
    )


def storage_usage(t: Telemetry) -> DataFrame:
    """Rows and input files per table."""
    frames = {
        S.QUERY.name: t.queries, S.QUERY_TEXT.name: t.texts, S.PLAN.name: t.plans,
        S.RUNTIME.name: t.runtime, S.WAIT.name: t.waits, S.INTERVAL.name: t.intervals,
        S.REGRESSION.name: t.regressions, S.RUN_LOG.name: t.run_log,
    }
    rows = []
    for name, df in frames.items():
        per_file = df.groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
        ).agg(F.count(F.lit(1)).alias("n"))
        rows.append(per_file.agg(
            F.lit(name).alias("TableName"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("RowCount"),
            F.count(F.lit(1)).alias("Files"),
            (F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(1048576.0)).alias("TableSizeMB"),
        ))
    return reduce(DataFrame.unionByName, rows)
