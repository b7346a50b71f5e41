"""Operational reports. Windows and thresholds are arguments; ``as_of`` is "now".

Reports that name queries reduce the facts to one row per query before any
dimension is joined, and join query text last, to the rows that are shown.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plandrift.functions.columns import (
    AsOf, ago, as_of_column, boundary_diff, preview, start_of_day, wait_category_group,
    wait_minutes,
)
from plandrift.functions.filters import since_days, since_exact
from plandrift.functions.measures import evaluate
from plandrift.functions.ranking import top
from plandrift.functions.time_intelligence import DATE, date_lookup
from plandrift.operators.quality import null_counts, orphan_counts, row_counts
from plandrift.plans.views import dim_query, fact_top_queries, with_query_text
from plandrift.schemas import INTERVAL_KEY, KEYS, PLAN_KEY, QUERY_KEY
from plandrift.sources.warehouse import Telemetry

MS_PER_HOUR = 1000.0 * 60.0 * 60.0
HOST = ["TenantName", "ServerName"]
SAME_TEXT = [*HOST, "QueryId", "TextDigest"]


def _money(column: str) -> Column:
    """Two decimals, half up. Nine first: order of summation must not decide a half."""
    return F.round(F.col(column), 9).cast("decimal(10,2)")


def _mean_of(column: str) -> list[Column]:
    return [F.sum(column).alias(f"s_{column}"), F.count(column).alias(f"n_{column}")]


def _merge_mean(column: str, name: str) -> Column:
    return F.try_divide(F.sum(f"s_{column}"), F.sum(f"n_{column}")).alias(name)


def _known(per_query: DataFrame, t: Telemetry) -> DataFrame:
    """Only queries the query dimension knows, with their text id."""
    return per_query.join(t.queries.select(*QUERY_KEY, "QueryTextId"), QUERY_KEY)


def _text(df: DataFrame, t: Telemetry) -> DataFrame:
    content = t.texts.select(*KEYS, "QueryTextId", F.col("QueryTextContent").alias("QueryText"))
    return df.join(content, [*KEYS, "QueryTextId"], "left")


def _digest(df: DataFrame, t: Telemetry) -> DataFrame:
    """The text's digest instead of the text, for grouping."""
    digests = t.texts.select(
        *KEYS, "QueryTextId", F.unhex(F.sha2("QueryTextContent", 256)).alias("TextDigest")
    )
    return df.join(digests, [*KEYS, "QueryTextId"], "left")


def _source() -> Column:
    """One of the databases that hold a group's text, and the text's id there."""
    return F.min(F.struct("DatabaseName", "QueryTextId")).alias("Source")


# --- monitoring ---------------------------------------------------------------

def latest_loads(t: Telemetry, n: int = 10) -> DataFrame:
    newest = top(t.run_log, n, [F.desc("LastExtractTime")], [*KEYS, "ETLControlId"])
    return newest.select(
        *KEYS, "LastExtractTime", "ExtractDurationSeconds", "RecordsInserted", "ExtractStatus"
    )


def data_freshness(t: Telemetry, as_of: AsOf) -> DataFrame:
    loads = t.runtime.groupBy(*KEYS).agg(
        F.max("LoadDate").alias("LastLoadTime"), F.count(F.lit(1)).alias("RecordCount")
    )
    hours = boundary_diff("hour", F.col("LastLoadTime"), as_of_column(as_of))
    return loads.withColumn("HoursSinceLoad", hours).orderBy(F.desc("LastLoadTime"), *KEYS)


def table_row_counts(t: Telemetry) -> DataFrame:
    return row_counts(t)


# --- performance --------------------------------------------------------------

def slowest_queries(t: Telemetry, as_of: AsOf, days: int = 7, n: int = 20) -> DataFrame:
    per_query = t.loaded_since("runtime", as_of, days).groupBy(*QUERY_KEY).agg(
        F.avg("AvgDurationMs").alias("AvgDurationMs"),
        F.max("MaxDurationMs").alias("MaxDurationMs"),
        F.sum("CountExecutions").alias("TotalExecutions"),
        F.avg("AvgCpuTimeMs").alias("AvgCpuTimeMs"),
        F.avg("AvgMemoryUsedMb").alias("AvgMemoryMB"),
    )
    best = top(_known(per_query, t), n, [F.desc("AvgDurationMs")], QUERY_KEY)
    return _text(best, t).select(
        *QUERY_KEY, preview(F.col("QueryText"), 100).alias("QueryPreview"), "AvgDurationMs",
        "MaxDurationMs", "TotalExecutions", "AvgCpuTimeMs", "AvgMemoryMB",
    )


def _by_host_query_text(
    per_query: DataFrame, t: Telemetry, *aggregates: Column, extra: Sequence[str] = ()
) -> DataFrame:
    """Re-group per-query rows by server, query id and text, across databases.

    Texts are compared by digest; ``Source`` names one of the rows that hold the text.
    """
    return _digest(_known(per_query, t), t).groupBy(*SAME_TEXT, *extra).agg(*aggregates, _source())


def _shown(
    grouped: DataFrame, t: Telemetry, n: int, order: Sequence[Column], *columns: str, extra: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` groups in order; only they are joined to their text."""
    best = top(grouped, n, order, [*SAME_TEXT, *extra]).select("*", "Source.*")
    return _text(best, t).orderBy(*order, *[F.asc(c) for c in (*SAME_TEXT, *extra)]).select(
        *HOST, "QueryId", preview(F.col("QueryText"), 80).alias("QueryPreview"), *columns
    )


def cpu_consumers(t: Telemetry, min_cpu_ms: float = 1_000_000, n: int = 20) -> DataFrame:
    per_query = t.runtime.groupBy(*QUERY_KEY).agg(
        F.sum(F.col("CountExecutions") * F.col("AvgCpuTimeMs")).alias("cpu_ms"),
        *_mean_of("AvgCpuTimeMs"), F.sum("CountExecutions").alias("executions"),
    )
    grouped = _by_host_query_text(
        per_query, t, F.sum("cpu_ms").alias("cpu_ms"), _merge_mean("AvgCpuTimeMs", "AvgCpuTimeMs"),
        F.sum("executions").alias("ExecutionCount"),
    ).filter(F.col("cpu_ms") > min_cpu_ms)
    grouped = grouped.withColumn("TotalCpuHours", F.col("cpu_ms") / F.lit(MS_PER_HOUR))
    return _shown(
        grouped, t, n, [F.desc("TotalCpuHours")], "TotalCpuHours", "AvgCpuTimeMs", "ExecutionCount"
    )


def memory_hogs(t: Telemetry, min_memory_mb: float = 100, n: int = 20) -> DataFrame:
    per_query = t.runtime.groupBy(*QUERY_KEY).agg(
        *_mean_of("AvgMemoryUsedMb"), F.max("MaxMemoryUsedMb").alias("peak"),
        F.sum("CountExecutions").alias("executions"),
    )
    grouped = _by_host_query_text(
        per_query, t, _merge_mean("AvgMemoryUsedMb", "AvgMemoryMB"),
        F.max("peak").alias("MaxMemoryMB"), F.sum("executions").alias("ExecutionCount"),
    ).filter(F.col("AvgMemoryMB") > min_memory_mb)
    return _shown(
        grouped, t, n, [F.desc("AvgMemoryMB")], "AvgMemoryMB", "MaxMemoryMB", "ExecutionCount"
    )


# --- regressions --------------------------------------------------------------

def recent_regressions(
    t: Telemetry, as_of: AsOf, hours: int = 24, min_percent: float = 25, n: int = 50
) -> DataFrame:
    recent = since_exact(t.regressions, "DetectionDate", as_of, hours, "hour").filter(
        F.col("DurationChangePercentage") > min_percent
    )
    newest = top(recent, n, [F.desc("DetectionDate")], [*QUERY_KEY, "OldPlanId", "NewPlanId"])
    return with_query_text(newest, t.queries, t.texts).select(
        *QUERY_KEY, "OldPlanId", "NewPlanId", F.col("QueryText").alias("QueryTextContent"),
        "DetectionDate", "OldAvgDurationMs", "NewAvgDurationMs", "DurationChangePercentage",
        "IsInvestigated", "Notes",
    )


def top_regressions(
    t: Telemetry, as_of: AsOf, days: int = 30, min_percent: float = 25, n: int = 20
) -> DataFrame:
    grouped = (
        since_exact(t.regressions, "DetectionDate", as_of, days, "day")
        .groupBy(*HOST, "QueryId", "IsInvestigated")
        .agg(
            F.count(F.lit(1)).alias("RegressionCount"),
            F.avg("DurationChangePercentage").alias("AvgDurationChangePercentage"),
            F.max("NewAvgDurationMs").alias("MaxNewDurationMs"),
        )
        .filter(F.col("AvgDurationChangePercentage") > min_percent)
    )
    return top(
        grouped, n, [F.desc("AvgDurationChangePercentage")], [*HOST, "QueryId", "IsInvestigated"]
    )


def regression_export(t: Telemetry, as_of: AsOf, days: int = 30) -> DataFrame:
    rows = t.regressions.filter(
        F.to_date("DetectionDate") >= F.to_date(ago(start_of_day(as_of), days, "day"))
    )
    return rows.orderBy(F.desc("DetectionDate"), *QUERY_KEY, "OldPlanId", "NewPlanId").select(
        F.to_date("DetectionDate").alias("Date"), *QUERY_KEY,
        _money("OldAvgDurationMs").alias("OldDurationMs"),
        _money("NewAvgDurationMs").alias("NewDurationMs"),
        _money("DurationChangePercentage").alias("PercentChange"),
        F.when(F.col("IsInvestigated"), "Yes").otherwise("No").alias("Investigated"),
    )


def regressions_per_day(t: Telemetry) -> DataFrame:
    return t.regressions.groupBy(F.to_date("DetectionDate").alias("Date")).agg(
        F.count(F.lit(1)).alias("Regressions"),
        F.avg("DurationChangePercentage").alias("AvgChangePercentage"),
    )


# --- waits --------------------------------------------------------------------

def _grouped_waits(waits: DataFrame) -> DataFrame:
    return waits.withColumns({
        "WaitCategoryGroup": wait_category_group(F.col("WaitCategory")), "minutes": wait_minutes(),
    })


def waits_by_group(t: Telemetry, as_of: AsOf, days: int = 7) -> DataFrame:
    waits = _grouped_waits(t.loaded_since("waits", as_of, days))
    totals = waits.groupBy(*HOST, "WaitCategoryGroup").agg(
        F.sum("minutes").alias("TotalWaitMinutes"), F.sum("CountWaits").alias("TotalWaits"),
        F.avg("AvgWaitTimeMs").alias("AvgWaitTimeMs"),
    )
    return totals.withColumn("TotalWaitHours", F.col("TotalWaitMinutes") / F.lit(60.0)).orderBy(
        F.desc("TotalWaitMinutes"), *HOST, "WaitCategoryGroup"
    )


def waiting_queries(t: Telemetry, as_of: AsOf, days: int = 7, n: int = 50) -> DataFrame:
    waits = _grouped_waits(t.loaded_since("waits", as_of, days))
    per_query = waits.groupBy(*QUERY_KEY, "WaitCategoryGroup").agg(
        F.sum("minutes").alias("minutes"), F.sum("CountWaits").alias("waits"),
        *_mean_of("AvgWaitTimeMs"),
    )
    grouped = _by_host_query_text(
        per_query, t, F.sum("minutes").alias("TotalWaitMinutes"), F.sum("waits").alias("WaitCount"),
        _merge_mean("AvgWaitTimeMs", "AvgWaitTimeMs"), extra=["WaitCategoryGroup"],
    )
    return _shown(
        grouped, t, n, [F.desc("TotalWaitMinutes")], "WaitCategoryGroup", "TotalWaitMinutes",
        "WaitCount", "AvgWaitTimeMs", extra=["WaitCategoryGroup"],
    )


def memory_pressure(
    t: Telemetry, as_of: AsOf, days: int = 1, min_minutes: float = 60
) -> DataFrame:
    waits = _grouped_waits(t.loaded_since("waits", as_of, days))
    affected = waits.filter(F.col("WaitCategoryGroup") == "Memory Pressure").groupBy(*HOST).agg(
        F.sum("minutes").alias("MemoryWaitMinutes"),
        F.count_distinct("QueryId").alias("AffectedQueries"),
    ).filter(F.col("MemoryWaitMinutes") > min_minutes)
    return affected.withColumn(
        "MemoryWaitHours", F.col("MemoryWaitMinutes") / F.lit(60.0)
    ).orderBy(F.desc("MemoryWaitHours"), *HOST)


def wait_share_by_group(t: Telemetry) -> DataFrame:
    """Share of each wait group in all wait time; seven groups at most."""
    groups = _grouped_waits(t.waits).groupBy("WaitCategoryGroup").agg(
        F.sum("minutes").alias("TotalWaitMinutes")
    )
    overall = t.waits.agg(F.sum(wait_minutes()).alias("m")).scalar()
    return groups.withColumn("SharePercent", F.col("TotalWaitMinutes") / overall * 100)


def _daily_waits(t: Telemetry) -> DataFrame:
    """Wait minutes per date and category; reduced per interval before the date is known."""
    per_interval = t.waits.groupBy(*INTERVAL_KEY, "WaitCategory").agg(
        F.sum(wait_minutes()).alias("minutes")
    )
    return per_interval.join(date_lookup(t.intervals), INTERVAL_KEY).withColumn(
        "WaitCategoryGroup", wait_category_group(F.col("WaitCategory"))
    )


def wait_trend(t: Telemetry) -> DataFrame:
    return _daily_waits(t).groupBy(DATE, "WaitCategoryGroup").agg(
        F.sum("minutes").alias("TotalWaitMinutes")
    )


# The wait groups in report order.
WAIT_GROUPS = [
    "CPU Contention", "Memory Pressure", "IO Contention", "Lock Contention",
    "Latch Contention", "Network", "Other",
]


def wait_trend_pivot(t: Telemetry) -> DataFrame:
    """One column per wait group; the fixed list saves a pass to discover them."""
    return _daily_waits(t).groupBy(DATE).pivot("WaitCategoryGroup", WAIT_GROUPS).agg(F.sum("minutes"))


def top_wait_queries(t: Telemetry, n: int = 10) -> DataFrame:
    per_query = t.waits.groupBy(*QUERY_KEY, "WaitCategory").agg(
        F.sum("TotalWaitTimeMs").alias("TotalWaitTimeMs"), F.sum("CountWaits").alias("TotalWaits")
    )
    return top(per_query, n, [F.desc("TotalWaitTimeMs")], [*QUERY_KEY, "WaitCategory"])


# --- plans --------------------------------------------------------------------

def plan_instability(t: Telemetry, min_plans: int = 2, n: int = 50) -> DataFrame:
    """Queries with more than ``min_plans`` plans, counted across databases.

    Databases of a server whose query has the same text count together; texts are
    compared by digest, and only the queries shown are joined to their text. Plans
    are counted group by group of plans; the intervals, which order nothing, are
    looked up for the ``n`` groups shown.
    """
    named = _digest(t.queries.select(*QUERY_KEY, "QueryTextId"), t)
    created = t.plans.select(*PLAN_KEY, "CreationTime")
    order = [F.desc("PlanCount")]
    counted = (
        t.runtime.select(*QUERY_KEY, "PlanId").distinct()
        .join(created, PLAN_KEY)
        .join(named, QUERY_KEY)
        .groupBy(*SAME_TEXT, "PlanId")
        .agg(F.min("CreationTime").alias("first"), F.max("CreationTime").alias("last"), _source())
        .groupBy(*SAME_TEXT)
        .agg(
            F.count(F.lit(1)).alias("PlanCount"),
            F.min("first").alias("FirstPlanDate"),
            F.max("last").alias("LatestPlanDate"),
            F.min("Source").alias("Source"),
        )
        .filter(F.col("PlanCount") > min_plans)
    )
    best = top(counted, n, order, SAME_TEXT)
    figures = [c for c in best.columns if c not in SAME_TEXT]
    shown = best.withColumnsRenamed({c: f"_{c}" for c in SAME_TEXT})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SAME_TEXT]
    members = named.select(*QUERY_KEY, "TextDigest").join(shown, same)
    with_intervals = (
        t.runtime.select(*QUERY_KEY, "PlanId", "RuntimeStatsIntervalId")
        .join(members.select(*QUERY_KEY, "TextDigest", *figures), QUERY_KEY)
        .join(created.select(*PLAN_KEY), PLAN_KEY, "left_semi")
        .groupBy(*SAME_TEXT, *figures, "RuntimeStatsIntervalId").agg(F.lit(1))
        .groupBy(*SAME_TEXT, *figures).agg(F.count(F.lit(1)).alias("IntervalCount"))
    )
    return _shown(
        with_intervals, t, n, order,
        "PlanCount", "FirstPlanDate", "LatestPlanDate", "IntervalCount",
    )


def plan_comparison(t: Telemetry, query_id: int, tenant: str, server: str) -> DataFrame:
    """All plans of one query; a plan without statistics shows zero intervals."""
    def scoped(df: DataFrame) -> DataFrame:
        return df.filter(
            (F.col("TenantName") == tenant) & (F.col("ServerName") == server)
            & (F.col("QueryId") == query_id)
        )

    plans = scoped(t.plans).select(*PLAN_KEY, "CreationTime", "LastExecutionTime")
    stats = scoped(t.runtime).groupBy(*PLAN_KEY).agg(
        F.count(F.lit(1)).alias("intervals"), *_mean_of("AvgDurationMs"), *_mean_of("AvgCpuTimeMs"),
        F.max("MaxDurationMs").alias("MaxDurationMs"), F.sum("CountExecutions").alias("executions"),
    )
    return plans.join(stats, PLAN_KEY, "left").groupBy(
        "PlanId", "CreationTime", "LastExecutionTime"
    ).agg(
        F.coalesce(F.sum("intervals"), F.lit(0)).alias("ExecutionIntervals"),
        _merge_mean("AvgDurationMs", "AvgDurationMs"),
        F.max("MaxDurationMs").alias("MaxDurationMs"),
        F.sum("executions").alias("TotalExecutions"),
        _merge_mean("AvgCpuTimeMs", "AvgCpuTimeMs"),
    ).orderBy(F.desc("CreationTime"), "PlanId")


def plan_averages(t: Telemetry, min_intervals: int = 10) -> DataFrame:
    """Mean duration per (query id, plan id) seen in more than ``min_intervals`` intervals."""
    per_interval = t.runtime.groupBy("QueryId", "PlanId", "RuntimeStatsIntervalId").agg(
        *_mean_of("AvgDurationMs")
    )
    return per_interval.groupBy("QueryId", "PlanId").agg(
        _merge_mean("AvgDurationMs", "AvgDuration"), F.count(F.lit(1)).alias("Intervals")
    ).filter(F.col("Intervals") > min_intervals)


# --- tenants and servers ------------------------------------------------------

def _query_grain(runtime: DataFrame) -> DataFrame:
    """One mergeable row per query, for reports that count distinct names."""
    return runtime.groupBy(*QUERY_KEY).agg(
        *_mean_of("AvgDurationMs"), *_mean_of("AvgMemoryUsedMb"),
        F.sum("CountExecutions").alias("executions"),
        F.sum(F.col("CountExecutions") * F.col("AvgCpuTimeMs")).alias("cpu_ms"),
        F.max("IsRegression").alias("regressed"),
    )


def tenant_performance(t: Telemetry, as_of: AsOf, days: int = 7) -> DataFrame:
    grain = _query_grain(t.loaded_since("runtime", as_of, days))
    return grain.groupBy("TenantName").agg(
        F.count_distinct("ServerName").alias("ServerCount"),
        F.count_distinct("DatabaseName").alias("DatabaseCount"),
        F.count_distinct("QueryId").alias("UniqueQueryCount"),
        _merge_mean("AvgDurationMs", "AvgDurationMs"),
        F.sum("executions").alias("TotalExecutions"),
        (F.sum("cpu_ms") / F.lit(MS_PER_HOUR)).alias("TotalCpuHours"),
        _merge_mean("AvgMemoryUsedMb", "AvgMemoryMB"),
    ).orderBy(F.desc("TotalCpuHours"), "TenantName")


def server_comparison(t: Telemetry, as_of: AsOf, days: int = 7) -> DataFrame:
    grain = _query_grain(t.loaded_since("runtime", as_of, days))
    return grain.groupBy("ServerName").agg(
        F.count_distinct("TenantName").alias("TenantCount"),
        F.count_distinct("DatabaseName").alias("DatabaseCount"),
        F.count_distinct("QueryId").alias("UniqueQueryCount"),
        _merge_mean("AvgDurationMs", "AvgDurationMs"),
        F.sum("executions").alias("TotalExecutions"),
        F.count_distinct(F.when(F.col("regressed"), F.col("QueryId"))).alias("RegressionQueryCount"),
    ).orderBy(F.desc("TotalExecutions"), "ServerName")


def tenant_server_duration(t: Telemetry) -> DataFrame:
    return t.runtime.groupBy(*HOST).agg(F.avg("AvgDurationMs").alias("AvgQueryDuration"))


def tenant_matrix(t: Telemetry) -> DataFrame:
    """One row per tenant from three separately aggregated sources."""
    performance = _query_grain(t.runtime).groupBy("TenantName").agg(
        F.count(F.lit(1)).alias("QueryCount"), _merge_mean("AvgDurationMs", "AvgDurationMs"),
        (F.sum("cpu_ms") / F.lit(MS_PER_HOUR)).alias("TotalCpuHours"),
    )
    waits = t.waits.groupBy("TenantName").agg(
        (F.sum("TotalWaitTimeMs").cast("double") / F.lit(MS_PER_HOUR)).alias("TotalWaitHours")
    )
    regressions = t.regressions.groupBy("TenantName").agg(
        F.count(F.lit(1)).alias("RegressionCount")
    )
    return performance.join(waits, "TenantName", "full_outer").join(
        regressions, "TenantName", "full_outer"
    )


def resource_usage(t: Telemetry) -> DataFrame:
    cpu = F.sum(F.col("CountExecutions") * F.col("AvgCpuTimeMs"))
    return t.runtime.groupBy(*HOST).agg(
        (cpu / F.lit(MS_PER_HOUR)).alias("TotalCpuHours"),
        F.avg("AvgMemoryUsedMb").alias("AvgMemoryMB"),
        F.avg("AvgLogicalIoReads").alias("AvgLogicalReads"),
        F.avg("AvgLogicalIoWrites").alias("AvgLogicalWrites"),
    )


def kpi_rollup(t: Telemetry) -> DataFrame:
    """Tenant, server and database drill-down with subtotals in one pass."""
    return t.runtime.rollup(*KEYS).agg(
        F.sum("CountExecutions").alias("TotalExecutions"),
        F.avg("AvgDurationMs").alias("AvgDurationMs"),
        F.max("MaxDurationMs").alias("MaxDurationMs"),
        F.grouping_id().cast("int").alias("Level"),
    )


# --- data quality, export, diagnostics ----------------------------------------

def data_quality(t: Telemetry) -> DataFrame:
    return orphan_counts(t)


def critical_nulls(t: Telemetry) -> DataFrame:
    return null_counts(
        dim_query(t.queries, t.texts), "DimQuery", ["QueryTextId", "ObjectId", "QueryText"]
    )


def top_query_export(t: Telemetry, limit: int = 1000) -> DataFrame:
    best = fact_top_queries(t.runtime, t.queries, t.texts, limit)
    return best.orderBy(F.desc("AvgDurationMs"), *QUERY_KEY).select(
        *QUERY_KEY, "QueryText", _money("AvgDurationMs").alias("AvgDurationMs"),
        _money("MaxDurationMs").alias("MaxDurationMs"), "TotalExecutions",
        _money("AvgCpuTimeMs").alias("AvgCpuTimeMs"), _money("AvgMemoryUsedMb").alias("AvgMemoryMB"),
    )


def export_csv(report: DataFrame, path: str) -> None:
    """Write a report for spreadsheets."""
    report.write.mode("overwrite").option("header", True).csv(path)


def load_health(
    t: Telemetry, as_of: AsOf, healthy_hours: int = 4, warning_hours: int = 24
) -> DataFrame:
    loads = t.run_log.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("LoadCount"), F.max("LastExtractTime").alias("LatestLoad")
    )
    now = as_of_column(as_of)
    status = (
        F.when(F.col("LatestLoad") >= ago(now, healthy_hours, "hour"), "HEALTHY")
        .when(F.col("LatestLoad") >= ago(now, warning_hours, "hour"), "WARNING")
        .otherwise("CRITICAL")
    )
    return loads.withColumn("Status", status).orderBy(F.desc("LatestLoad"), *KEYS)


def slow_loads(t: Telemetry, slow_seconds: int = 600, n: int = 20) -> DataFrame:
    health = (
        F.when(F.col("ExtractDurationSeconds") > slow_seconds, "SLOW")
        .when(F.col("ExtractStatus") == "FAILED", "FAILED")
        .otherwise("OK")
    )
    newest = top(t.run_log, n, [F.desc("LastExtractTime")], [*KEYS, "ETLControlId"])
    return newest.select(
        "LastExtractTime", *KEYS, "ExtractDurationSeconds", "RecordsInserted", "ExtractStatus",
        health.alias("Health"),
    )


def freshness_report(t: Telemetry, as_of: AsOf) -> DataFrame:
    per_interval = t.runtime.groupBy(*KEYS, "RuntimeStatsIntervalId").agg(
        F.min("LoadDate").alias("first"), F.max("LoadDate").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    loads = per_interval.groupBy(*KEYS).agg(
        F.max("last").alias("LastLoadTime"), F.min("first").alias("first"),
        F.sum("n").alias("RecordCount"), F.count(F.lit(1)).alias("IntervalCount"),
    )
    return loads.select(
        *KEYS, "LastLoadTime",
        boundary_diff("minute", F.col("LastLoadTime"), as_of_column(as_of)).alias("MinutesSinceLoad"),
        "RecordCount", "IntervalCount",
        boundary_diff("day", F.col("first"), F.col("LastLoadTime")).alias("DataAgeInDays"),
    ).orderBy(F.desc("LastLoadTime"), *KEYS)


# --- trends and roll-ups ------------------------------------------------------

def duration_trend(
    t: Telemetry, as_of: AsOf, days: int = 7, by: Sequence[str] = ("TenantName", "ServerName")
) -> DataFrame:
    """Daily average duration over the intervals started in the last ``days`` days."""
    recent = date_lookup(since_days(t.intervals, "IntervalStartTime", as_of, days))
    return evaluate(["Avg Duration (seconds)"], [*by, DATE], runtime=t.runtime, dates=recent)


def executions_per_day(t: Telemetry) -> DataFrame:
    return evaluate(["Total Executions"], [DATE], runtime=t.runtime, dates=date_lookup(t.intervals))


def daily_rollup(t: Telemetry) -> DataFrame:
    """Pre-aggregation by tenant, server and day.

    Sums and counts are kept instead of averages, so coarser reports can be
    computed from it exactly.
    """
    totals = {
        "Rows": F.count(F.lit(1)),
        "TotalExecutions": F.sum("CountExecutions"),
        "SumAvgDurationMs": F.sum("AvgDurationMs"),
        "SumAvgCpuTimeMs": F.sum("AvgCpuTimeMs"),
        "TotalCpuMs": F.sum(F.col("CountExecutions") * F.col("AvgCpuTimeMs")),
        "TotalDurationMs": F.sum(F.col("CountExecutions") * F.col("AvgDurationMs")),
    }
    per_interval = t.runtime.groupBy(*INTERVAL_KEY).agg(
        *[total.alias(name) for name, total in totals.items()],
        F.max("MaxDurationMs").alias("MaxDurationMs"),
    )
    return per_interval.join(date_lookup(t.intervals), INTERVAL_KEY).groupBy(*HOST, DATE).agg(
        *[F.sum(name).alias(name) for name in totals],
        F.max("MaxDurationMs").alias("MaxDurationMs"),
    )


# --- alerts -------------------------------------------------------------------

@dataclass(frozen=True)
class AlertThresholds:
    """Documented alert limits; the CPU limit is the site's own."""

    avg_duration_seconds: float = 5.0
    regression_hours: int = 1
    stale_hours: int = 4
    cpu_hours: float = 100.0


def alerts(t: Telemetry, as_of: AsOf, limits: AlertThresholds = AlertThresholds()) -> DataFrame:
    """All conditions that call for attention, one row each."""
    now = as_of_column(as_of)

    def alert(df: DataFrame, kind: str, value: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("Alert"), *KEYS, value.cast("double").alias("Value"))

    usage = t.runtime.groupBy(*KEYS).agg(
        F.avg("AvgDurationMs").alias("ms"),
        F.sum(F.col("CountExecutions") * F.col("AvgCpuTimeMs")).alias("cpu_ms"),
        F.max("LoadDate").alias("last"),
    ).withColumns({
        "seconds": F.col("ms") / F.lit(1000.0), "cpu_hours": F.col("cpu_ms") / F.lit(MS_PER_HOUR),
        "idle_hours": boundary_diff("hour", F.col("last"), now),
    })
    found = since_exact(t.regressions, "DetectionDate", as_of, limits.regression_hours, "hour")
    failed = t.run_log.filter(F.col("ExtractStatus") == "FAILED")

    def count_by_source(df: DataFrame) -> DataFrame:
        return df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))

    kinds = [
        alert(usage.filter(F.col("seconds") > limits.avg_duration_seconds),
              "Average duration", F.col("seconds")),
        alert(usage.filter(F.col("cpu_hours") > limits.cpu_hours), "CPU hours", F.col("cpu_hours")),
        alert(usage.filter(F.col("last") < ago(now, limits.stale_hours, "hour")),
              "No recent load", F.col("idle_hours")),
        alert(count_by_source(found), "New regression", F.col("n")),
        alert(count_by_source(failed), "Load failed", F.col("n")),
    ]
    return reduce(DataFrame.unionByName, kinds)


# --- saved views --------------------------------------------------------------

def bookmark_slow_queries(t: Telemetry, as_of: AsOf, days: int = 7) -> DataFrame:
    return slowest_queries(t, as_of, days, 10)


def bookmark_high_memory(t: Telemetry) -> DataFrame:
    return memory_hogs(t)


def bookmark_recent_regressions(t: Telemetry, as_of: AsOf) -> DataFrame:
    return recent_regressions(t, as_of)
