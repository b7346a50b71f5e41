"""Star schema over the base tables: four dimensions, four facts. All lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plandrift.functions.columns import (
    boundary_diff, dim_key, query_type, wait_category_group, wait_minutes,
)
from plandrift.functions.ranking import top
from plandrift.schemas import INTERVAL_KEY, KEYS, PLAN_KEY, QUERY_KEY
from plandrift.sources.warehouse import Telemetry


def _identified(df: DataFrame, name: str, id_column: str) -> DataFrame:
    return df.withColumn(name, dim_key(id_column))


def dim_query(queries: DataFrame, texts: DataFrame) -> DataFrame:
    """Queries with their text, where one was captured. Hashes are shown in hex."""
    text = texts.select(
        *KEYS, "QueryTextId", F.col("QueryTextContent").alias("QueryText"), "StatementType",
        F.hex("QueryHash").alias("QueryHash"), F.hex("QueryPlanHash").alias("QueryPlanHash"),
    )
    return _identified(
        queries.join(text, [*KEYS, "QueryTextId"], "left"), "QueryDimKey", "QueryId"
    ).select(
        "QueryDimKey", *QUERY_KEY, "QueryTextId", "ObjectId", "QueryText", "StatementType",
        "QueryHash", "QueryPlanHash", query_type(F.col("ObjectId")).alias("QueryType"),
        "CompilationCount", "AvgCompileCpuTimeMs", "MaxCompileCpuTimeMs",
        "AvgCompileMemoryMb", "MaxCompileMemoryMb", "CompilationStartTime", "LoadDate",
    )


def dim_plan(plans: DataFrame) -> DataFrame:
    storage = (
        F.when(F.col("QueryPlanCompressed").isNotNull(), "Compressed")
        .when(F.col("QueryPlanText").isNotNull(), "XML")
        .otherwise("Unknown")
    )
    age = boundary_diff("day", F.col("CreationTime"), F.col("LastExecutionTime"))
    return _identified(plans, "PlanDimKey", "PlanId").select(
        "PlanDimKey", *PLAN_KEY, "QueryId", "EngineVersion", "CompatibilityLevel",
        F.hex("QueryHash").alias("QueryHash"), F.hex("QueryPlanHash").alias("QueryPlanHash"),
        F.hex("PlanHandle").alias("PlanHandle"), "CreationTime", "LastExecutionTime",
        age.alias("PlanAgeInDays"), "IsOnlineIndexPlan", "IsParallelizable",
        storage.alias("PlanStorage"), "LoadDate",
    )


def dim_interval(intervals: DataFrame) -> DataFrame:
    start = F.col("IntervalStartTime")
    return intervals.select(
        *INTERVAL_KEY, "IntervalStartTime", "IntervalEndTime", "IntervalDurationMinutes",
        F.to_date(start).alias("IntervalDate"),
        F.date_format(start, "H:mm").alias("IntervalTimeOfDay"),
        F.date_format(start, "EEEE").alias("IntervalDayOfWeek"),
        "LoadDate",
    )


def dim_wait_category(waits: DataFrame) -> DataFrame:
    distinct = waits.select("WaitCategoryId", "WaitCategory").distinct()
    return distinct.withColumn("WaitCategoryGroup", wait_category_group(F.col("WaitCategory")))


def fact_runtime_stats(runtime: DataFrame) -> DataFrame:
    """Runtime facts with derived columns; per-metric minima stay in the base table."""
    cpu_share = F.try_divide("AvgCpuTimeMs", "AvgDurationMs") * F.lit(100.0)
    status = F.when(F.col("IsRegression"), "Regression Detected").otherwise("Normal")
    return runtime.select(
        "RuntimeStatsId", dim_key("QueryId").alias("QueryDimKey"),
        dim_key("PlanId").alias("PlanDimKey"), "RuntimeStatsIntervalId", *QUERY_KEY, "PlanId",
        "ExecutionType", "ExecutionTypeDesc", "CountExecutions",
        "AvgDurationMs", (F.col("AvgDurationMs") / F.lit(1000.0)).alias("AvgDurationSeconds"),
        "MaxDurationMs", "MinDurationMs",
        F.coalesce("StdevDurationMs", F.lit(0.0)).alias("StdevDurationMs"),
        "AvgLogicalIoReads", "MaxLogicalIoReads", "AvgLogicalIoWrites", "MaxLogicalIoWrites",
        "AvgPhysicalIoReads", "MaxPhysicalIoReads",
        "AvgCpuTimeMs", (F.col("AvgCpuTimeMs") / F.lit(1000.0)).alias("AvgCpuTimeSeconds"),
        "MaxCpuTimeMs", "AvgClrTimeMs", "MaxClrTimeMs", "AvgElapsedTimeMs", "MaxElapsedTimeMs",
        "AvgMemoryUsedMb", "MaxMemoryUsedMb", "AvgRowCount", "MaxRowCount", "MinRowCount",
        cpu_share.alias("CpuPercentageOfDuration"), "IsRegression",
        status.alias("PerformanceStatus"), "LoadDate",
    )


def fact_wait_stats(waits: DataFrame) -> DataFrame:
    return waits.select(
        "WaitStatsId", dim_key("QueryId").alias("QueryDimKey"), "RuntimeStatsIntervalId",
        *QUERY_KEY, "PlanId", "WaitCategory", "WaitCategoryId",
        wait_category_group(F.col("WaitCategory")).alias("WaitCategoryGroup"),
        "TotalWaitTimeMs", wait_minutes().alias("TotalWaitTimeMinutes"), "AvgWaitTimeMs",
        "MaxWaitTimeMs", "CountWaits", "QueryWaitTimeCategory", "LoadDate",
    )


def fact_top_queries(
    runtime: DataFrame, queries: DataFrame, texts: DataFrame, limit: int = 1000
) -> DataFrame:
    """Queries with the largest total duration.

    Facts are reduced to one row per query and cut to the top rows before any
    text is joined. ``AvgLogicalIoReads`` is a sum under its historical name;
    ``TotalLogicalIoReads`` repeats it under the right one.
    """
    per_query = runtime.groupBy(*QUERY_KEY).agg(
        F.sum("CountExecutions").alias("TotalExecutions"),
        F.avg("AvgDurationMs").alias("AvgDurationMs"),
        F.max("MaxDurationMs").alias("MaxDurationMs"),
        (F.sum(F.col("CountExecutions") * F.col("AvgDurationMs")) / F.lit(1000.0))
        .alias("TotalDurationSeconds"),
        F.avg("AvgCpuTimeMs").alias("AvgCpuTimeMs"),
        F.sum("AvgLogicalIoReads").alias("AvgLogicalIoReads"),
        F.avg("AvgMemoryUsedMb").alias("AvgMemoryUsedMb"),
        F.count_distinct("RuntimeStatsIntervalId").alias("IntervalsObserved"),
    )
    best = top(per_query, limit, [F.desc("TotalDurationSeconds")], QUERY_KEY)
    return with_query_text(best, queries, texts).withColumn(
        "TotalLogicalIoReads", F.col("AvgLogicalIoReads")
    ).select(
        *QUERY_KEY, "QueryText", "TotalExecutions", "AvgDurationMs", "MaxDurationMs",
        "TotalDurationSeconds", "AvgCpuTimeMs", "AvgLogicalIoReads", "TotalLogicalIoReads",
        "AvgMemoryUsedMb", "IntervalsObserved",
    )


def with_query_text(df: DataFrame, queries: DataFrame, texts: DataFrame) -> DataFrame:
    """Add ``QueryText`` to rows carrying the query key; rows without text are kept."""
    named = df.join(queries.select(*QUERY_KEY, "QueryTextId"), QUERY_KEY, "left")
    content = texts.select(*KEYS, "QueryTextId", F.col("QueryTextContent").alias("QueryText"))
    return named.join(content, [*KEYS, "QueryTextId"], "left")


def fact_wait_summary(waits: DataFrame) -> DataFrame:
    summary = waits.groupBy(*KEYS, "WaitCategory").agg(
        F.sum("TotalWaitTimeMs").alias("TotalWaitTimeMs"),
        F.sum("CountWaits").alias("TotalWaits"),
        F.avg("AvgWaitTimeMs").alias("AvgWaitTimeMs"),
        F.max("MaxWaitTimeMs").alias("MaxWaitTimeMs"),
    )
    return summary.withColumns({
        "WaitCategoryGroup": wait_category_group(F.col("WaitCategory")),
        "TotalWaitTimeMinutes": wait_minutes(),
    })


def with_interval_date(fact: DataFrame, intervals: DataFrame) -> DataFrame:
    dates = intervals.select(*INTERVAL_KEY, F.to_date("IntervalStartTime").alias("IntervalDate"))
    return fact.join(dates, INTERVAL_KEY, "left")


def star(fact: DataFrame, t: Telemetry) -> DataFrame:
    """A fact with its interval, query and plan attributes, on full natural keys."""
    interval = dim_interval(t.intervals).select(
        *INTERVAL_KEY, "IntervalDate", "IntervalTimeOfDay", "IntervalDayOfWeek"
    )
    query = dim_query(t.queries, t.texts).select(*QUERY_KEY, "QueryText", "QueryType")
    plan = dim_plan(t.plans).select(*PLAN_KEY, "EngineVersion", "PlanAgeInDays", "PlanStorage")
    return (
        fact.join(interval, INTERVAL_KEY, "left")
        .join(query, QUERY_KEY, "left")
        .join(plan, PLAN_KEY, "left")
    )


def register_views(spark: SparkSession, t: Telemetry) -> None:
    """Make the star schema available to ``spark.sql`` under its public names."""
    views = {
        "DimQuery": dim_query(t.queries, t.texts),
        "DimPlan": dim_plan(t.plans),
        "DimInterval": dim_interval(t.intervals),
        "DimWaitCategory": dim_wait_category(t.waits),
        "FactRuntimeStats": fact_runtime_stats(t.runtime),
        "FactWaitStats": fact_wait_stats(t.waits),
        "FactTopQueries": fact_top_queries(t.runtime, t.queries, t.texts),
        "FactWaitSummary": fact_wait_summary(t.waits),
        "QueryStoreRuntimeStats": t.runtime,
        "QueryStoreWaitStats": t.waits,
        "QueryStoreQuery": t.queries,
        "QueryStoreQueryText": t.texts,
        "QueryStorePlan": t.plans,
        "RuntimeStatsInterval": t.intervals,
        "PlanRegressions": t.regressions,
        "ETLControl": t.run_log,
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
