"""Extraction: raw telemetry records to staging rows.

Raw records use the source's own column names and carry the three key columns
(see ``tag`` and ``read_landing``). One plan serves any number of sources; what
the source-side queries computed per database is computed per key here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from plandrift import schemas as S
from plandrift.functions.columns import AsOf, ago, as_of_column, boundary_diff, execution_type_desc
from plandrift.schemas import KEYS, Table

RECENT_INTERVALS = 100
INTERVAL_DAYS = 7
QUERY_DAYS = 30

RAW = {
    S.INTERVAL.name: "runtime_stats_interval",
    S.QUERY.name: "query",
    S.QUERY_TEXT.name: "query_text",
    S.PLAN.name: "plan",
    S.RUNTIME.name: "runtime_stats",
    S.WAIT.name: "wait_stats",
}

# Metric name in the source and in the warehouse.
_METRICS = {
    "duration_ms": "DurationMs",
    "logical_io_reads": "LogicalIoReads",
    "logical_io_writes": "LogicalIoWrites",
    "physical_io_reads": "PhysicalIoReads",
    "cpu_time_ms": "CpuTimeMs",
    "clr_time_ms": "ClrTimeMs",
    "elapsed_time_ms": "ElapsedTimeMs",
    "memory_used_mb": "MemoryUsedMb",
    "rowcount": "RowCount",
}


def raw_metric_names() -> dict[str, str]:
    """Source column to warehouse column for every runtime metric."""
    names = {"count_executions": "CountExecutions", "stdev_duration_ms": "StdevDurationMs"}
    for raw, ours in _METRICS.items():
        for stat in ("avg", "max", "min"):
            names[f"{stat}_{raw}"] = f"{stat.capitalize()}{ours}"
    return names


def tag(raw: DataFrame, tenant: str, server: str, database: str) -> DataFrame:
    """Mark the records of one source with their tenant, server and database."""
    return raw.withColumns({
        "TenantName": F.lit(tenant), "ServerName": F.lit(server), "DatabaseName": F.lit(database),
    })


def combine(sources: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def _as_staging(df: DataFrame, table: Table) -> DataFrame:
    fields = table.staging_schema.fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def extract_intervals(raw: DataFrame, as_of: AsOf, days: int = INTERVAL_DAYS) -> DataFrame:
    """Intervals started in the last ``days`` days, with duration, date and time of day."""
    start, end = F.col("start_time"), F.col("end_time")
    recent = raw.filter(start >= ago(as_of_column(as_of), days, "day"))
    return _as_staging(recent.select(
        "TenantName", "ServerName",
        F.col("runtime_stats_interval_id").alias("RuntimeStatsIntervalId"),
        start.alias("IntervalStartTime"), end.alias("IntervalEndTime"),
        boundary_diff("minute", start, end).alias("IntervalDurationMinutes"),
        F.to_date(start).alias("CapturedDate"),
        F.date_format(start, "HH:mm:ss.SSSSSS").alias("CapturedTime"),
    ), S.INTERVAL)


def extract_queries(raw: DataFrame, as_of: AsOf, days: int = QUERY_DAYS) -> DataFrame:
    recent = raw.filter(F.col("creation_time") >= ago(as_of_column(as_of), days, "day"))
    names = {
        "query_id": "QueryId", "query_text_id": "QueryTextId",
        "context_settings_id": "ContextSettingsId", "object_id": "ObjectId",
        "creation_time": "CompilationStartTime", "last_compile_start_time": "CompilationEndTime",
        "last_compile_batch_id": "LastCompilationBatch",
        "last_compile_batch_time_ms": "LastCompilationBatchUTC",
        "count_compiles": "CompilationCount",
        "avg_compile_cpu_time_ms": "AvgCompileCpuTimeMs",
        "max_compile_cpu_time_ms": "MaxCompileCpuTimeMs",
        "avg_compile_memory_mb": "AvgCompileMemoryMb",
        "max_compile_memory_mb": "MaxCompileMemoryMb",
    }
    return _as_staging(recent.withColumnsRenamed(names), S.QUERY)


def extract_query_texts(raw: DataFrame) -> DataFrame:
    """All texts; the hash is eight bytes of the text's 64-bit hash."""
    digest = F.unhex(F.lpad(F.hex(F.xxhash64("query_sql_text")), 16, "0"))
    return _as_staging(raw.select(
        *KEYS, F.col("query_text_id").alias("QueryTextId"),
        F.col("query_sql_text").alias("QueryTextContent"),
        F.col("statement_sql_handle").alias("StatementType"),
        digest.alias("QueryHash"), F.lit(None).alias("QueryPlanHash"),
    ), S.QUERY_TEXT)


def extract_plans(raw: DataFrame) -> DataFrame:
    """All plans; columns no source delivers are null."""
    nothing = F.lit(None)
    return _as_staging(raw.select(
        *KEYS, F.col("plan_id").alias("PlanId"), F.col("query_id").alias("QueryId"),
        F.col("engine_version").alias("EngineVersion"),
        F.col("compatibility_level").alias("CompatibilityLevel"),
        F.col("query_plan_hash").alias("QueryPlanHash"), nothing.alias("QueryHash"),
        F.col("plan_handle").alias("PlanHandle"), F.col("creation_time").alias("CreationTime"),
        F.col("last_execution_time").alias("LastExecutionTime"),
        nothing.alias("QueryPlanCompressed"), F.col("query_plan").alias("QueryPlanText"),
        nothing.alias("IsOnlineIndexPlan"), nothing.alias("IsParallelizable"),
    ), S.PLAN)


def _recent(raw: DataFrame, raw_intervals: DataFrame, last: int) -> DataFrame:
    """Records within the newest ``last`` interval ids of their own source.

    One row per source is joined to all records: Spark broadcasts the side once its
    size is known, and splits large sources where it has to shuffle them.
    """
    newest = raw_intervals.groupBy(*KEYS).agg(
        (F.max("runtime_stats_interval_id") - last).alias("_oldest")
    )
    return raw.join(newest, KEYS).filter(
        F.col("runtime_stats_interval_id") >= F.col("_oldest")
    ).drop("_oldest")


def extract_runtime_stats(
    raw: DataFrame, raw_intervals: DataFrame, last: int = RECENT_INTERVALS
) -> DataFrame:
    code = F.col("execution_type")
    renamed = _recent(raw, raw_intervals, last).select(
        *KEYS, F.col("runtime_stats_interval_id").alias("RuntimeStatsIntervalId"),
        F.col("query_id").alias("QueryId"), F.col("plan_id").alias("PlanId"),
        code.alias("ExecutionType"), execution_type_desc(code).alias("ExecutionTypeDesc"),
        *[F.col(raw_name).alias(name) for raw_name, name in raw_metric_names().items()],
    )
    return _as_staging(renamed, S.RUNTIME)


def extract_wait_buckets(
    raw_waits: DataFrame,
    raw_runtime: DataFrame,
    raw_intervals: DataFrame,
    categories: DataFrame,
    last: int = RECENT_INTERVALS,
) -> DataFrame:
    """Waits per query, plan, interval, category and duration bucket.

    Only combinations with runtime statistics are kept. Those are reduced to
    distinct keys first, or each wait would repeat per execution type.
    ``StdevWaitTimeMs`` is delivered although no warehouse column stores it.
    """
    at = [*KEYS, "query_id", "plan_id", "runtime_stats_interval_id"]
    waits = _recent(raw_waits, raw_intervals, last).groupBy(
        *at, "wait_category", "query_wait_time_bucket_id"
    ).agg(
        F.sum("total_query_wait_time_ms").alias("TotalWaitTimeMs"),
        F.avg("avg_query_wait_time_ms").alias("AvgWaitTimeMs"),
        F.max("max_query_wait_time_ms").alias("MaxWaitTimeMs"),
        F.stddev_samp("avg_query_wait_time_ms").alias("StdevWaitTimeMs"),
        F.sum("count_executions").alias("CountWaits"),
    )
    executed = raw_runtime.select(*at).distinct()
    named = categories.select("wait_category", F.col("wait_category_desc").alias("WaitCategory"))
    return waits.join(executed, at, "left_semi").join(named, "wait_category").select(
        *KEYS, F.col("runtime_stats_interval_id").cast("int").alias("RuntimeStatsIntervalId"),
        F.col("query_id").alias("QueryId"), F.col("plan_id").alias("PlanId"), "WaitCategory",
        F.col("wait_category").cast("int").alias("WaitCategoryId"),
        "TotalWaitTimeMs", "AvgWaitTimeMs", "MaxWaitTimeMs", "StdevWaitTimeMs",
        F.col("query_wait_time_bucket_id").cast("int").alias("QueryWaitTimeCategory"), "CountWaits",
    )


def read_landing(spark: SparkSession, root: str, table: Table, columns=None) -> DataFrame:
    """Raw records of all sources below ``root``.

    Files lie in ``<raw name>/TenantName=.../ServerName=.../DatabaseName=...``,
    so the folder names tag the rows and a filter on them skips whole sources.
    """
    reader = spark.read.option("basePath", f"{root}/{RAW[table.name]}")
    if columns is not None:
        reader = reader.schema(columns)
    return reader.parquet(f"{root}/{RAW[table.name]}").withColumns(
        {k: F.col(k).cast("string") for k in KEYS}
    )


def jdbc_reader(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    partition: tuple[str, int, int, int] | None = None,
    timeout_seconds: int = 300,
):
    """Reader for a remote source database.

    The query runs on the source, so its filter and projection are applied
    there. ``partition`` is (column, lower, upper, parts) for a parallel read.
    """
    reader = (
        spark.read.format("jdbc").option("url", url)
        .option("queryTimeout", timeout_seconds).option("fetchsize", 10_000)
        .options(**(properties or {}))
    )
    if partition is None:
        return reader.option("query", query)
    column, lower, upper, parts = partition
    return reader.option("dbtable", f"({query}) source").options(
        partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
    )
