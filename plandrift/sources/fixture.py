"""Telemetry derived from the star-schema test tables.

No telemetry table exists in the test data, so line items stand in for runtime
statistics and events for waits. The derived tables are written once per
application to the shared folder and read back, as a loaded warehouse would be.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plandrift import schemas as S
from plandrift.functions.columns import boundary_diff, execution_type_desc
from plandrift.operators.rollup import daily_states
from plandrift.operators.regression import detect_plan_regressions
from plandrift.functions.filters import since_days
from plandrift.schemas import INTERVAL_KEY, KEYS, QUERY_KEY, Table
from plandrift.sources.warehouse import Telemetry, Warehouse, shared_dir

AS_OF = "2001-11-05 00:00:00"

# Wait category by event type, then by user id modulo 3.
WAIT_CATEGORIES = {
    "click": ["CPU", "Worker Thread", "Idle"],
    "view": ["Buffer IO", "Tran Log IO", "Replication"],
    "purchase": ["Lock", "Latch", "Buffer Latch"],
    "signup": ["Memory", "RESOURCE_SEMAPHORE", "Compilation"],
    "error": ["Network IO", "NETWORK", "Parallelism"],
}


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _quarter_start(interval_id: Column) -> Column:
    year, quarter = F.floor(interval_id / 4).cast("int"), interval_id % 4
    return F.make_date(year, quarter * 3 + 1, F.lit(1)).cast("timestamp")


def _plus(moment: Column, amount: Column, unit: str) -> Column:
    parts = {"days": F.lit(0), "hours": F.lit(0), unit: amount.cast("int")}
    return moment + F.make_dt_interval(days=parts["days"], hours=parts["hours"])


def _binary_id(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def _servers(read) -> DataFrame:
    nation, region = read("nation"), read("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        F.col("r_name").alias("TenantName"),
        F.col("n_name").alias("ServerName"),
    )


def _database_code() -> Column:
    """Number of a (server, database) pair, used to build readable surrogate ids."""
    server = F.regexp_extract("ServerName", r"(\d+)$", 1).cast("long")
    return server * 2 + (F.col("DatabaseName") == "DB_O").cast("long")


def runtime_stats(read) -> DataFrame:
    items, suppliers = read("lineitem"), read("supplier")
    quantity = F.col("l_quantity").cast("long")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    net_cents = F.round(
        F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * 100
    ).cast("long")
    code = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)

    rows = (
        items.join(suppliers, items.l_suppkey == suppliers.s_suppkey)
        .join(_servers(read), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "TenantName", "ServerName",
            F.concat(F.lit("DB_"), "l_linestatus").alias("DatabaseName"),
            (F.year("l_shipdate") * 4 + F.quarter("l_shipdate") - 1).cast("int")
            .alias("RuntimeStatsIntervalId"),
            (F.col("l_partkey") % 50).alias("QueryId"),
            (F.col("l_partkey") % 50 * 10 + F.col("l_linenumber") % 5).alias("PlanId"),
            code.cast("int").alias("ExecutionType"),
            quantity.alias("quantity"), cents.alias("cents"), net_cents.alias("net_cents"),
            F.col("l_extendedprice").alias("price"), F.col("l_linenumber").alias("line"),
        )
    )
    n = F.count(F.lit(1)).cast("double")
    grouped = rows.groupBy(*S.RUNTIME.keys).agg(
        F.sum("quantity").alias("CountExecutions"),
        (F.sum("cents").cast("double") / n / F.lit(1000.0)).alias("AvgDurationMs"),
        (F.max("price") / F.lit(10.0)).alias("MaxDurationMs"),
        (F.min("price") / F.lit(10.0)).alias("MinDurationMs"),
        (F.stddev_samp("price") / F.lit(10.0)).alias("StdevDurationMs"),
        F.floor(F.sum("quantity").cast("double") * F.lit(500.0) / n).cast("long").alias("AvgLogicalIoReads"),
        (F.sum("net_cents").cast("double") / n / F.lit(2000.0)).alias("AvgCpuTimeMs"),
        (F.sum("quantity").cast("double") * F.lit(4.0) / n).alias("AvgMemoryUsedMb"),
        (F.sum("line").cast("double") * F.lit(50.0) / n).alias("AvgRowCount"),
    )

    def tenth(column: str, divisor: int) -> Column:
        return F.floor(F.col(column) / divisor).cast("long")

    grouped = grouped.withColumns({
        "AvgLogicalIoWrites": tenth("AvgLogicalIoReads", 10),
        "AvgPhysicalIoReads": tenth("AvgLogicalIoReads", 20),
        "AvgClrTimeMs": F.lit(0.0),
        "AvgElapsedTimeMs": F.col("AvgDurationMs"),
        "MaxElapsedTimeMs": F.col("MaxDurationMs"),
        "MinElapsedTimeMs": F.col("MinDurationMs"),
    })
    extremes = {}
    for metric in ("LogicalIoReads", "LogicalIoWrites", "PhysicalIoReads"):
        extremes[f"Max{metric}"] = F.col(f"Avg{metric}") * 2
        extremes[f"Min{metric}"] = tenth(f"Avg{metric}", 2)
    for metric in ("CpuTimeMs", "ClrTimeMs", "MemoryUsedMb"):
        extremes[f"Max{metric}"] = F.col(f"Avg{metric}") * 2
        extremes[f"Min{metric}"] = F.col(f"Avg{metric}") / 2
    extremes["MaxRowCount"] = F.floor(F.col("AvgRowCount") * 2).cast("long")
    extremes["MinRowCount"] = F.floor(F.col("AvgRowCount") / 2).cast("long")
    interval = F.col("RuntimeStatsIntervalId")
    return grouped.withColumns({
        **extremes,
        "ExecutionTypeDesc": execution_type_desc(F.col("ExecutionType")),
        "LoadDate": _plus(_quarter_start(interval), F.col("QueryId") % 35, "days"),
        "IsRegression": (F.col("QueryId") % 7 == 3) & (F.col("PlanId") % 5 == 4) & (interval % 3 == 0),
        "RuntimeStatsId": ((_database_code() * 10000 + interval) * 500 + F.col("PlanId")) * 3
        + F.col("ExecutionType"),
    }).select(*S.RUNTIME.columns)


def _wait_events(read) -> DataFrame:
    """One row per event, tagged like an extracted wait record."""
    events = read("events")
    category = F.lit(None).cast("string")
    for kind, names in WAIT_CATEGORIES.items():
        for remainder, name in enumerate(names):
            category = F.when(
                (F.col("event_type") == kind) & (F.col("user_id") % 3 == remainder), name
            ).otherwise(category)
    ranked = sorted(name for names in WAIT_CATEGORIES.values() for name in names)
    rank = F.array_position(F.array(*[F.lit(n) for n in ranked]), F.col("WaitCategory")).cast("int")
    return (
        events.join(_servers(read), F.col("user_id") % 25 == F.col("n_nationkey"))
        .select(
            "TenantName", "ServerName",
            F.when(F.col("user_id") % 2 == 0, "DB_F").otherwise("DB_O").alias("DatabaseName"),
            (F.lit(7980) + F.col("event_id") % 28).cast("int").alias("RuntimeStatsIntervalId"),
            (F.col("event_id") % 50).alias("QueryId"),
            (F.col("event_id") % 50 * 10 + F.col("event_id") % 3).alias("PlanId"),
            category.alias("WaitCategory"),
            F.round(F.col("value") * 100).cast("long").alias("cents"),
            (F.col("event_id") % 2).cast("int").alias("bucket"),
        )
        .withColumn("WaitCategoryId", rank)
    )


def wait_stats(read) -> DataFrame:
    grouped = _wait_events(read).groupBy(*S.WAIT.keys, "WaitCategoryId").agg(
        F.sum("cents").alias("TotalWaitTimeMs"),
        (F.sum("cents").cast("double") / F.count(F.lit(1)).cast("double")).alias("AvgWaitTimeMs"),
        F.max("cents").alias("MaxWaitTimeMs"),
        F.count(F.lit(1)).alias("CountWaits"),
    )
    interval = F.col("RuntimeStatsIntervalId")
    return grouped.withColumns({
        "QueryWaitTimeCategory": F.lit(0),
        "LoadDate": _plus(_quarter_start(interval), F.col("QueryId") % 35, "days"),
        "WaitStatsId": ((_database_code() * 10000 + interval) * 500 + F.col("PlanId")) * 20
        + F.col("WaitCategoryId"),
    }).select(*S.WAIT.columns)


def intervals(runtime: DataFrame) -> DataFrame:
    start = _quarter_start(F.col("RuntimeStatsIntervalId"))
    end = F.add_months(start, 3).cast("timestamp")
    return runtime.select(*INTERVAL_KEY).distinct().select(
        *INTERVAL_KEY,
        start.alias("IntervalStartTime"),
        end.alias("IntervalEndTime"),
        boundary_diff("minute", start, end).alias("IntervalDurationMinutes"),
        F.to_date(start).alias("CapturedDate"),
        F.lit("00:00:00.000000").alias("CapturedTime"),
        start.alias("LoadDate"),
    )


def hourly_intervals(read) -> DataFrame:
    """A second interval table with real hours, for the time-of-day columns."""
    start = F.date_trunc("hour", F.col("ts")).cast("timestamp")
    hours = read("events").select(
        F.col("user_id") % 25, start.alias("IntervalStartTime")
    ).toDF("n_nationkey", "IntervalStartTime").distinct()
    end = F.col("IntervalStartTime") + F.expr("INTERVAL 1 HOUR")
    return hours.join(_servers(read), "n_nationkey").select(
        "TenantName", "ServerName",
        (F.unix_timestamp("IntervalStartTime") / 3600).cast("int").alias("RuntimeStatsIntervalId"),
        "IntervalStartTime", end.alias("IntervalEndTime"),
        F.lit(60).alias("IntervalDurationMinutes"),
        F.to_date("IntervalStartTime").alias("CapturedDate"),
        F.date_format("IntervalStartTime", "HH:mm:ss.SSSSSS").alias("CapturedTime"),
        end.alias("LoadDate"),
    )


def queries(runtime: DataFrame) -> DataFrame:
    query = F.col("QueryId")
    start = _plus(_as_of(), -(query % 60), "days")
    object_id = F.when(query % 3 == 1, F.lit(0)).when(query % 3 == 2, query)
    return runtime.filter(query != 49).select(*QUERY_KEY).distinct().select(
        *QUERY_KEY, query.alias("QueryTextId"), F.lit(1).cast("long").alias("ContextSettingsId"),
        object_id.cast("long").alias("ObjectId"),
        start.alias("CompilationStartTime"),
        (start + F.expr("INTERVAL 1 MINUTE")).alias("CompilationEndTime"),
        (query * 3).alias("LastCompilationBatch"),
        start.alias("LastCompilationBatchUTC"),
        (query % 9 + 1).alias("CompilationCount"),
        (query * F.lit(1.5)).alias("AvgCompileCpuTimeMs"),
        (query * F.lit(3.0)).alias("MaxCompileCpuTimeMs"),
        (query * F.lit(0.25)).alias("AvgCompileMemoryMb"),
        (query * F.lit(0.5)).alias("MaxCompileMemoryMb"),
        _plus(_as_of(), -(query % 35), "days").alias("LoadDate"),
    )


def query_texts(query_table: DataFrame, read) -> DataFrame:
    text_id = F.col("QueryTextId")
    names = read("part").select(
        F.col("p_partkey").alias("QueryTextId"),
        F.concat(F.lit("SELECT "), "p_name").alias("QueryTextContent"),
    )
    return (
        query_table.filter(text_id % 10 != 7)
        .select(*KEYS, "QueryTextId", "LoadDate")
        .join(names, "QueryTextId")
        .select(
            *KEYS, "QueryTextId", "QueryTextContent",
            F.lit("SELECT").alias("StatementType"),
            _binary_id(text_id).alias("QueryHash"),
            F.lit(None).cast("binary").alias("QueryPlanHash"),
            "LoadDate",
        )
    )


def plans(runtime: DataFrame) -> DataFrame:
    seen = runtime.select(*QUERY_KEY, "PlanId").distinct()
    unused = runtime.select(*QUERY_KEY).distinct().withColumn("PlanId", F.col("QueryId") * 10 + 9)
    plan = F.col("PlanId")
    created = _plus(_as_of(), -(plan % 200), "days")
    return seen.unionByName(unused).select(
        *KEYS, "PlanId", "QueryId",
        F.lit("16.0").alias("EngineVersion"),
        (F.lit(150) + plan % 2 * 10).cast("int").alias("CompatibilityLevel"),
        _binary_id(plan).alias("QueryPlanHash"),
        _binary_id(F.col("QueryId")).alias("QueryHash"),
        F.lit(None).cast("binary").alias("PlanHandle"),
        created.alias("CreationTime"),
        _plus(created, plan % 40 * 31, "hours").alias("LastExecutionTime"),
        F.when(plan % 3 == 0, _binary_id(plan)).alias("QueryPlanCompressed"),
        F.when(plan % 3 == 1, "<plan/>").alias("QueryPlanText"),
        F.lit(None).cast("boolean").alias("IsOnlineIndexPlan"),
        (plan % 2 == 0).alias("IsParallelizable"),
        _plus(_as_of(), -(F.col("QueryId") % 35), "days").alias("LoadDate"),
    )


def regressions(runtime: DataFrame) -> DataFrame:
    """All detected regressions, spread over the fifty days before ``AS_OF``."""
    query, old, new = F.col("QueryId"), F.col("OldPlanId"), F.col("NewPlanId")
    hours = (query * 37 + new * 5) % 1200
    return detect_plan_regressions(runtime, None, AS_OF).withColumns({
        "RegressionId": (_database_code() * 50 + query) * 100 + old % 10 * 10 + new % 10,
        "DetectionDate": _plus(_as_of(), -hours, "hours"),
        "IsInvestigated": query % 4 == 0,
        "Notes": F.when(query % 4 == 0, "checked"),
    }).select(*S.REGRESSION.columns)


def run_log(runtime: DataFrame) -> DataFrame:
    interval = F.col("RuntimeStatsIntervalId")
    loaded = runtime.groupBy(*KEYS, "RuntimeStatsIntervalId").agg(F.count(F.lit(1)).alias("n"))
    hours = (
        F.lit(34 * 24) + interval % 24 + F.when(F.col("DatabaseName") == "DB_O", 7).otherwise(0)
        - F.floor(_database_code() / 2) % 3 * 24
    )
    extracted = _plus(_quarter_start(interval), hours, "hours")
    failed = interval % 11 == 0
    return loaded.select(
        (_database_code() * 10000 + interval).alias("ETLControlId"), *KEYS,
        extracted.alias("LastExtractTime"),
        (interval * 37 % 900).cast("int").alias("ExtractDurationSeconds"),
        F.col("n").alias("RecordsInserted"),
        (interval % 5).cast("long").alias("RecordsUpdated"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("ExtractStatus"),
        F.when(failed, "timeout").alias("ErrorMessage"),
        extracted.alias("LoadDate"),
    )


_written: set[str] = set()


class Fixture:
    """Derived tables of one data folder, each written on first use."""

    def __init__(self, spark: SparkSession, data_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        digest = hashlib.sha256(data_dir.encode()).hexdigest()[:12]
        root = f"{shared_dir(spark)}/plandrift/{spark.sparkContext.applicationId}/{digest}"
        self.spark, self.data_dir = spark, data_dir.rstrip("/")
        self.warehouse = Warehouse(spark, root)

    def read_source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")

    def build(self, table: Table) -> DataFrame:
        """The derivation itself, lazily; dependent tables come from storage."""
        read = self.read_source
        if table is S.RUNTIME:
            return runtime_stats(read)
        if table is S.WAIT:
            return wait_stats(read)
        if table is S.QUERY_TEXT:
            return query_texts(self.table(S.QUERY), read)
        if table is S.RUNTIME_DAILY:
            return daily_states(self.table(S.RUNTIME), self.table(S.INTERVAL))
        from_runtime = {
            S.INTERVAL.name: intervals, S.QUERY.name: queries, S.PLAN.name: plans,
            S.REGRESSION.name: regressions, S.RUN_LOG.name: run_log,
        }
        return from_runtime[table.name](self.table(S.RUNTIME))

    def table(self, table: Table) -> DataFrame:
        path = self.warehouse.path(table)
        if path not in _written:
            self.warehouse.create(table, self.build(table))
            _written.add(path)
        return self.warehouse.read(table)

    def since(self, as_of: str, days: int) -> Telemetry:
        """All tables, the facts cut to the buckets of the last ``days`` days' intervals."""
        every = self.telemetry  # writes what is not there yet
        return self.warehouse.telemetry(since_days(every.intervals, "IntervalStartTime", as_of, days))

    @property
    def telemetry(self) -> Telemetry:
        for table in S.TABLES.values():
            self.table(table)
        return self.warehouse.telemetry()
