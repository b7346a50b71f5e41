"""Checks of views, filters, joins and set operations."""

from pyspark.sql import functions as F

from checks.base import K, NOW, QK, Check, each, hex_id, wait_group
from plandrift import schemas as S
from plandrift.functions import filters as FI
from plandrift.functions.columns import boundary_diff, wait_category_group
from plandrift.operators import quality, regression, retention, upsert
from plandrift.plans import reports, views
from plandrift.schemas import KEYS, PLAN_KEY, QUERY_KEY
from plandrift.sources.fixture import AS_OF, hourly_intervals

CHECKS: dict[str, Check] = {}

# --- views ----------------------------------------------------------------------

CHECKS["v1_dim_query"] = Check(
    lambda f: views.dim_query(f.table(S.QUERY), f.table(S.QUERY_TEXT)),
    f"""SELECT concat_ws('_', {QK}) AS QueryDimKey, {QK}, QueryTextId, ObjectId, QueryText,
      StatementType, QueryHash, CAST(NULL AS VARCHAR) AS QueryPlanHash,
      CASE WHEN ObjectId > 0 THEN 'Stored Procedure' WHEN ObjectId = 0 THEN 'Ad-hoc Query'
        ELSE 'Unknown' END AS QueryType,
      CompilationCount, AvgCompileCpuTimeMs, MaxCompileCpuTimeMs, AvgCompileMemoryMb,
      MaxCompileMemoryMb, CompilationStartTime, LoadDate FROM dq""",
    ["dq"],
)
CHECKS["v2_dim_plan"] = Check(
    lambda f: views.dim_plan(f.table(S.PLAN)),
    f"""SELECT concat_ws('_', {K}, PlanId) AS PlanDimKey, {K}, PlanId, QueryId, EngineVersion,
      CompatibilityLevel, QueryHash, QueryPlanHash, CAST(NULL AS VARCHAR) AS PlanHandle,
      CreationTime, LastExecutionTime,
      CAST(date_diff('day', CreationTime, LastExecutionTime) AS INTEGER) AS PlanAgeInDays,
      CAST(NULL AS BOOLEAN) AS IsOnlineIndexPlan, IsParallelizable,
      CASE WHEN QueryPlanCompressed IS NOT NULL THEN 'Compressed'
        WHEN QueryPlanText IS NOT NULL THEN 'XML' ELSE 'Unknown' END AS PlanStorage,
      LoadDate FROM plans""",
    ["plans"],
)
CHECKS["v3_dim_interval"] = Check(
    lambda f: views.dim_interval(f.table(S.INTERVAL)),
    """SELECT TenantName, ServerName, RuntimeStatsIntervalId, IntervalStartTime, IntervalEndTime,
      IntervalDurationMinutes, CapturedDate AS IntervalDate,
      CAST(hour(IntervalStartTime) AS VARCHAR) || ':' ||
        lpad(CAST(minute(IntervalStartTime) AS VARCHAR), 2, '0') AS IntervalTimeOfDay,
      dayname(IntervalStartTime) AS IntervalDayOfWeek, LoadDate FROM intervals""",
    ["intervals"],
)
CHECKS["v3_dim_interval_hourly"] = Check(
    lambda f: views.dim_interval(hourly_intervals(f.read_source)),
    """SELECT r_name AS TenantName, n_name AS ServerName,
      CAST(epoch(h) // 3600 AS INTEGER) AS RuntimeStatsIntervalId, h AS IntervalStartTime,
      h + INTERVAL 1 HOUR AS IntervalEndTime, 60 AS IntervalDurationMinutes,
      CAST(h AS DATE) AS IntervalDate, hour(h)::VARCHAR || ':00' AS IntervalTimeOfDay,
      dayname(h) AS IntervalDayOfWeek, h + INTERVAL 1 HOUR AS LoadDate
    FROM (SELECT DISTINCT user_id % 25 AS k, date_trunc('hour', ts) AS h FROM events)
      JOIN nation ON k = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
CHECKS["v4_dim_wait_category"] = Check(
    lambda f: views.dim_wait_category(f.table(S.WAIT)),
    "SELECT DISTINCT WaitCategoryId, WaitCategory, WaitCategoryGroup FROM fw", ["fw"],
)
CHECKS["v5_wait_group_rule"] = Check(
    lambda f: f.table(S.WAIT).groupBy(
        wait_category_group(F.col("WaitCategory")).alias("WaitCategoryGroup")
    ).agg(F.count(F.lit(1)).alias("n")),
    f"SELECT {wait_group('WaitCategory')} AS WaitCategoryGroup, count(*) AS n FROM waits GROUP BY 1",
    ["waits"],
)
CHECKS["v6_fact_runtime_stats"] = Check(
    lambda f: views.fact_runtime_stats(f.table(S.RUNTIME)),
    f"""SELECT RuntimeStatsId, QueryDimKey, PlanDimKey, RuntimeStatsIntervalId, {QK}, PlanId,
      ExecutionType, ExecutionTypeDesc, CountExecutions, AvgDurationMs, AvgDurationSeconds,
      MaxDurationMs, MinDurationMs, ifnull(StdevDurationMs, 0.0::DOUBLE) AS StdevDurationMs,
      AvgLogicalIoReads, MaxLogicalIoReads, AvgLogicalIoWrites, MaxLogicalIoWrites,
      AvgPhysicalIoReads, MaxPhysicalIoReads, AvgCpuTimeMs, AvgCpuTimeSeconds, MaxCpuTimeMs,
      AvgClrTimeMs, MaxClrTimeMs, AvgElapsedTimeMs, MaxElapsedTimeMs, AvgMemoryUsedMb,
      MaxMemoryUsedMb, AvgRowCount, MaxRowCount, MinRowCount,
      AvgCpuTimeMs / nullif(AvgDurationMs, 0) * 100.0::DOUBLE AS CpuPercentageOfDuration,
      IsRegression, if(IsRegression, 'Regression Detected', 'Normal') AS PerformanceStatus,
      LoadDate FROM fr""",
    ["fr"], each("StdevDurationMs CpuPercentageOfDuration", 4),
)
CHECKS["v7_fact_wait_stats"] = Check(
    lambda f: views.fact_wait_stats(f.table(S.WAIT)),
    f"""SELECT WaitStatsId, QueryDimKey, RuntimeStatsIntervalId, {QK}, PlanId, WaitCategory,
      WaitCategoryId, WaitCategoryGroup, TotalWaitTimeMs, TotalWaitTimeMinutes, AvgWaitTimeMs,
      MaxWaitTimeMs, CountWaits, QueryWaitTimeCategory, LoadDate FROM fw""",
    ["fw"],
)
TOP_QUERIES = f"""SELECT rt.TenantName, rt.ServerName, rt.DatabaseName, rt.QueryId, QueryText,
      CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions,
      avg(AvgDurationMs) AS AvgDurationMs, max(MaxDurationMs) AS MaxDurationMs,
      sum(CountExecutions * AvgDurationMs) / 1000.0::DOUBLE AS TotalDurationSeconds,
      avg(AvgCpuTimeMs) AS AvgCpuTimeMs,
      CAST(sum(AvgLogicalIoReads) AS BIGINT) AS AvgLogicalIoReads,
      CAST(sum(AvgLogicalIoReads) AS BIGINT) AS TotalLogicalIoReads,
      avg(AvgMemoryUsedMb) AS AvgMemoryUsedMb,
      count(DISTINCT RuntimeStatsIntervalId) AS IntervalsObserved
    FROM rt LEFT JOIN dq ON rt.TenantName = dq.TenantName AND rt.ServerName = dq.ServerName
      AND rt.DatabaseName = dq.DatabaseName AND rt.QueryId = dq.QueryId
    GROUP BY ALL ORDER BY TotalDurationSeconds DESC, 1, 2, 3, 4 LIMIT 1000"""
CHECKS["v8_fact_top_queries"] = Check(
    lambda f: views.fact_top_queries(f.table(S.RUNTIME), f.table(S.QUERY), f.table(S.QUERY_TEXT)),
    TOP_QUERIES, ["rt", "dq"],
    {**each("AvgDurationMs AvgCpuTimeMs AvgMemoryUsedMb", 4), "TotalDurationSeconds": 3},
)
CHECKS["v9_fact_wait_summary"] = Check(
    lambda f: views.fact_wait_summary(f.table(S.WAIT)),
    f"""SELECT {K}, WaitCategory, WaitCategoryGroup,
      CAST(sum(TotalWaitTimeMs) AS BIGINT) AS TotalWaitTimeMs,
      CAST(sum(TotalWaitTimeMs) AS DOUBLE) / 1000.0::DOUBLE / 60.0::DOUBLE AS TotalWaitTimeMinutes,
      CAST(sum(CountWaits) AS BIGINT) AS TotalWaits, avg(AvgWaitTimeMs) AS AvgWaitTimeMs,
      max(MaxWaitTimeMs) AS MaxWaitTimeMs FROM fw GROUP BY {K}, WaitCategory, WaitCategoryGroup""",
    ["fw"], each("AvgWaitTimeMs", 4),
)

# --- filters --------------------------------------------------------------------

_SUMMARY = "count(*) AS n, CAST(sum(CountExecutions) AS BIGINT) AS executions"


def _summary(df):
    return df.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("CountExecutions").alias("executions")
    )


CHECKS["f1_source_slice"] = Check(
    lambda f: _summary(FI.slice_source(f.table(S.RUNTIME), "ASIA", "NATION_2", "DB_O")),
    f"""SELECT {K}, {_SUMMARY} FROM rt WHERE TenantName = 'ASIA' AND ServerName = 'NATION_2'
      AND DatabaseName = 'DB_O' GROUP BY {K}""", ["rt"],
)
CHECKS["f2_optional_scope"] = Check(
    lambda f: _summary(FI.optional_scope(f.table(S.RUNTIME), tenant="ASIA")).unionByName(
        _summary(FI.optional_scope(f.table(S.RUNTIME)))
    ),
    f"""SELECT {K}, {_SUMMARY} FROM rt WHERE TenantName = 'ASIA' GROUP BY {K}
      UNION ALL SELECT {K}, {_SUMMARY} FROM rt GROUP BY {K}""", ["rt"],
)
CHECKS["f3_relative_windows"] = Check(
    lambda f: _summary(FI.since_days(f.table(S.RUNTIME), "LoadDate", AS_OF, 7)).withColumn(
        "w", F.lit("7d")
    ).unionByName(
        _summary(FI.since_exact(f.table(S.RUNTIME), "LoadDate", AS_OF, 72, "hour")).withColumn(
            "w", F.lit("72h")
        )
    ),
    f"""SELECT {K}, {_SUMMARY}, '7d' AS w FROM rt
      WHERE LoadDate >= date_trunc('day', {NOW}) - INTERVAL 7 DAY GROUP BY {K}
      UNION ALL SELECT {K}, {_SUMMARY}, '72h' FROM rt
      WHERE LoadDate >= {NOW} - INTERVAL 72 HOUR GROUP BY {K}""", ["rt"],
)
CHECKS["f4_tenant_scope"] = Check(
    lambda f: _summary(FI.tenant_scope(f.table(S.RUNTIME), "EUROPE")),
    f"SELECT {K}, {_SUMMARY} FROM rt WHERE TenantName = 'EUROPE' GROUP BY {K}", ["rt"],
)
CHECKS["f5_report_slicers"] = Check(
    lambda f: _summary(FI.slice_facts(
        f.table(S.RUNTIME), views.dim_interval(f.table(S.INTERVAL)),
        views.dim_query(f.table(S.QUERY), f.table(S.QUERY_TEXT)),
        date_from="1997-01-01", date_to="2000-12-31", tenants=["ASIA", "AFRICA"],
        databases=["DB_F"], text_contains="Red",
    )),
    f"""SELECT {K}, {_SUMMARY} FROM frd
      WHERE IntervalDate BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'
        AND TenantName IN ('ASIA', 'AFRICA') AND DatabaseName = 'DB_F'
        AND EXISTS (SELECT 1 FROM dq WHERE dq.TenantName = frd.TenantName
          AND dq.ServerName = frd.ServerName AND dq.DatabaseName = frd.DatabaseName
          AND dq.QueryId = frd.QueryId AND lower(dq.QueryText) LIKE '%red%')
      GROUP BY {K}""", ["frd", "dq"],
)
CHECKS["f5_default_period"] = Check(
    lambda f: _summary(FI.slice_facts(
        f.since("1998-07-15 10:00:00", 30).runtime, views.dim_interval(f.table(S.INTERVAL)),
        as_of="1998-07-15 10:00:00")),
    f"SELECT {K}, {_SUMMARY} FROM frd WHERE IntervalDate >= DATE '1998-06-15' GROUP BY {K}", ["frd"],
)

# --- joins ----------------------------------------------------------------------

CHECKS["j1_query_left_text"] = Check(
    lambda f: views.dim_query(f.table(S.QUERY), f.table(S.QUERY_TEXT)).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("queries"), F.count("QueryText").alias("texts")
    ),
    f"SELECT {K}, count(*) AS queries, count(QueryText) AS texts FROM dq GROUP BY {K}", ["dq"],
)


def _by_type(f, how):
    per_query = f.table(S.RUNTIME).groupBy(*QUERY_KEY).agg(F.count(F.lit(1)).alias("n"))
    dim = views.dim_query(f.table(S.QUERY), f.table(S.QUERY_TEXT)).select(*QUERY_KEY, "QueryType")
    return per_query.join(dim, QUERY_KEY, how).groupBy("TenantName", "QueryType").agg(
        F.sum("n").alias("n")
    )


def _by_type_sql(how):
    return f"""SELECT TenantName, QueryType, count(*) AS n FROM rt {how} JOIN
      (SELECT {QK}, CASE WHEN ObjectId > 0 THEN 'Stored Procedure'
        WHEN ObjectId = 0 THEN 'Ad-hoc Query' ELSE 'Unknown' END AS QueryType FROM dq)
      USING ({QK}) GROUP BY TenantName, QueryType"""


CHECKS["j2_fact_left_query"] = Check(lambda f: _by_type(f, "left"), _by_type_sql("LEFT"), ["rt", "dq"])
CHECKS["j3_fact_inner_query"] = Check(lambda f: _by_type(f, "inner"), _by_type_sql(""), ["rt", "dq"])
CHECKS["j4_plan_pairs"] = Check(
    lambda f: regression.plan_pair_averages(f.table(S.RUNTIME), threshold=-1.0),
    "SELECT * FROM pairs", ["pairs"], each("OldAvgDurationMs NewAvgDurationMs", 4),
)
CHECKS["j5_not_yet_detected"] = Check(
    lambda f: regression.detect_plan_regressions(
        f.table(S.RUNTIME), f.table(S.REGRESSION), "2001-10-20 12:00:00"
    ).select(*QUERY_KEY, "OldPlanId", "NewPlanId"),
    f"""SELECT {QK}, OldPlanId, NewPlanId FROM found f WHERE NOT EXISTS (SELECT 1 FROM regs p
      WHERE p.TenantName = f.TenantName AND p.ServerName = f.ServerName
        AND p.DatabaseName = f.DatabaseName AND p.QueryId = f.QueryId
        AND p.OldPlanId = f.OldPlanId AND p.NewPlanId = f.NewPlanId
        AND date_diff('day', p.DetectionDate, TIMESTAMP '2001-10-20 12:00:00') < 1)""",
    ["regs"],
)
CHECKS["j6_detected_today_rows"] = Check(
    lambda f: f.table(S.RUNTIME).join(
        regression.detected_today(f.table(S.REGRESSION), AS_OF).select(
            *QUERY_KEY, F.col("NewPlanId").alias("PlanId")), [*QUERY_KEY, "PlanId"], "left_semi",
    ).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")),
    f"""SELECT {K}, count(*) AS n FROM rt WHERE EXISTS (SELECT 1 FROM regs p
      WHERE p.TenantName = rt.TenantName AND p.ServerName = rt.ServerName
        AND p.DatabaseName = rt.DatabaseName AND p.QueryId = rt.QueryId AND p.NewPlanId = rt.PlanId
        AND date_diff('day', p.DetectionDate, {NOW}) < 1) GROUP BY {K}""", ["rt", "regs"],
)


def _split(f):
    rt = f.table(S.RUNTIME)
    target = rt.filter(F.col("RuntimeStatsIntervalId") < 8000)
    staged = rt.filter(F.col("RuntimeStatsIntervalId") >= 7998).withColumn(
        "CountExecutions", F.col("CountExecutions") + 1
    )
    return target, staged


def _merge_actions(f, action):
    merged = upsert.upsert(*_split(f), S.RUNTIME, AS_OF, with_action=True)
    return merged.filter(F.col(upsert.ACTION) == action).groupBy(
        *KEYS, "RuntimeStatsIntervalId"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("CountExecutions").alias("executions"))


_ACTION_SQL = f"""SELECT {K}, RuntimeStatsIntervalId, count(*) AS n,
      CAST(sum(CountExecutions + 1) AS BIGINT) AS executions FROM rt WHERE RuntimeStatsIntervalId """
CHECKS["j7_upsert_inserts"] = Check(
    lambda f: _merge_actions(f, "INSERT"), _ACTION_SQL + f">= 8000 GROUP BY {K}, RuntimeStatsIntervalId",
    ["rt"],
)
CHECKS["j8_upsert_updates"] = Check(
    lambda f: _merge_actions(f, "UPDATE"),
    _ACTION_SQL + f"BETWEEN 7998 AND 7999 GROUP BY {K}, RuntimeStatsIntervalId", ["rt"],
)
CHECKS["j9_expired_fact_rows"] = Check(
    lambda f: f.table(S.RUNTIME).join(
        retention.expired_intervals(f.table(S.INTERVAL), AS_OF, 400), S.INTERVAL_KEY
    ).groupBy("TenantName", "ServerName").agg(F.count(F.lit(1)).alias("n")),
    f"""SELECT TenantName, ServerName, count(*) AS n
      FROM rt JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)
      WHERE IntervalStartTime < date_trunc('day', {NOW}) - INTERVAL 400 DAY GROUP BY 1, 2""",
    ["rt", "intervals"],
)
CHECKS["j10_scoped_survivors"] = Check(
    lambda f: _summary(retention.cleanup(f.telemetry, AS_OF, 400, tenant="ASIA").runtime),
    f"""SELECT {K}, {_SUMMARY} FROM rt WHERE NOT (TenantName = 'ASIA' AND
      (TenantName, ServerName, RuntimeStatsIntervalId) IN (
        SELECT (TenantName, ServerName, RuntimeStatsIntervalId) FROM intervals
        WHERE IntervalStartTime < date_trunc('day', {NOW}) - INTERVAL 400 DAY)) GROUP BY {K}""",
    ["rt", "intervals"],
)
CHECKS["j11_orphaned_plans"] = Check(
    lambda f: retention.orphaned_plans(f.table(S.PLAN), f.table(S.RUNTIME)).select(*PLAN_KEY, "QueryId"),
    f"SELECT {K}, PlanId, QueryId FROM plans ANTI JOIN rt USING ({K}, PlanId)", ["plans"],
)
CHECKS["j12_stale_plans"] = Check(
    lambda f: retention.stale_plans(f.table(S.PLAN), f.table(S.RUNTIME), AS_OF, 400).select(
        *PLAN_KEY, "LastUsed"),
    f"""SELECT {K}, PlanId, max(rt.LoadDate) AS LastUsed FROM plans LEFT JOIN rt USING ({K}, PlanId)
      GROUP BY {K}, PlanId
      HAVING max(rt.LoadDate) < date_trunc('day', {NOW}) - INTERVAL 400 DAY""", ["plans"],
)
CHECKS["j14_orphan_rows"] = Check(
    lambda f: quality.orphan_counts(f.telemetry),
    f"""SELECT 'Orphaned Runtime Stats' AS IssueType, count(*) AS Count FROM rt ANTI JOIN dq USING ({QK})
      UNION ALL SELECT 'Orphaned Wait Stats', count(*) FROM waits ANTI JOIN dq USING ({QK})
      UNION ALL SELECT 'Missing Query Text', count(*) FROM dq ANTI JOIN texts USING ({K}, QueryTextId)""",
    ["rt", "waits", "dq"],
)


def _star_counts(f):
    joined = views.star(f.table(S.RUNTIME), f.telemetry)
    return joined.groupBy("TenantName", "IntervalDate", "QueryType", "PlanStorage").agg(
        F.count(F.lit(1)).alias("n"), F.count("QueryText").alias("with_text")
    )


CHECKS["j17_star"] = Check(
    _star_counts,
    f"""SELECT TenantName, CapturedDate AS IntervalDate,
      CASE WHEN q.QueryId IS NULL THEN NULL WHEN ObjectId > 0 THEN 'Stored Procedure'
        WHEN ObjectId = 0 THEN 'Ad-hoc Query' ELSE 'Unknown' END AS QueryType,
      CASE WHEN QueryPlanCompressed IS NOT NULL THEN 'Compressed'
        WHEN QueryPlanText IS NOT NULL THEN 'XML' ELSE 'Unknown' END AS PlanStorage,
      count(*) AS n, count(QueryText) AS with_text
    FROM rt LEFT JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)
      LEFT JOIN dq q USING ({QK}) LEFT JOIN plans p USING ({K}, PlanId)
    GROUP BY 1, 2, 3, 4""", ["rt", "intervals", "dq", "plans"],
)


def _wait_star(f):
    waits = views.with_interval_date(f.table(S.WAIT), f.table(S.INTERVAL))
    category = views.dim_wait_category(f.table(S.WAIT))
    return waits.join(category, ["WaitCategoryId", "WaitCategory"]).groupBy(
        "TenantName", "IntervalDate", "WaitCategoryGroup"
    ).agg(F.sum("TotalWaitTimeMs").alias("TotalWaitTimeMs"))


CHECKS["j17_wait_star"] = Check(
    _wait_star,
    """SELECT TenantName, CapturedDate AS IntervalDate, WaitCategoryGroup,
      CAST(sum(TotalWaitTimeMs) AS BIGINT) AS TotalWaitTimeMs
    FROM fw LEFT JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)
    GROUP BY 1, 2, 3""", ["fw", "intervals"],
)

# --- aggregates, distincts, set operations, functions ---------------------------

CHECKS["a3_having_weighted"] = Check(
    lambda f: f.table(S.RUNTIME).groupBy(*KEYS, "QueryId").agg(
        F.sum(F.col("CountExecutions") * F.col("AvgCpuTimeMs")).alias("cpu"),
        F.avg("AvgMemoryUsedMb").alias("memory"),
        F.count_distinct("PlanId").alias("plans"),
    ).filter((F.col("cpu") > 1_000_000) & (F.col("memory") > 100) & (F.col("plans") > 2)),
    f"""SELECT {QK}, sum(CountExecutions * AvgCpuTimeMs) AS cpu, avg(AvgMemoryUsedMb) AS memory,
      count(DISTINCT PlanId) AS plans FROM rt GROUP BY {QK}
      HAVING cpu > 1000000 AND memory > 100 AND plans > 2""",
    ["rt"], {"cpu": 2, "memory": 4},
)
CHECKS["a5_multi_distinct"] = Check(
    lambda f: reports.tenant_performance(f.telemetry, AS_OF, days=4000).select(
        "TenantName", "ServerCount", "DatabaseCount", "UniqueQueryCount"),
    """SELECT TenantName, count(DISTINCT ServerName) AS ServerCount,
      count(DISTINCT DatabaseName) AS DatabaseCount, count(DISTINCT QueryId) AS UniqueQueryCount
      FROM rt GROUP BY TenantName""", ["rt"],
)
CHECKS["a7_scalar_aggregates"] = Check(
    lambda f: f.table(S.RUNTIME).filter(
        F.col("RuntimeStatsIntervalId") >= f.table(S.INTERVAL).agg(
            F.max("RuntimeStatsIntervalId") - 10).scalar()
    ).groupBy("TenantName").agg(F.count(F.lit(1)).alias("n")),
    """SELECT TenantName, count(*) AS n FROM rt WHERE RuntimeStatsIntervalId >=
      (SELECT max(RuntimeStatsIntervalId) - 10 FROM intervals) GROUP BY TenantName""",
    ["rt", "intervals"],
)
CHECKS["a8_distinct_plans"] = Check(
    lambda f: f.table(S.RUNTIME).select(*PLAN_KEY).distinct().groupBy("TenantName").agg(
        F.count(F.lit(1)).alias("plans")),
    f"""SELECT TenantName, count(*) AS plans FROM (SELECT DISTINCT {K}, PlanId FROM rt)
      GROUP BY TenantName""", ["rt"],
)
CHECKS["t2_ordered_report"] = Check(
    lambda f: f.table(S.RUNTIME).groupBy(*KEYS).agg(
        F.max("LoadDate").alias("LastLoadTime"), F.max("MaxDurationMs").alias("MaxDurationMs")
    ).orderBy(F.desc("LastLoadTime"), *KEYS),
    f"""SELECT {K}, max(LoadDate) AS LastLoadTime, max(MaxDurationMs) AS MaxDurationMs
      FROM rt GROUP BY {K} ORDER BY LastLoadTime DESC, {K}""", ["rt"],
)
CHECKS["c1_boundary_differences"] = Check(
    lambda f: f.read_source("events").select(
        "event_id",
        *[
            boundary_diff(unit, F.col("ts").cast("timestamp"),
                          F.lit("2024-02-01 00:30:00").cast("timestamp")).alias(f"{unit}s")
            for unit in ("minute", "hour", "day")
        ],
    ),
    """SELECT event_id,
      CAST(date_diff('minute', ts, TIMESTAMP '2024-02-01 00:30:00') AS INTEGER) AS minutes,
      CAST(date_diff('hour', ts, TIMESTAMP '2024-02-01 00:30:00') AS INTEGER) AS hours,
      CAST(date_diff('day', ts, TIMESTAMP '2024-02-01 00:30:00') AS INTEGER) AS days FROM events""",
)
CHECKS["c2_hex_hashes"] = Check(
    lambda f: f.table(S.PLAN).select(*PLAN_KEY, F.hex("QueryPlanHash").alias("h")),
    f"SELECT {K}, PlanId, {hex_id('PlanId')} AS h FROM plans", ["plans"],
)
