"""Checks of the operational reports.

Windows are widened where the default would leave nothing to compare.
"""

from pyspark.sql import functions as F

from checks.base import K, NOW, QK, Check, each
from checks.views import TOP_QUERIES
from plandrift import schemas as S
from plandrift.functions.filters import slice_source
from plandrift.plans import reports as R
from plandrift.schemas import KEYS
from plandrift.sources.fixture import AS_OF

CHECKS: dict[str, Check] = {}

HOUR = "3600000.0::DOUBLE"
NAMED = f"rt JOIN (SELECT {QK}, QueryText FROM dq) USING ({QK})"
NAMED_WAITS = f"fw JOIN (SELECT {QK}, QueryText FROM dq) USING ({QK})"
TODAY = f"date_trunc('day', {NOW})"
def money(column):
    """Half-up rounding of the decimal digits; a direct cast rounds the binary value."""
    return f"CAST(CAST(round({column}, 9) AS VARCHAR) AS DECIMAL(10,2))"


ORDER_KEY = "TenantName, ServerName, QueryId, QueryText NULLS FIRST"

CHECKS["r1_latest_loads"] = Check(
    lambda f: R.latest_loads(f.telemetry),
    f"""SELECT {K}, LastExtractTime, ExtractDurationSeconds, RecordsInserted, ExtractStatus
      FROM log ORDER BY LastExtractTime DESC, {K}, ETLControlId LIMIT 10""", ["log"],
)
CHECKS["r2_data_freshness"] = Check(
    lambda f: R.data_freshness(f.telemetry, AS_OF),
    f"""SELECT {K}, max(LoadDate) AS LastLoadTime, count(*) AS RecordCount,
      CAST(date_diff('hour', max(LoadDate), {NOW}) AS INTEGER) AS HoursSinceLoad
      FROM rt GROUP BY {K}""", ["rt"],
)
CHECKS["r3_row_counts"] = Check(
    lambda f: R.table_row_counts(f.telemetry),
    " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, count(*) AS RowCount FROM {cte}"
        for name, cte in (
            ("QueryStoreQuery", "queries"), ("QueryStoreQueryText", "texts"),
            ("QueryStorePlan", "plans"), ("QueryStoreRuntimeStats", "rt"),
            ("QueryStoreWaitStats", "waits"), ("RuntimeStatsInterval", "intervals"),
            ("PlanRegressions", "regs"),
        )
    ),
    ["queries", "texts", "plans", "waits", "intervals", "regs"],
)


def _slowest(n):
    return f"""SELECT {QK}, substring(QueryText, 1, 100) AS QueryPreview,
      avg(AvgDurationMs) AS AvgDurationMs, max(MaxDurationMs) AS MaxDurationMs,
      CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions,
      avg(AvgCpuTimeMs) AS AvgCpuTimeMs, avg(AvgMemoryUsedMb) AS AvgMemoryMB
    FROM {NAMED} WHERE LoadDate >= {TODAY} - INTERVAL 7 DAY
    GROUP BY {QK}, QueryText ORDER BY AvgDurationMs DESC, {QK} LIMIT {n}"""


_SLOW_DIGITS = each("AvgDurationMs AvgCpuTimeMs AvgMemoryMB", 4)
CHECKS["r4_slowest_queries"] = Check(
    lambda f: R.slowest_queries(f.telemetry, AS_OF), _slowest(20), ["rt", "dq"], _SLOW_DIGITS)
CHECKS["r5_cpu_consumers"] = Check(
    lambda f: R.cpu_consumers(f.telemetry),
    f"""SELECT TenantName, ServerName, QueryId, substring(QueryText, 1, 80) AS QueryPreview,
      sum(CountExecutions * AvgCpuTimeMs) / {HOUR} AS TotalCpuHours,
      avg(AvgCpuTimeMs) AS AvgCpuTimeMs, CAST(sum(CountExecutions) AS BIGINT) AS ExecutionCount
    FROM {NAMED} GROUP BY TenantName, ServerName, QueryId, QueryText
    HAVING sum(CountExecutions * AvgCpuTimeMs) > 1000000
    ORDER BY TotalCpuHours DESC, {ORDER_KEY} LIMIT 20""",
    ["rt", "dq"], {"TotalCpuHours": 6, "AvgCpuTimeMs": 4},
)
CHECKS["r5_cpu_consumers_all"] = Check(
    lambda f: R.cpu_consumers(f.telemetry, n=1_000_000),
    f"""SELECT TenantName, ServerName, QueryId, substring(QueryText, 1, 80) AS QueryPreview,
      sum(CountExecutions * AvgCpuTimeMs) / {HOUR} AS TotalCpuHours,
      avg(AvgCpuTimeMs) AS AvgCpuTimeMs, CAST(sum(CountExecutions) AS BIGINT) AS ExecutionCount
    FROM {NAMED} GROUP BY TenantName, ServerName, QueryId, QueryText
    HAVING sum(CountExecutions * AvgCpuTimeMs) > 1000000""",
    ["rt", "dq"], {"TotalCpuHours": 6, "AvgCpuTimeMs": 4},
)
_HOGS = f"""SELECT TenantName, ServerName, QueryId, substring(QueryText, 1, 80) AS QueryPreview,
      avg(AvgMemoryUsedMb) AS AvgMemoryMB, max(MaxMemoryUsedMb) AS MaxMemoryMB,
      CAST(sum(CountExecutions) AS BIGINT) AS ExecutionCount
    FROM {NAMED} GROUP BY TenantName, ServerName, QueryId, QueryText
    HAVING avg(AvgMemoryUsedMb) > 100 ORDER BY AvgMemoryMB DESC, {ORDER_KEY} LIMIT 20"""
CHECKS["r6_memory_hogs"] = Check(
    lambda f: R.memory_hogs(f.telemetry), _HOGS, ["rt", "dq"], {"AvgMemoryMB": 4})
_RECENT = f"""SELECT {QK}, OldPlanId, NewPlanId, QueryText AS QueryTextContent, DetectionDate,
      OldAvgDurationMs, NewAvgDurationMs, DurationChangePercentage, IsInvestigated, Notes
    FROM regs LEFT JOIN (SELECT {QK}, QueryText FROM dq) USING ({QK})
    WHERE DetectionDate >= {NOW} - INTERVAL 24 HOUR AND DurationChangePercentage > 25
    ORDER BY DetectionDate DESC, {QK}, OldPlanId, NewPlanId LIMIT 50"""
_CHANGE_DIGITS = each("OldAvgDurationMs NewAvgDurationMs DurationChangePercentage", 4)
CHECKS["r7_recent_regressions"] = Check(
    lambda f: R.recent_regressions(f.telemetry, AS_OF), _RECENT, ["regs", "dq"], _CHANGE_DIGITS)
CHECKS["r8_top_regressions"] = Check(
    lambda f: R.top_regressions(f.telemetry, AS_OF),
    f"""SELECT TenantName, ServerName, QueryId, IsInvestigated, count(*) AS RegressionCount,
      avg(DurationChangePercentage) AS AvgDurationChangePercentage,
      max(NewAvgDurationMs) AS MaxNewDurationMs
    FROM regs WHERE DetectionDate >= {NOW} - INTERVAL 30 DAY
    GROUP BY TenantName, ServerName, QueryId, IsInvestigated
    HAVING avg(DurationChangePercentage) > 25
    ORDER BY AvgDurationChangePercentage DESC, TenantName, ServerName, QueryId, IsInvestigated LIMIT 20""",
    ["regs"], each("AvgDurationChangePercentage MaxNewDurationMs", 4),
)
CHECKS["r9_waits_by_group"] = Check(
    lambda f: R.waits_by_group(f.telemetry, AS_OF),
    f"""SELECT TenantName, ServerName, WaitCategoryGroup,
      sum(TotalWaitTimeMinutes) AS TotalWaitMinutes,
      sum(TotalWaitTimeMinutes) / 60.0::DOUBLE AS TotalWaitHours,
      CAST(sum(CountWaits) AS BIGINT) AS TotalWaits, avg(AvgWaitTimeMs) AS AvgWaitTimeMs
    FROM fw WHERE LoadDate >= {TODAY} - INTERVAL 7 DAY
    GROUP BY TenantName, ServerName, WaitCategoryGroup""",
    ["fw"], {"TotalWaitMinutes": 5, "TotalWaitHours": 6, "AvgWaitTimeMs": 4},
)
CHECKS["r10_waiting_queries"] = Check(
    lambda f: R.waiting_queries(f.telemetry, AS_OF, days=60),
    f"""SELECT TenantName, ServerName, QueryId, substring(QueryText, 1, 80) AS QueryPreview,
      WaitCategoryGroup, sum(TotalWaitTimeMinutes) AS TotalWaitMinutes,
      CAST(sum(CountWaits) AS BIGINT) AS WaitCount, avg(AvgWaitTimeMs) AS AvgWaitTimeMs
    FROM {NAMED_WAITS} WHERE LoadDate >= {TODAY} - INTERVAL 60 DAY
    GROUP BY TenantName, ServerName, QueryId, QueryText, WaitCategoryGroup
    ORDER BY TotalWaitMinutes DESC, {ORDER_KEY}, WaitCategoryGroup LIMIT 50""",
    ["fw", "dq"], {"TotalWaitMinutes": 5, "AvgWaitTimeMs": 4},
)
CHECKS["r11_memory_pressure"] = Check(
    lambda f: R.memory_pressure(f.telemetry, AS_OF, days=1000, min_minutes=1),
    f"""SELECT TenantName, ServerName, sum(TotalWaitTimeMinutes) AS MemoryWaitMinutes,
      count(DISTINCT QueryId) AS AffectedQueries,
      sum(TotalWaitTimeMinutes) / 60.0::DOUBLE AS MemoryWaitHours
    FROM fw WHERE WaitCategoryGroup = 'Memory Pressure' AND LoadDate >= {TODAY} - INTERVAL 1000 DAY
    GROUP BY TenantName, ServerName HAVING sum(TotalWaitTimeMinutes) > 1""",
    ["fw"], {"MemoryWaitMinutes": 5, "MemoryWaitHours": 6},
)


def _unstable(limit):
    return f"""SELECT TenantName, ServerName, QueryId, substring(QueryText, 1, 80) AS QueryPreview,
      count(DISTINCT PlanId) AS PlanCount, min(CreationTime) AS FirstPlanDate,
      max(CreationTime) AS LatestPlanDate, count(DISTINCT RuntimeStatsIntervalId) AS IntervalCount
    FROM {NAMED} JOIN (SELECT {K}, PlanId, CreationTime FROM plans) USING ({K}, PlanId)
    GROUP BY TenantName, ServerName, QueryId, QueryText HAVING count(DISTINCT PlanId) > 2
    ORDER BY PlanCount DESC, {ORDER_KEY} {limit}"""


CHECKS["r12_plan_instability"] = Check(
    lambda f: R.plan_instability(f.telemetry), _unstable("LIMIT 50"), ["rt", "dq", "plans"])
CHECKS["r12_plan_instability_all"] = Check(
    lambda f: R.plan_instability(f.telemetry, n=1_000_000), _unstable(""), ["rt", "dq", "plans"])
CHECKS["r13_plan_comparison"] = Check(
    lambda f: R.plan_comparison(f.telemetry, 12, "EUROPE", "NATION_8"),
    f"""SELECT PlanId, CreationTime, LastExecutionTime, count(RuntimeStatsId) AS ExecutionIntervals,
      avg(AvgDurationMs) AS AvgDurationMs, max(MaxDurationMs) AS MaxDurationMs,
      CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions, avg(AvgCpuTimeMs) AS AvgCpuTimeMs
    FROM plans LEFT JOIN (SELECT * EXCLUDE (LoadDate, QueryId) FROM rt) USING ({K}, PlanId)
    WHERE QueryId = 12 AND TenantName = 'EUROPE' AND ServerName = 'NATION_8'
    GROUP BY PlanId, CreationTime, LastExecutionTime""",
    ["rt", "plans"], each("AvgDurationMs AvgCpuTimeMs", 4),
)
_TENANTS = f"""SELECT TenantName, count(DISTINCT ServerName) AS ServerCount,
      count(DISTINCT DatabaseName) AS DatabaseCount, count(DISTINCT QueryId) AS UniqueQueryCount,
      avg(AvgDurationMs) AS AvgDurationMs, CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions,
      sum(CountExecutions * AvgCpuTimeMs) / {HOUR} AS TotalCpuHours,
      avg(AvgMemoryUsedMb) AS AvgMemoryMB FROM rt"""
_TENANT_DIGITS = {"AvgDurationMs": 4, "TotalCpuHours": 5, "AvgMemoryMB": 4}
CHECKS["r14_tenant_performance"] = Check(
    lambda f: R.tenant_performance(f.telemetry, AS_OF),
    f"{_TENANTS} WHERE LoadDate >= {TODAY} - INTERVAL 7 DAY GROUP BY TenantName",
    ["rt"], _TENANT_DIGITS,
)
CHECKS["r14_tenant_performance_all_time"] = Check(
    lambda f: R.tenant_performance(f.telemetry, AS_OF, days=4000),
    f"{_TENANTS} GROUP BY TenantName", ["rt"], _TENANT_DIGITS,
)
CHECKS["r15_server_comparison"] = Check(
    lambda f: R.server_comparison(f.telemetry, AS_OF, days=1000),
    f"""SELECT ServerName, count(DISTINCT TenantName) AS TenantCount,
      count(DISTINCT DatabaseName) AS DatabaseCount, count(DISTINCT QueryId) AS UniqueQueryCount,
      avg(AvgDurationMs) AS AvgDurationMs, CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions,
      count(DISTINCT CASE WHEN IsRegression THEN QueryId END) AS RegressionQueryCount
    FROM rt WHERE LoadDate >= {TODAY} - INTERVAL 1000 DAY GROUP BY ServerName""",
    ["rt"], {"AvgDurationMs": 4},
)
CHECKS["r16_data_quality"] = Check(
    lambda f: R.data_quality(f.telemetry),
    f"""SELECT 'Orphaned Runtime Stats' AS IssueType, count(*) AS Count FROM rt ANTI JOIN dq USING ({QK})
      UNION ALL SELECT 'Orphaned Wait Stats', count(*) FROM waits ANTI JOIN dq USING ({QK})
      UNION ALL SELECT 'Missing Query Text', count(*) FROM dq WHERE QueryText IS NULL""",
    ["rt", "waits", "dq"],
)
CHECKS["r17_critical_nulls"] = Check(
    lambda f: R.critical_nulls(f.telemetry),
    " UNION ALL ".join(
        f"SELECT 'DimQuery' AS TableName, '{c}' AS ColumnName, count(*) FILTER (WHERE {c} IS NULL) AS NullCount FROM dq"
        for c in ("QueryTextId", "ObjectId", "QueryText")
    ), ["dq"],
)
CHECKS["r18_top_query_export"] = Check(
    lambda f: R.top_query_export(f.telemetry),
    f"""SELECT {QK}, QueryText, {money('AvgDurationMs')} AS AvgDurationMs,
      {money('MaxDurationMs')} AS MaxDurationMs, TotalExecutions,
      {money('AvgCpuTimeMs')} AS AvgCpuTimeMs,
      {money('AvgMemoryUsedMb')} AS AvgMemoryMB FROM ({TOP_QUERIES})""",
    ["rt", "dq"],
)
CHECKS["r19_regression_export"] = Check(
    lambda f: R.regression_export(f.telemetry, AS_OF),
    f"""SELECT CAST(DetectionDate AS DATE) AS Date, {QK},
      {money('OldAvgDurationMs')} AS OldDurationMs,
      {money('NewAvgDurationMs')} AS NewDurationMs,
      {money('DurationChangePercentage')} AS PercentChange,
      if(IsInvestigated, 'Yes', 'No') AS Investigated
    FROM regs WHERE CAST(DetectionDate AS DATE) >= {TODAY} - INTERVAL 30 DAY""", ["regs"],
)
CHECKS["r20_load_health"] = Check(
    lambda f: R.load_health(f.telemetry, AS_OF),
    f"""SELECT {K}, count(*) AS LoadCount, max(LastExtractTime) AS LatestLoad,
      CASE WHEN max(LastExtractTime) >= {NOW} - INTERVAL 4 HOUR THEN 'HEALTHY'
        WHEN max(LastExtractTime) >= {NOW} - INTERVAL 24 HOUR THEN 'WARNING'
        ELSE 'CRITICAL' END AS Status FROM log GROUP BY {K}""", ["log"],
)
_HEALTH = """CASE WHEN ExtractDurationSeconds > 600 THEN 'SLOW'
        WHEN ExtractStatus = 'FAILED' THEN 'FAILED' ELSE 'OK' END AS Health"""
CHECKS["r21_slow_loads"] = Check(
    lambda f: R.slow_loads(f.telemetry, n=200),
    f"""SELECT LastExtractTime, {K}, ExtractDurationSeconds, RecordsInserted, ExtractStatus, {_HEALTH}
      FROM log ORDER BY LastExtractTime DESC, {K}, ETLControlId LIMIT 200""", ["log"],
)
CHECKS["r22_freshness_report"] = Check(
    lambda f: R.freshness_report(f.telemetry, AS_OF),
    f"""SELECT {K}, max(LoadDate) AS LastLoadTime,
      CAST(date_diff('minute', max(LoadDate), {NOW}) AS INTEGER) AS MinutesSinceLoad,
      count(*) AS RecordCount, count(DISTINCT RuntimeStatsIntervalId) AS IntervalCount,
      CAST(date_diff('day', min(LoadDate), max(LoadDate)) AS INTEGER) AS DataAgeInDays
      FROM rt GROUP BY {K}""", ["rt"],
)
CHECKS["r23_plan_averages"] = Check(
    lambda f: R.plan_averages(f.telemetry),
    """SELECT QueryId, PlanId, avg(AvgDurationMs) AS AvgDuration,
      count(DISTINCT RuntimeStatsIntervalId) AS Intervals FROM rt GROUP BY QueryId, PlanId
      HAVING count(DISTINCT RuntimeStatsIntervalId) > 10""", ["rt"], {"AvgDuration": 4},
)
CHECKS["r24_tenant_server_duration"] = Check(
    lambda f: R.tenant_server_duration(f.telemetry),
    """SELECT TenantName, ServerName, avg(AvgDurationMs) AS AvgQueryDuration
      FROM rt GROUP BY 1, 2""", ["rt"], {"AvgQueryDuration": 4},
)
CHECKS["r25_duration_trend"] = Check(
    lambda f: R.duration_trend(f.since(AS_OF, 1000), AS_OF, days=1000),
    f"""SELECT TenantName, ServerName, IntervalDate, avg(AvgDurationSeconds) AS "Avg Duration (seconds)"
      FROM frd WHERE IntervalDate >= {TODAY} - INTERVAL 1000 DAY GROUP BY 1, 2, 3""",
    ["frd"], {"Avg Duration (seconds)": 6},
)
CHECKS["r26_executions_per_day"] = Check(
    lambda f: R.executions_per_day(f.telemetry),
    """SELECT IntervalDate, CAST(sum(CountExecutions) AS BIGINT) AS "Total Executions"
      FROM frd GROUP BY 1""", ["frd"],
)
CHECKS["r27_wait_share"] = Check(
    lambda f: R.wait_share_by_group(f.telemetry),
    """SELECT WaitCategoryGroup, sum(TotalWaitTimeMinutes) AS TotalWaitMinutes,
      sum(TotalWaitTimeMinutes) / (SELECT sum(TotalWaitTimeMinutes) FROM fw) * 100 AS SharePercent
      FROM fw GROUP BY 1""", ["fw"], each("TotalWaitMinutes SharePercent", 4),
)
CHECKS["r28_wait_trend"] = Check(
    lambda f: R.wait_trend(f.telemetry),
    """SELECT IntervalDate, WaitCategoryGroup, sum(TotalWaitTimeMinutes) AS TotalWaitMinutes
      FROM fwd GROUP BY 1, 2""", ["fwd"], {"TotalWaitMinutes": 4},
)
CHECKS["r28_wait_trend_pivot"] = Check(
    lambda f: R.wait_trend_pivot(f.telemetry),
    "SELECT IntervalDate, " + ", ".join(
        f"sum(TotalWaitTimeMinutes) FILTER (WHERE WaitCategoryGroup = '{g}') AS \"{g}\""
        for g in R.WAIT_GROUPS
    ) + " FROM fwd GROUP BY 1",
    ["fwd"], {g: 4 for g in R.WAIT_GROUPS},
)
CHECKS["r29_top_wait_queries"] = Check(
    lambda f: R.top_wait_queries(f.telemetry),
    f"""SELECT {QK}, WaitCategory, CAST(sum(TotalWaitTimeMs) AS BIGINT) AS TotalWaitTimeMs,
      CAST(sum(CountWaits) AS BIGINT) AS TotalWaits FROM waits GROUP BY {QK}, WaitCategory
      ORDER BY TotalWaitTimeMs DESC, {QK}, WaitCategory LIMIT 10""", ["waits"],
)
CHECKS["r30_regressions_per_day"] = Check(
    lambda f: R.regressions_per_day(f.telemetry),
    """SELECT CAST(DetectionDate AS DATE) AS Date, count(*) AS Regressions,
      avg(DurationChangePercentage) AS AvgChangePercentage FROM regs GROUP BY 1""",
    ["regs"], {"AvgChangePercentage": 4},
)
CHECKS["r31_tenant_matrix"] = Check(
    lambda f: R.tenant_matrix(f.telemetry),
    f"""SELECT * FROM (SELECT TenantName, count(DISTINCT QueryDimKey) AS QueryCount,
        avg(AvgDurationMs) AS AvgDurationMs,
        sum(CountExecutions * AvgCpuTimeMs) / {HOUR} AS TotalCpuHours FROM fr GROUP BY 1)
      FULL JOIN (SELECT TenantName, CAST(sum(TotalWaitTimeMs) AS DOUBLE) / {HOUR} AS TotalWaitHours
        FROM fw GROUP BY 1) USING (TenantName)
      FULL JOIN (SELECT TenantName, count(*) AS RegressionCount FROM regs GROUP BY 1) USING (TenantName)""",
    ["fr", "fw", "regs"], {"AvgDurationMs": 4, "TotalCpuHours": 5},
)
CHECKS["r32_resource_usage"] = Check(
    lambda f: R.resource_usage(f.telemetry),
    f"""SELECT TenantName, ServerName, sum(CountExecutions * AvgCpuTimeMs) / {HOUR} AS TotalCpuHours,
      avg(AvgMemoryUsedMb) AS AvgMemoryMB, avg(AvgLogicalIoReads) AS AvgLogicalReads,
      avg(AvgLogicalIoWrites) AS AvgLogicalWrites FROM rt GROUP BY 1, 2""",
    ["rt"], {"TotalCpuHours": 5, **each("AvgMemoryMB AvgLogicalReads AvgLogicalWrites", 4)},
)
CHECKS["r33_daily_rollup"] = Check(
    lambda f: R.daily_rollup(f.telemetry),
    """SELECT TenantName, ServerName, IntervalDate, count(*) AS Rows,
      CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions,
      sum(AvgDurationMs) AS SumAvgDurationMs, sum(AvgCpuTimeMs) AS SumAvgCpuTimeMs,
      sum(CountExecutions * AvgCpuTimeMs) AS TotalCpuMs,
      sum(CountExecutions * AvgDurationMs) AS TotalDurationMs, max(MaxDurationMs) AS MaxDurationMs
      FROM frd GROUP BY 1, 2, 3""",
    ["frd"], each("SumAvgDurationMs SumAvgCpuTimeMs TotalCpuMs TotalDurationMs", 2),
)
CHECKS["r35_alerts"] = Check(
    lambda f: R.alerts(f.telemetry, AS_OF, R.AlertThresholds(
        avg_duration_seconds=5.2, regression_hours=24, stale_hours=48, cpu_hours=20.0)),
    f"""SELECT 'Average duration' AS Alert, {K}, avg(AvgDurationMs) / 1000.0::DOUBLE AS Value
        FROM rt GROUP BY {K} HAVING avg(AvgDurationMs) / 1000.0::DOUBLE > 5.2
      UNION ALL SELECT 'CPU hours', {K}, sum(CountExecutions * AvgCpuTimeMs) / {HOUR}
        FROM rt GROUP BY {K} HAVING sum(CountExecutions * AvgCpuTimeMs) / {HOUR} > 20
      UNION ALL SELECT 'No recent load', {K}, date_diff('hour', max(LoadDate), {NOW})::DOUBLE
        FROM rt GROUP BY {K} HAVING max(LoadDate) < {NOW} - INTERVAL 48 HOUR
      UNION ALL SELECT 'New regression', {K}, count(*)::DOUBLE FROM regs
        WHERE DetectionDate >= {NOW} - INTERVAL 24 HOUR GROUP BY {K}
      UNION ALL SELECT 'Load failed', {K}, count(*)::DOUBLE FROM log
        WHERE ExtractStatus = 'FAILED' GROUP BY {K}""",
    ["rt", "regs", "log"], {"Value": 5},
)
CHECKS["r36_bookmark_slow"] = Check(
    lambda f: R.bookmark_slow_queries(f.telemetry, AS_OF), _slowest(10), ["rt", "dq"], _SLOW_DIGITS)
CHECKS["r36_bookmark_memory"] = Check(
    lambda f: R.bookmark_high_memory(f.telemetry), _HOGS, ["rt", "dq"], {"AvgMemoryMB": 4})
CHECKS["r36_bookmark_regressions"] = Check(
    lambda f: R.bookmark_recent_regressions(f.telemetry, AS_OF), _RECENT, ["regs", "dq"],
    _CHANGE_DIGITS)
CHECKS["p3_kpi_rollup"] = Check(
    lambda f: R.kpi_rollup(f.telemetry),
    f"""SELECT {K}, CAST(sum(CountExecutions) AS BIGINT) AS TotalExecutions,
      avg(AvgDurationMs) AS AvgDurationMs, max(MaxDurationMs) AS MaxDurationMs,
      CAST(grouping({K}) AS INTEGER) AS Level FROM rt GROUP BY ROLLUP ({K})""",
    ["rt"], {"AvgDurationMs": 4},
)
CHECKS["s_source_overview"] = Check(
    lambda f: slice_source(f.table(S.RUNTIME), "EUROPE", "NATION_8", "DB_O").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("RecordCount"), F.min("LoadDate").alias("FirstLoad"),
        F.max("LoadDate").alias("LastLoad")),
    f"""SELECT {K}, count(*) AS RecordCount, min(LoadDate) AS FirstLoad, max(LoadDate) AS LastLoad
      FROM rt WHERE TenantName = 'EUROPE' AND ServerName = 'NATION_8' AND DatabaseName = 'DB_O'
      GROUP BY {K}""", ["rt"],
)
CHECKS["t1_top_10_by_reads"] = Check(
    lambda f: R.top(
        f.table(S.RUNTIME).groupBy(*KEYS, "QueryId").agg(F.sum("AvgLogicalIoReads").alias("reads")),
        10, [F.desc("reads")], [*KEYS, "QueryId"]),
    f"""SELECT {QK}, CAST(sum(AvgLogicalIoReads) AS BIGINT) AS reads FROM rt GROUP BY {QK}
      ORDER BY reads DESC, {QK} LIMIT 10""", ["rt"],
)
