"""Building blocks of the checks: one Spark query and one SQL text per name.

The SQL derives the same telemetry from the same test tables, in plain terms
and without any of the library's rewrites, so that agreement means something.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from plandrift.sources.fixture import AS_OF, Fixture

NOW = f"TIMESTAMP '{AS_OF}'"
K = "TenantName, ServerName, DatabaseName"
QK = f"{K}, QueryId"

_START = "CAST(make_date({iv} // 4, ({iv} % 4) * 3 + 1, 1) AS TIMESTAMP)"
_QSTART = _START.format(iv="RuntimeStatsIntervalId")
_DBCODE = (
    "(CAST(regexp_extract(ServerName, '(\\d+)$', 1) AS BIGINT) * 2"
    " + CASE WHEN DatabaseName = 'DB_O' THEN 1 ELSE 0 END)"
)


def hex_id(number: str) -> str:
    return f"lpad(upper(to_hex({number})), 16, '0')"


def wait_group(column: str) -> str:
    rules = [
        ("%CPU%", "CPU Contention"), ("%MEMORY%", "Memory Pressure"),
        ("%RESOURCE_SEMAPHORE%", "Memory Pressure"), ("%IO%", "IO Contention"),
        ("%LOCK%", "Lock Contention"), ("%LATCH%", "Latch Contention"),
        ("%NETWORK%", "Network"),
    ]
    cases = " ".join(f"WHEN upper({column}) LIKE '{p}' THEN '{g}'" for p, g in rules)
    return f"CASE {cases} ELSE 'Other' END"


_WAIT_CASE = """CASE event_type
  WHEN 'click' THEN ['CPU', 'Worker Thread', 'Idle'][user_id % 3 + 1]
  WHEN 'view' THEN ['Buffer IO', 'Tran Log IO', 'Replication'][user_id % 3 + 1]
  WHEN 'purchase' THEN ['Lock', 'Latch', 'Buffer Latch'][user_id % 3 + 1]
  WHEN 'signup' THEN ['Memory', 'RESOURCE_SEMAPHORE', 'Compilation'][user_id % 3 + 1]
  WHEN 'error' THEN ['Network IO', 'NETWORK', 'Parallelism'][user_id % 3 + 1] END"""

_RANKED = (
    "['Buffer IO', 'Buffer Latch', 'CPU', 'Compilation', 'Idle', 'Latch', 'Lock', 'Memory', "
    "'NETWORK', 'Network IO', 'Parallelism', 'RESOURCE_SEMAPHORE', 'Replication', "
    "'Tran Log IO', 'Worker Thread']"
)


def _max_min(metric: str, kind: str) -> str:
    if kind == "long":
        low = f"CAST(floor(Avg{metric} / 2.0) AS BIGINT)"
    else:
        low = f"Avg{metric} / 2"
    return f"Avg{metric} * 2 AS Max{metric}, {low} AS Min{metric}"


# Name -> (names it builds on, SQL).
CTES: dict[str, tuple[list[str], str]] = {
    "items": ([], f"""
      SELECT r_name AS TenantName, n_name AS ServerName, 'DB_' || l_linestatus AS DatabaseName,
        CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS RuntimeStatsIntervalId,
        l_partkey % 50 AS QueryId, l_partkey % 50 * 10 + l_linenumber % 5 AS PlanId,
        CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS ExecutionType,
        CAST(l_quantity AS BIGINT) AS quantity,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
        CAST(round(l_extendedprice * (1.0::DOUBLE - l_discount) * 100) AS BIGINT) AS net_cents,
        l_extendedprice AS price, l_linenumber AS line
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "metrics": (["items"], f"""
      SELECT {QK}, RuntimeStatsIntervalId, PlanId, ExecutionType,
        CAST(sum(quantity) AS BIGINT) AS CountExecutions,
        CAST(sum(cents) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1000.0::DOUBLE AS AvgDurationMs,
        max(price) / 10.0::DOUBLE AS MaxDurationMs, min(price) / 10.0::DOUBLE AS MinDurationMs,
        stddev_samp(price) / 10.0::DOUBLE AS StdevDurationMs,
        CAST(floor(CAST(sum(quantity) AS DOUBLE) * 500.0::DOUBLE / CAST(count(*) AS DOUBLE)) AS BIGINT) AS AvgLogicalIoReads,
        CAST(sum(net_cents) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 2000.0::DOUBLE AS AvgCpuTimeMs,
        CAST(sum(quantity) AS DOUBLE) * 4.0::DOUBLE / CAST(count(*) AS DOUBLE) AS AvgMemoryUsedMb,
        CAST(sum(line) AS DOUBLE) * 50.0::DOUBLE / CAST(count(*) AS DOUBLE) AS AvgRowCount
      FROM items GROUP BY ALL"""),
    "rt": (["metrics"], f"""
      SELECT *, {_max_min('LogicalIoReads', 'long')}, {_max_min('LogicalIoWrites', 'long')},
        {_max_min('PhysicalIoReads', 'long')}, {_max_min('CpuTimeMs', 'double')},
        {_max_min('ClrTimeMs', 'double')}, {_max_min('MemoryUsedMb', 'double')},
        CAST(floor(AvgRowCount * 2) AS BIGINT) AS MaxRowCount,
        CAST(floor(AvgRowCount / 2) AS BIGINT) AS MinRowCount,
        ['Regular', 'Aborted', 'Exception'][ExecutionType + 1] AS ExecutionTypeDesc,
        {_QSTART} + to_days(CAST(QueryId % 35 AS INTEGER)) AS LoadDate,
        (QueryId % 7 = 3 AND PlanId % 5 = 4 AND RuntimeStatsIntervalId % 3 = 0) AS IsRegression,
        (({_DBCODE} * 10000 + RuntimeStatsIntervalId) * 500 + PlanId) * 3 + ExecutionType AS RuntimeStatsId
      FROM (SELECT *, CAST(floor(AvgLogicalIoReads / 10.0) AS BIGINT) AS AvgLogicalIoWrites,
          CAST(floor(AvgLogicalIoReads / 20.0) AS BIGINT) AS AvgPhysicalIoReads,
          0.0::DOUBLE AS AvgClrTimeMs, AvgDurationMs AS AvgElapsedTimeMs,
          MaxDurationMs AS MaxElapsedTimeMs, MinDurationMs AS MinElapsedTimeMs FROM metrics)"""),
    "wait_events": ([], f"""
      SELECT r_name AS TenantName, n_name AS ServerName,
        CASE WHEN user_id % 2 = 0 THEN 'DB_F' ELSE 'DB_O' END AS DatabaseName,
        CAST(7980 + event_id % 28 AS INTEGER) AS RuntimeStatsIntervalId,
        event_id % 50 AS QueryId, event_id % 50 * 10 + event_id % 3 AS PlanId,
        {_WAIT_CASE} AS WaitCategory, CAST(round(value * 100) AS BIGINT) AS cents,
        CAST(event_id % 2 AS INTEGER) AS bucket
      FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "waits": (["wait_events"], f"""
      SELECT *, 0 AS QueryWaitTimeCategory,
        {_QSTART} + to_days(CAST(QueryId % 35 AS INTEGER)) AS LoadDate,
        (({_DBCODE} * 10000 + RuntimeStatsIntervalId) * 500 + PlanId) * 20 + WaitCategoryId AS WaitStatsId
      FROM (SELECT {QK}, RuntimeStatsIntervalId, PlanId, WaitCategory,
          CAST(list_position({_RANKED}, WaitCategory) AS INTEGER) AS WaitCategoryId,
          CAST(sum(cents) AS BIGINT) AS TotalWaitTimeMs,
          CAST(sum(cents) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS AvgWaitTimeMs,
          max(cents) AS MaxWaitTimeMs, count(*) AS CountWaits
        FROM wait_events GROUP BY ALL)"""),
    "intervals": (["rt"], f"""
      SELECT *, IntervalStartTime + INTERVAL 3 MONTH AS IntervalEndTime,
        CAST(date_diff('minute', IntervalStartTime, IntervalStartTime + INTERVAL 3 MONTH) AS INTEGER) AS IntervalDurationMinutes,
        CAST(IntervalStartTime AS DATE) AS CapturedDate, '00:00:00.000000' AS CapturedTime,
        IntervalStartTime AS LoadDate
      FROM (SELECT DISTINCT TenantName, ServerName, RuntimeStatsIntervalId,
        {_QSTART} AS IntervalStartTime FROM rt)"""),
    "queries": (["rt"], f"""
      SELECT *, CompilationStartTime + INTERVAL 1 MINUTE AS CompilationEndTime,
        CompilationStartTime AS LastCompilationBatchUTC
      FROM (SELECT DISTINCT {QK}, QueryId AS QueryTextId, CAST(1 AS BIGINT) AS ContextSettingsId,
          CASE QueryId % 3 WHEN 1 THEN 0 WHEN 2 THEN QueryId END AS ObjectId,
          {NOW} - to_days(CAST(QueryId % 60 AS INTEGER)) AS CompilationStartTime,
          QueryId * 3 AS LastCompilationBatch, QueryId % 9 + 1 AS CompilationCount,
          QueryId * 1.5::DOUBLE AS AvgCompileCpuTimeMs, QueryId * 3.0::DOUBLE AS MaxCompileCpuTimeMs,
          QueryId * 0.25::DOUBLE AS AvgCompileMemoryMb, QueryId * 0.5::DOUBLE AS MaxCompileMemoryMb,
          {NOW} - to_days(CAST(QueryId % 35 AS INTEGER)) AS LoadDate
        FROM rt WHERE QueryId <> 49)"""),
    "texts": (["queries"], f"""
      SELECT {K}, QueryTextId, 'SELECT ' || p_name AS QueryTextContent, 'SELECT' AS StatementType,
        {hex_id('QueryTextId')} AS QueryHash, LoadDate
      FROM queries JOIN part ON p_partkey = QueryTextId WHERE QueryTextId % 10 <> 7"""),
    "plans": (["rt"], f"""
      SELECT {QK}, PlanId, '16.0' AS EngineVersion,
        CAST(150 + PlanId % 2 * 10 AS INTEGER) AS CompatibilityLevel,
        {hex_id('PlanId')} AS QueryPlanHash, {hex_id('QueryId')} AS QueryHash,
        {NOW} - to_days(CAST(PlanId % 200 AS INTEGER)) AS CreationTime,
        {NOW} - to_days(CAST(PlanId % 200 AS INTEGER)) + to_hours(CAST(PlanId % 40 * 31 AS INTEGER)) AS LastExecutionTime,
        CASE WHEN PlanId % 3 = 0 THEN {hex_id('PlanId')} END AS QueryPlanCompressed,
        CASE WHEN PlanId % 3 = 1 THEN '<plan/>' END AS QueryPlanText,
        PlanId % 2 = 0 AS IsParallelizable,
        {NOW} - to_days(CAST(QueryId % 35 AS INTEGER)) AS LoadDate
      FROM (SELECT DISTINCT {QK}, PlanId FROM rt UNION ALL
        SELECT DISTINCT {QK}, QueryId * 10 + 9 AS PlanId FROM rt)"""),
    "pairs": (["rt"], f"""
      SELECT o.TenantName, o.ServerName, o.DatabaseName, o.QueryId, o.PlanId AS OldPlanId,
        n.PlanId AS NewPlanId, avg(o.AvgDurationMs) AS OldAvgDurationMs,
        avg(n.AvgDurationMs) AS NewAvgDurationMs
      FROM rt o JOIN rt n USING ({QK})
      WHERE o.PlanId <> n.PlanId AND o.RuntimeStatsIntervalId < n.RuntimeStatsIntervalId
      GROUP BY ALL"""),
    "found": (["pairs"], """
      SELECT *, (NewAvgDurationMs - OldAvgDurationMs) / OldAvgDurationMs * 100 AS DurationChangePercentage
      FROM pairs WHERE OldAvgDurationMs <> 0
        AND (NewAvgDurationMs - OldAvgDurationMs) / OldAvgDurationMs > 0.25"""),
    "regs": (["found"], f"""
      SELECT *, ({_DBCODE} * 50 + QueryId) * 100 + OldPlanId % 10 * 10 + NewPlanId % 10 AS RegressionId,
        {NOW} - to_hours(CAST((QueryId * 37 + NewPlanId * 5) % 1200 AS INTEGER)) AS DetectionDate,
        QueryId % 4 = 0 AS IsInvestigated,
        CASE WHEN QueryId % 4 = 0 THEN 'checked' END AS Notes
      FROM found"""),
    "log": (["rt"], f"""
      SELECT *, LastExtractTime AS LoadDate FROM (
        SELECT {K}, {_DBCODE} * 10000 + RuntimeStatsIntervalId AS ETLControlId,
          {_QSTART} + to_hours(CAST(34 * 24 + RuntimeStatsIntervalId % 24
            + CASE WHEN DatabaseName = 'DB_O' THEN 7 ELSE 0 END
            - {_DBCODE} // 2 % 3 * 24 AS INTEGER)) AS LastExtractTime,
          CAST(RuntimeStatsIntervalId * 37 % 900 AS INTEGER) AS ExtractDurationSeconds,
          count(*) AS RecordsInserted, CAST(RuntimeStatsIntervalId % 5 AS BIGINT) AS RecordsUpdated,
          CASE WHEN RuntimeStatsIntervalId % 11 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS ExtractStatus,
          CASE WHEN RuntimeStatsIntervalId % 11 = 0 THEN 'timeout' END AS ErrorMessage
        FROM rt GROUP BY {K}, RuntimeStatsIntervalId)"""),
    # Facts and dimensions as the reports see them.
    "fr": (["rt"], """
      SELECT *, AvgDurationMs / 1000.0::DOUBLE AS AvgDurationSeconds,
        AvgCpuTimeMs / 1000.0::DOUBLE AS AvgCpuTimeSeconds,
        concat_ws('_', TenantName, ServerName, DatabaseName, QueryId) AS QueryDimKey,
        concat_ws('_', TenantName, ServerName, DatabaseName, PlanId) AS PlanDimKey FROM rt"""),
    "fw": (["waits"], f"""
      SELECT *, CAST(TotalWaitTimeMs AS DOUBLE) / 1000.0::DOUBLE / 60.0::DOUBLE AS TotalWaitTimeMinutes,
        {wait_group('WaitCategory')} AS WaitCategoryGroup,
        concat_ws('_', TenantName, ServerName, DatabaseName, QueryId) AS QueryDimKey FROM waits"""),
    "dq": (["queries", "texts"], f"""
      SELECT q.*, t.QueryTextContent AS QueryText, t.StatementType, t.QueryHash
      FROM queries q LEFT JOIN texts t USING ({K}, QueryTextId)"""),
    "frd": (["fr", "intervals"], """
      SELECT fr.*, CapturedDate AS IntervalDate
      FROM fr JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)"""),
    "fwd": (["fw", "intervals"], """
      SELECT fw.*, CapturedDate AS IntervalDate
      FROM fw JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)"""),
}


def with_clause(names: list[str], extra: dict[str, str] | None = None) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for base in CTES[name][0]:
            add(base)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) if parts else ""


def _nudge(digits: int) -> float:
    """Offset that moves short decimals off rounding ties, so both engines round alike."""
    return 0.3317529 * 10.0 ** -(digits + 1)


@dataclass(frozen=True)
class Check:
    spark: Callable[[Fixture], DataFrame]
    sql: str | None = None
    uses: list[str] = field(default_factory=list)
    digits: dict[str, int] = field(default_factory=dict)
    extra: dict[str, str] = field(default_factory=dict)

    def run(self, spark: SparkSession, data_dir: str) -> DataFrame:
        df = self.spark(Fixture(spark, data_dir))
        for column, digits in self.digits.items():
            df = df.withColumn(column, F.round(F.col(f"`{column}`") + _nudge(digits), digits))
        return df

    def oracle(self) -> str:
        body = self.sql
        if self.digits:
            rounded = ", ".join(
                f'round("{c}" + {_nudge(d)!r}::DOUBLE, {d}) AS "{c}"'
                for c, d in self.digits.items()
            )
            body = f"SELECT * REPLACE ({rounded}) FROM ({body})"
        return f"{with_clause(self.uses, self.extra)}\n{body}"


def each(columns: str, digits: int) -> dict[str, int]:
    return {c: digits for c in columns.split()}
