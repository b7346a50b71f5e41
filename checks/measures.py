"""Checks of measures, ranks and time intelligence."""

from pyspark.sql import functions as F

from checks.base import K, QK, Check
from plandrift import schemas as S
from plandrift.functions import measures as M, time_intelligence as TI
from plandrift.schemas import QUERY_KEY

CHECKS: dict[str, Check] = {}

HOST = ["TenantName", "ServerName"]


def _hours(metric):
    """Per query executions times mean metric, then summed: needs a nested query."""
    return f"sum(q_n * {metric}) / 1000.0::DOUBLE / 3600.0::DOUBLE"


def share(group):
    return (
        f"sum(CASE WHEN WaitCategoryGroup = '{group}' THEN TotalWaitTimeMinutes END)"
        " / nullif(sum(TotalWaitTimeMinutes), 0) * 100"
    )


def having_query(condition):
    return f"count(DISTINCT CASE WHEN {condition} THEN QueryDimKey END)"


# key -> (measure, fact, SQL over the fact, digits; None for exact integers).
SIMPLE = {
    "k01_avg_duration_seconds": ("Avg Duration (seconds)", "fr", "avg(AvgDurationSeconds)", 6),
    "k02_max_duration_ms": ("Max Duration (ms)", "fr", "max(MaxDurationMs)", None),
    "k03_total_executions": ("Total Executions", "fr", "CAST(sum(CountExecutions) AS BIGINT)", None),
    "k04_avg_cpu_seconds": ("Avg CPU Time (seconds)", "fr", "avg(AvgCpuTimeSeconds)", 6),
    "k05_max_cpu_ms": ("Max CPU Time (ms)", "fr", "max(MaxCpuTimeMs)", None),
    "k06_avg_logical_reads": ("Avg Logical Reads", "fr", "avg(AvgLogicalIoReads)", 4),
    "k07_avg_physical_reads": ("Avg Physical Reads", "fr", "avg(AvgPhysicalIoReads)", 4),
    "k08_avg_memory_mb": ("Avg Memory (MB)", "fr", "avg(AvgMemoryUsedMb)", 4),
    "k09_avg_duration_ms": ("Avg Duration (ms)", "fr", "avg(AvgDurationMs)", 4),
    "k12_total_wait_minutes": ("Total Wait Time (minutes)", "fw", "sum(TotalWaitTimeMinutes)", 4),
    "k17_cpu_wait_share": ("CPU Wait %", "fw", share("CPU Contention"), 4),
    "k18_memory_wait_share": ("Memory Wait %", "fw", share("Memory Pressure"), 4),
    "k19_io_wait_share": ("IO Wait %", "fw", share("IO Contention"), 4),
    "k20_avg_wait_ms": ("Avg Wait Time (ms)", "fw", "avg(AvgWaitTimeMs)", 4),
    "k21_max_wait_ms": ("Max Wait Time (ms)", "fw", "max(MaxWaitTimeMs)", None),
    "k22_regression_count": (
        "Regression Count", "fr", "CAST(sum(CASE WHEN IsRegression THEN 1 END) AS BIGINT)", None),
    "k23_regression_share": (
        "Regression % of Queries", "fr",
        "CAST(sum(CASE WHEN IsRegression THEN 1 END) AS DOUBLE) / count(DISTINCT QueryDimKey) * 100", 4),
    "k24_plans_per_query": (
        "Avg Plans per Query", "fr",
        "CAST(count(DISTINCT PlanDimKey) AS DOUBLE) / count(DISTINCT QueryDimKey)", 6),
    "k25_cpu_of_elapsed": (
        "CPU % of Elapsed", "fr", "sum(AvgCpuTimeMs) / nullif(sum(AvgDurationMs), 0) * 100", 4),
    "k26_avg_rows": ("Avg Rows per Execution", "fr", "avg(AvgRowCount)", 4),
    "k27_avg_io": (
        "Avg IO per Execution", "fr", "avg(AvgLogicalIoReads) + avg(AvgLogicalIoWrites)", 4),
    "k28_avg_memory_per_execution": ("Avg Memory per Execution (MB)", "fr", "avg(AvgMemoryUsedMb)", 4),
    "k29_slow_queries": ("Slow Query Count (>1s)", "fr", having_query("AvgDurationMs > 1000"), None),
    "k30_high_memory_queries": (
        "High Memory Query Count (>100MB)", "fr", having_query("AvgMemoryUsedMb > 100"), None),
    "k31_high_io_queries": (
        "High IO Query Count (>10K reads)", "fr", having_query("AvgLogicalIoReads > 10000"), None),
    "k36_server_count": ("Server Count", "fr", "count(DISTINCT ServerName)", None),
    "k37_database_count": ("Database Count", "fr", "count(DISTINCT DatabaseName)", None),
    "k38_tenant_count": ("Tenant Count", "fr", "count(DISTINCT TenantName)", None),
    "k40_critical_queries": (
        "Critical Query Count", "fr",
        having_query("AvgDurationMs > 1000 AND AvgCpuTimeMs > 500 AND AvgMemoryUsedMb > 100"), None),
    "k41_index_review": (
        "Index Review Candidates", "fr",
        having_query("AvgLogicalIoReads > 10000 AND AvgRowCount < 100"), None),
    "k42_total_cpu_ms": ("Total CPU (ms)", "fr", "sum(AvgCpuTimeMs * CountExecutions)", 1),
    "k43_cpu_per_execution": (
        "CPU per Execution (ms)", "fr", "sum(AvgCpuTimeMs * CountExecutions) / sum(CountExecutions)", 4),
    "k44_avg_logical_writes": ("Avg Logical Writes", "fr", "avg(AvgLogicalIoWrites)", 4),
    "k45_regression_queries": (
        "Regression Query Count", "fr", "count(DISTINCT CASE WHEN IsRegression THEN QueryId END)", None),
    "k46_regression_rate": (
        "Regression Rate %", "fr",
        "CAST(count(DISTINCT CASE WHEN IsRegression THEN QueryId END) AS DOUBLE) / count(DISTINCT QueryId)", 6),
    "k48_total_wait_ms": ("Total Wait (ms)", "fw", "CAST(sum(TotalWaitTimeMs) AS BIGINT)", None),
}
SQL_OF = {measure: (fact, sql) for measure, fact, sql, _ in SIMPLE.values()}


def _evaluate(f, names, by):
    wanted = {M.MEASURES[n].fact for n in names}
    return M.evaluate(
        names, by,
        runtime=f.table(S.RUNTIME) if wanted & {"runtime", "both"} else None,
        waits=f.table(S.WAIT) if wanted & {"wait", "both"} else None,
    )


for _key, (_measure, _fact, _sql, _digits) in SIMPLE.items():
    CHECKS[_key] = Check(
        lambda f, m=_measure: _evaluate(f, [m], HOST),
        f'SELECT TenantName, ServerName, {_sql} AS "{_measure}" FROM {_fact} GROUP BY 1, 2',
        [_fact], {} if _digits is None else {_measure: _digits},
    )

for _key, _measure, _metric in (
    ("k10_total_cpu_hours", "Total CPU Hours", "AvgCpuTimeMs"),
    ("k11_total_elapsed_hours", "Total Elapsed Hours", "AvgDurationMs"),
):
    CHECKS[_key] = Check(
        lambda f, m=_measure: _evaluate(f, [m], HOST),
        f"""SELECT TenantName, ServerName, {_hours('metric')} AS "{_measure}" FROM (
          SELECT {QK}, sum(CountExecutions) AS q_n, avg({_metric}) AS metric FROM fr GROUP BY {QK})
          GROUP BY 1, 2""",
        ["fr"], {_measure: 6},
    )

CHECKS["k13_k14_k15_changes_by_quarter"] = Check(
    lambda f: TI.period_change(
        TI.CHANGES, "quarter", f.table(S.INTERVAL), ["TenantName"], runtime=f.table(S.RUNTIME)),
    """SELECT TenantName, Period, d AS "Avg Duration (seconds)", c AS "Avg CPU Time (seconds)",
      n AS "Total Executions",
      (d - lag(d) OVER w) / lag(d) OVER w * 100 AS "Duration Change (%)",
      (c - lag(c) OVER w) / lag(c) OVER w * 100 AS "CPU Change (%)",
      CAST(n - lag(n) OVER w AS DOUBLE) / lag(n) OVER w * 100 AS "Execution Count Change (%)"
    FROM (SELECT TenantName, CAST(date_trunc('quarter', IntervalDate) AS DATE) AS Period,
        avg(AvgDurationSeconds) AS d, avg(AvgCpuTimeSeconds) AS c,
        CAST(sum(CountExecutions) AS BIGINT) AS n FROM frd GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY TenantName ORDER BY Period)""",
    ["frd"],
    {"Avg Duration (seconds)": 6, "Avg CPU Time (seconds)": 6, "Duration Change (%)": 4,
     "CPU Change (%)": 4, "Execution Count Change (%)": 4},
)
CHECKS["w5_changes_with_gaps"] = Check(
    lambda f: TI.period_change(
        {"Total Executions": "Execution Count Change (%)"}, "month", f.table(S.INTERVAL),
        QUERY_KEY, runtime=f.table(S.RUNTIME)),
    f"""SELECT {QK}, Period, n AS "Total Executions",
      CASE WHEN before IS NOT NULL THEN (ifnull(n, 0) - before) / CAST(before AS DOUBLE) * 100
        END AS "Execution Count Change (%)"
    FROM (SELECT *, lag(n) OVER (PARTITION BY {QK} ORDER BY Period) AS before FROM (
        SELECT {QK}, Period, n FROM (
          SELECT {QK}, CAST(unnest(generate_series(min(IntervalDate), max(IntervalDate),
            INTERVAL 1 MONTH)) AS DATE) AS Period FROM frd GROUP BY {QK})
        LEFT JOIN (SELECT {QK}, IntervalDate AS Period,
            CAST(sum(CountExecutions) AS BIGINT) AS n FROM frd GROUP BY {QK}, IntervalDate)
          USING ({QK}, Period)))""",
    ["frd"], {"Execution Count Change (%)": 4},
)
CHECKS["k16_wait_hours_by_category"] = Check(
    lambda f: _evaluate(f, ["Wait Time by Category (hours)"], ["WaitCategory"]),
    """SELECT WaitCategory, sum(TotalWaitTimeMinutes) / 60.0::DOUBLE AS "Wait Time by Category (hours)"
      FROM fw GROUP BY 1""", ["fw"], {"Wait Time by Category (hours)": 6},
)
CHECKS["k32_plan_instability"] = Check(
    lambda f: _evaluate(f, ["Plan Instability Count"], HOST),
    f"""SELECT TenantName, ServerName, count(*) FILTER (WHERE n > 3) AS "Plan Instability Count"
      FROM (SELECT {QK}, count(DISTINCT PlanDimKey) AS n FROM fr GROUP BY {QK}) GROUP BY 1, 2""",
    ["fr"],
)


def _rank_check(measure, name, sql_value, digits, dense=False):
    """Ranks are compared through rounded values, on which exact ties stay ties."""
    def run(f):
        return M.rank_queries(f.table(S.RUNTIME), measure, name, dense)

    rank = "dense_rank" if dense else "rank"
    return Check(
        run,
        f"""SELECT {QK}, v AS "{measure}", {rank}() OVER (ORDER BY v DESC) AS "{name}"
          FROM (SELECT {QK}, {sql_value} AS v FROM fr GROUP BY {QK})""",
        ["fr"], {} if digits is None else {measure: digits},
    )


CHECKS["k33_duration_rank"] = _rank_check(
    "Avg Duration (seconds)", "Duration Rank", "avg(AvgDurationSeconds)", 6)
CHECKS["k34_cpu_rank"] = _rank_check(
    "Avg CPU Time (seconds)", "CPU Rank", "avg(AvgCpuTimeSeconds)", 6)
CHECKS["k35_execution_rank"] = _rank_check(
    "Total Executions", "Execution Count Rank", "CAST(sum(CountExecutions) AS BIGINT)", None)
CHECKS["k47_dense_duration_rank"] = _rank_check(
    "Avg Duration (ms)", "Top Query Rank by Duration", "avg(AvgDurationMs)", 4, dense=True)
CHECKS["w1_dense_execution_rank_by_tenant"] = Check(
    lambda f: M.rank_queries(
        f.table(S.RUNTIME), "Total Executions", "Rank", dense=True, within=["TenantName"]),
    f"""SELECT {QK}, n AS "Total Executions",
      dense_rank() OVER (PARTITION BY TenantName ORDER BY n DESC) AS "Rank"
      FROM (SELECT {QK}, CAST(sum(CountExecutions) AS BIGINT) AS n FROM fr GROUP BY {QK})""",
    ["fr"],
)
CHECKS["k39_server_variance"] = Check(
    lambda f: M.server_duration_variance(f.table(S.RUNTIME), ["TenantName"]),
    """SELECT TenantName, avg((total - s) ** 2) AS "Server Duration Variance" FROM (
        SELECT TenantName, ServerName, avg(AvgDurationSeconds) AS s FROM fr GROUP BY 1, 2)
      JOIN (SELECT TenantName, avg(AvgDurationSeconds) AS total FROM fr GROUP BY 1)
        USING (TenantName) GROUP BY 1""",
    ["fr"], {"Server Duration Variance": 6},
)
CHECKS["k49_waits_per_execution"] = Check(
    lambda f: _evaluate(f, ["Waits per Execution (ms)"], HOST),
    """SELECT TenantName, ServerName,
      CAST(w AS DOUBLE) / CAST(n AS DOUBLE) AS "Waits per Execution (ms)" FROM (
        SELECT TenantName, ServerName, sum(TotalWaitTimeMs) AS w FROM fw GROUP BY 1, 2)
      FULL JOIN (SELECT TenantName, ServerName, sum(CountExecutions) AS n FROM fr GROUP BY 1, 2)
        USING (TenantName, ServerName)""",
    ["fw", "fr"], {"Waits per Execution (ms)": 6},
)
CHECKS["k50_top_queries_count"] = Check(
    lambda f: M.top_queries_count(f.table(S.RUNTIME), 10),
    f"""SELECT count(*) AS "TopQueries" FROM (SELECT rank() OVER (ORDER BY v DESC) AS r FROM (
      SELECT {QK}, avg(AvgDurationSeconds) AS v FROM fr GROUP BY {QK})) WHERE r <= 10""",
    ["fr"],
)
CHECKS["k51_duration_improvement"] = Check(
    lambda f: TI.duration_improvement(
        f.table(S.RUNTIME), f.table(S.INTERVAL), ["TenantName"], days=92),
    """SELECT TenantName, IntervalDate, c.d AS "Avg Duration (seconds)",
      p.d AS "Previous Avg Duration (seconds)", (p.d - c.d) / p.d * 100 AS "Duration Improvement %"
    FROM daily c LEFT JOIN (SELECT TenantName, CAST(IntervalDate + INTERVAL 92 DAY AS DATE) AS IntervalDate, d FROM daily) p
      USING (TenantName, IntervalDate)""",
    ["frd"],
    {"Avg Duration (seconds)": 6, "Previous Avg Duration (seconds)": 6, "Duration Improvement %": 4},
    {"daily": "SELECT TenantName, IntervalDate, avg(AvgDurationSeconds) AS d FROM frd GROUP BY 1, 2"},
)
CHECKS["k52_regression_risk"] = Check(
    lambda f: TI.regression_risk(
        None, f.table(S.INTERVAL), "year", ["TenantName"], f.table(S.RUNTIME_DAILY)),
    f"""SELECT TenantName, Period, unstable AS "Plan Instability Count",
      regressed AS "Regression Count", change AS "Duration Change (%)",
      CASE WHEN unstable > 0 THEN ifnull(regressed, 0) * 10 + ifnull(change, 0) / 10
        ELSE 0 END AS "Regression Risk Score"
    FROM (SELECT *, (d - lag(d) OVER w) / lag(d) OVER w * 100 AS change FROM (
        SELECT TenantName, CAST(date_trunc('year', IntervalDate) AS DATE) AS Period,
          avg(AvgDurationSeconds) AS d,
          CAST(sum(CASE WHEN IsRegression THEN 1 END) AS BIGINT) AS regressed FROM frd GROUP BY 1, 2)
      JOIN (SELECT TenantName, Period, count(*) FILTER (WHERE n > 3) AS unstable FROM (
          SELECT {QK}, CAST(date_trunc('year', IntervalDate) AS DATE) AS Period,
            count(DISTINCT PlanId) AS n FROM frd GROUP BY ALL) GROUP BY 1, 2)
        USING (TenantName, Period)
      WINDOW w AS (PARTITION BY TenantName ORDER BY Period))""",
    ["frd"], {"Duration Change (%)": 4, "Regression Risk Score": 4},
)


def _bundle_sql(names, by="TenantName"):
    """Runtime and wait measures of a bundle, each fact aggregated on its own."""
    runtime = [n for n in names if n in SQL_OF and SQL_OF[n][0] == "fr"]
    waits = [n for n in names if n in SQL_OF and SQL_OF[n][0] == "fw"]
    parts = {
        fact: ", ".join(f'{SQL_OF[n][1]} AS "{n}"' for n in chosen)
        for fact, chosen in (("fr", runtime), ("fw", waits))
    }
    return f"""SELECT *, CAST("Total Wait (ms)" AS DOUBLE) / "Total Executions" AS "Waits per Execution (ms)"
      FROM (SELECT {by}, {parts['fr']} FROM fr GROUP BY {by})
      FULL JOIN (SELECT {by}, {parts['fw']} FROM fw GROUP BY {by}) USING ({by})"""


SQL_OF["Avg Wait (ms)"] = ("fw", "avg(AvgWaitTimeMs)")
CHECKS["k53_executive_bundle"] = Check(
    lambda f: _evaluate(f, M.EXECUTIVE, ["TenantName"]), _bundle_sql(M.EXECUTIVE), ["fr", "fw"],
    {"Avg Duration (ms)": 4, "Total CPU (ms)": 1, "CPU per Execution (ms)": 4,
     "Regression Rate %": 6, "Waits per Execution (ms)": 6},
)
CHECKS["k54_operations_bundle"] = Check(
    lambda f: _evaluate(f, M.OPERATIONS, ["TenantName"]), _bundle_sql(M.OPERATIONS), ["fr", "fw"],
    {"Avg Duration (ms)": 4, "Avg Logical Reads": 4, "Avg Logical Writes": 4,
     "Avg Wait (ms)": 4, "Waits per Execution (ms)": 6},
)
CHECKS["k54_operations_by_query"] = Check(
    lambda f: M.operations_by_query(f.table(S.RUNTIME), f.table(S.WAIT)),
    f"""SELECT *, dense_rank() OVER (ORDER BY "Avg Duration (ms)" DESC NULLS LAST)
        AS "Top Query Rank by Duration" FROM ({_bundle_sql(M.OPERATIONS, QK)})""", ["fr", "fw"],
    {"Avg Duration (ms)": 4, "Avg Logical Reads": 4, "Avg Logical Writes": 4,
     "Avg Wait (ms)": 4, "Waits per Execution (ms)": 6},
)
CHECKS["k_all_runtime_measures"] = Check(
    lambda f: _evaluate(
        f, [m for m, fact, _, _ in SIMPLE.values() if fact == "fr"], ["TenantName"]),
    "SELECT TenantName, " + ", ".join(
        f'{sql} AS "{m}"' for m, fact, sql, _ in SIMPLE.values() if fact == "fr"
    ) + " FROM fr GROUP BY 1",
    ["fr"], {m: d for m, fact, _, d in SIMPLE.values() if fact == "fr" and d is not None},
)
CHECKS["k_grand_total"] = Check(
    lambda f: _evaluate(f, ["Total Executions", "Slow Query Count (>1s)", "Total Wait (ms)"], []),
    """SELECT (SELECT CAST(sum(CountExecutions) AS BIGINT) FROM fr) AS "Total Executions",
      (SELECT count(DISTINCT QueryDimKey) FROM fr WHERE AvgDurationMs > 1000) AS "Slow Query Count (>1s)",
      (SELECT CAST(sum(TotalWaitTimeMs) AS BIGINT) FROM fw) AS "Total Wait (ms)" """,
    ["fr", "fw"],
)

# --- to-date totals: every date re-aggregates all rows of its period so far --------

_TO_DATE = [
    "Total Executions", "Avg Duration (seconds)", "Max Duration (ms)",
    "Slow Query Count (>1s)", "Regression Query Count", "Avg Plans per Query",
]


def _to_date_sql(period):
    columns = ", ".join(f'{SQL_OF[m][1]} AS "{m}"' for m in _TO_DATE)
    return f"""SELECT TenantName, d AS IntervalDate, {columns}
      FROM (SELECT DISTINCT TenantName, IntervalDate AS d FROM frd) dates JOIN frd USING (TenantName)
      WHERE date_trunc('{period}', IntervalDate) = date_trunc('{period}', d) AND IntervalDate <= d
      GROUP BY 1, 2"""


for _key, _period in (("w3_mtd", "month"), ("w3_qtd", "quarter"), ("w3_ytd", "year")):
    CHECKS[_key] = Check(
        lambda f, p=_period: TI.to_date(
            _TO_DATE, p, by=["TenantName"], daily=f.table(S.RUNTIME_DAILY)),
        _to_date_sql(_period), ["frd"], {"Avg Duration (seconds)": 6, "Avg Plans per Query": 6},
    )
CHECKS["w3_ytd_hours_and_instability"] = Check(
    lambda f: TI.to_date(
        ["Total CPU Hours", "Plan Instability Count"], "year", f.table(S.INTERVAL), ["TenantName"],
        runtime=f.table(S.RUNTIME)),
    f"""SELECT TenantName, d AS IntervalDate, sum(h) AS "Total CPU Hours",
      count(*) FILTER (WHERE plans > 3) AS "Plan Instability Count" FROM (
        SELECT {K}, d, QueryId, count(DISTINCT PlanId) AS plans,
          sum(CountExecutions) * avg(AvgCpuTimeMs) / 3600000.0::DOUBLE AS h
        FROM (SELECT DISTINCT TenantName, IntervalDate AS d FROM frd) JOIN frd USING (TenantName)
        WHERE year(IntervalDate) = year(d) AND IntervalDate <= d GROUP BY ALL) GROUP BY 1, 2""",
    ["frd"], {"Total CPU Hours": 5},
)
CHECKS["w3_ytd_waits"] = Check(
    lambda f: TI.to_date(
        ["Total Wait (ms)", "Waits per Execution (ms)"], "year", f.table(S.INTERVAL),
        ["TenantName"], runtime=f.table(S.RUNTIME), waits=f.table(S.WAIT)),
    """SELECT TenantName, IntervalDate, CAST(sum(w) OVER p AS BIGINT) AS "Total Wait (ms)",
      CAST(sum(w) OVER p AS DOUBLE) / CAST(sum(n) OVER p AS DOUBLE) AS "Waits per Execution (ms)"
    FROM (SELECT TenantName, IntervalDate, sum(TotalWaitTimeMs) AS w FROM fwd GROUP BY 1, 2)
      FULL JOIN (SELECT TenantName, IntervalDate, sum(CountExecutions) AS n FROM frd GROUP BY 1, 2)
      USING (TenantName, IntervalDate)
    WINDOW p AS (PARTITION BY TenantName, year(IntervalDate) ORDER BY IntervalDate)""",
    ["frd", "fwd"], {"Waits per Execution (ms)": 6},
)
CHECKS["w4_previous_period"] = Check(
    lambda f: TI.previous_date(
        ["Total Executions"], f.table(S.INTERVAL), ["TenantName"], months=3,
        runtime=f.table(S.RUNTIME)),
    """SELECT TenantName, IntervalDate, c.n AS "Total Executions", p.n AS "Previous Total Executions"
      FROM daily c LEFT JOIN (SELECT TenantName, CAST(IntervalDate + INTERVAL 3 MONTH AS DATE) AS IntervalDate, n FROM daily) p
        USING (TenantName, IntervalDate)""",
    ["frd"], {},
    {"daily": "SELECT TenantName, IntervalDate, CAST(sum(CountExecutions) AS BIGINT) AS n FROM frd GROUP BY 1, 2"},
)
CHECKS["w7_current"] = Check(
    lambda f: M.evaluate(
        ["Total Executions"], ["TenantName", TI.DATE], runtime=f.table(S.RUNTIME),
        dates=TI.date_lookup(f.table(S.INTERVAL))),
    """SELECT TenantName, IntervalDate, CAST(sum(CountExecutions) AS BIGINT) AS "Total Executions"
      FROM frd GROUP BY 1, 2""", ["frd"],
)
CHECKS["w2_rank_within_host"] = Check(
    lambda f: M.rank_queries(
        f.table(S.RUNTIME), "Max Duration (ms)", "Rank", within=[*HOST, "DatabaseName"]
    ).select(*QUERY_KEY, "Rank"),
    f"""SELECT {QK}, rank() OVER (PARTITION BY {K} ORDER BY v DESC) AS "Rank"
      FROM (SELECT {QK}, max(MaxDurationMs) AS v FROM fr GROUP BY {QK})""", ["fr"],
)
