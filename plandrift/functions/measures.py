"""KPI measures and their evaluation over any grouping.

A measure is described by mergeable *states* (sums, counts, maxima of a fact's
columns) and a final expression over them. States can be combined at any
grain, which lets one pass over the facts serve many measures:

facts -> one row per plan -> one row per query -> one row per group

Counts of queries with some property become sums of per-query flags on the way,
so no distinct aggregation ever runs over raw facts. The steps that no
requested measure needs are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from plandrift.functions.columns import wait_category_group, wait_minutes
from plandrift.functions.ranking import count_top, rank_desc
from plandrift.schemas import INTERVAL_KEY, QUERY_KEY

RUNTIME, WAIT, BOTH = "runtime", "wait", "both"


@dataclass(frozen=True)
class Measure:
    """``states`` are SQL aggregates over fact rows, by state name.

    ``per_query`` are SQL expressions over the states of one query, summed over
    the queries of a group. ``distinct`` are columns whose distinct values are
    counted. ``final`` combines all of these by name.
    """

    fact: str
    final: str
    states: dict[str, str] = field(default_factory=dict)
    per_query: dict[str, str] = field(default_factory=dict)
    distinct: dict[str, str] = field(default_factory=dict)


def ratio(top: str, bottom: str, alternate: str = "NULL") -> str:
    """SQL for a ratio that yields ``alternate`` on a zero or missing denominator."""
    return (
        f"CASE WHEN {bottom} IS NULL OR {bottom} = 0 THEN CAST({alternate} AS DOUBLE) "
        f"ELSE CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) END"
    )


def _sum(column: str) -> dict[str, str]:
    return {f"sum_{column}": f"sum({column})"}


def _mean_states(column: str) -> dict[str, str]:
    return {**_sum(column), f"count_{column}": f"count({column})"}


def _mean_sql(column: str) -> str:
    return ratio(f"sum_{column}", f"count_{column}")


def mean(column: str, fact: str = RUNTIME) -> Measure:
    return Measure(fact, _mean_sql(column), _mean_states(column))


def total(column: str, fact: str = RUNTIME) -> Measure:
    return Measure(fact, f"sum_{column}", _sum(column))


def peak(column: str, fact: str = RUNTIME) -> Measure:
    return Measure(fact, f"max_{column}", {f"max_{column}": f"max({column})"})


def queries_with(name: str, condition: str) -> Measure:
    """Number of queries with at least one fact row meeting ``condition``."""
    return Measure(
        RUNTIME, f"n_{name}",
        states={f"max_{name}": f"max(CASE WHEN {condition} THEN 1 ELSE 0 END)"},
        per_query={f"n_{name}": f"CAST(max_{name} AS BIGINT)"},
    )


def distinct_values(column: str) -> Measure:
    return Measure(RUNTIME, f"distinct_{column}", distinct={f"distinct_{column}": column})


def wait_share(name: str, group: str) -> Measure:
    """Percentage of wait minutes that fall into one wait group."""
    part = f"sum_{name}_minutes"
    return Measure(
        WAIT, f"({ratio(part, 'sum_TotalWaitTimeMinutes', '0')}) * 100",
        {part: f"sum(CASE WHEN WaitCategoryGroup = '{group}' THEN TotalWaitTimeMinutes END)",
         **_sum("TotalWaitTimeMinutes")},
    )


def _hours(metric: str) -> Measure:
    """Per query: executions times the mean metric, in hours; then summed."""
    name = f"hours_{metric}"
    return Measure(
        RUNTIME, name,
        states={**_sum("CountExecutions"), **_mean_states(metric)},
        per_query={name: f"sum_CountExecutions * ({_mean_sql(metric)}) / 1000.0D / 3600.0D"},
    )


_REGRESSED_ROWS = {"sum_regressed_rows": "sum(CASE WHEN IsRegression THEN 1 END)"}
_QUERY_COUNT = {"n_queries": "CAST(1 AS BIGINT)"}
_WEIGHTED_CPU = {"sum_weighted_cpu": "sum(AvgCpuTimeMs * CountExecutions)"}
_REGRESSED_IDS = {"distinct_regressed_ids": "CASE WHEN max_regressed = 1 THEN QueryId END"}
_REGRESSED_FLAG = {"max_regressed": "max(CASE WHEN IsRegression THEN 1 ELSE 0 END)"}
_ALL_IDS = {"distinct_QueryId": "QueryId"}
PLANS_SEEN = "n_plans"

MEASURES: dict[str, Measure] = {
    "Avg Duration (seconds)": mean("AvgDurationSeconds"),
    "Max Duration (ms)": peak("MaxDurationMs"),
    "Total Executions": total("CountExecutions"),
    "Avg CPU Time (seconds)": mean("AvgCpuTimeSeconds"),
    "Max CPU Time (ms)": peak("MaxCpuTimeMs"),
    "Avg Logical Reads": mean("AvgLogicalIoReads"),
    "Avg Physical Reads": mean("AvgPhysicalIoReads"),
    "Avg Memory (MB)": mean("AvgMemoryUsedMb"),
    "Avg Duration (ms)": mean("AvgDurationMs"),
    "Total CPU Hours": _hours("AvgCpuTimeMs"),
    "Total Elapsed Hours": _hours("AvgDurationMs"),
    "Total Wait Time (minutes)": total("TotalWaitTimeMinutes", WAIT),
    "Wait Time by Category (hours)": Measure(
        WAIT, "sum_TotalWaitTimeMinutes / 60.0D", _sum("TotalWaitTimeMinutes")
    ),
    "CPU Wait %": wait_share("cpu", "CPU Contention"),
    "Memory Wait %": wait_share("memory", "Memory Pressure"),
    "IO Wait %": wait_share("io", "IO Contention"),
    "Avg Wait Time (ms)": mean("AvgWaitTimeMs", WAIT),
    "Max Wait Time (ms)": peak("MaxWaitTimeMs", WAIT),
    "Regression Count": Measure(RUNTIME, "sum_regressed_rows", _REGRESSED_ROWS),
    "Regression % of Queries": Measure(
        RUNTIME, f"({ratio('sum_regressed_rows', 'n_queries', '0')}) * 100",
        _REGRESSED_ROWS, _QUERY_COUNT,
    ),
    "Avg Plans per Query": Measure(
        RUNTIME, ratio("sum_plans", "n_queries", "0"),
        per_query={"sum_plans": PLANS_SEEN, **_QUERY_COUNT},
    ),
    "CPU % of Elapsed": Measure(
        RUNTIME, f"({ratio('sum_AvgCpuTimeMs', 'sum_AvgDurationMs', '0')}) * 100",
        {**_sum("AvgCpuTimeMs"), **_sum("AvgDurationMs")},
    ),
    "Avg Rows per Execution": mean("AvgRowCount"),
    "Avg IO per Execution": Measure(
        RUNTIME, f"({_mean_sql('AvgLogicalIoReads')}) + ({_mean_sql('AvgLogicalIoWrites')})",
        {**_mean_states("AvgLogicalIoReads"), **_mean_states("AvgLogicalIoWrites")},
    ),
    "Avg Memory per Execution (MB)": mean("AvgMemoryUsedMb"),
    "Slow Query Count (>1s)": queries_with("slow", "AvgDurationMs > 1000"),
    "High Memory Query Count (>100MB)": queries_with("high_memory", "AvgMemoryUsedMb > 100"),
    "High IO Query Count (>10K reads)": queries_with("high_io", "AvgLogicalIoReads > 10000"),
    "Plan Instability Count": Measure(
        RUNTIME, "n_unstable",
        per_query={"n_unstable": f"CAST({PLANS_SEEN} > 3 AS BIGINT)"},
    ),
    "Server Count": distinct_values("ServerName"),
    "Database Count": distinct_values("DatabaseName"),
    "Tenant Count": distinct_values("TenantName"),
    "Critical Query Count": queries_with(
        "critical", "AvgDurationMs > 1000 AND AvgCpuTimeMs > 500 AND AvgMemoryUsedMb > 100"
    ),
    "Index Review Candidates": queries_with(
        "index_review", "AvgLogicalIoReads > 10000 AND AvgRowCount < 100"
    ),
    "Total CPU (ms)": Measure(RUNTIME, "sum_weighted_cpu", _WEIGHTED_CPU),
    "CPU per Execution (ms)": Measure(
        RUNTIME, ratio("sum_weighted_cpu", "sum_CountExecutions"),
        {**_WEIGHTED_CPU, **_sum("CountExecutions")},
    ),
    "Avg Logical Writes": mean("AvgLogicalIoWrites"),
    "Regression Query Count": Measure(
        RUNTIME, "distinct_regressed_ids", _REGRESSED_FLAG, distinct=_REGRESSED_IDS
    ),
    "Regression Rate %": Measure(
        RUNTIME, ratio("distinct_regressed_ids", "distinct_QueryId"),
        _REGRESSED_FLAG, distinct={**_REGRESSED_IDS, **_ALL_IDS},
    ),
    "Total Wait (ms)": total("TotalWaitTimeMs", WAIT),
    "Avg Wait (ms)": mean("AvgWaitTimeMs", WAIT),
    "Waits per Execution (ms)": Measure(
        BOTH, ratio("sum_TotalWaitTimeMs", "sum_CountExecutions"),
        {**_sum("TotalWaitTimeMs"), **_sum("CountExecutions")},
    ),
}

# The measures each audience sees.
EXECUTIVE = [
    "Total Executions", "Avg Duration (ms)", "Total CPU (ms)", "CPU per Execution (ms)",
    "Regression Query Count", "Regression Rate %", "Total Wait (ms)", "Waits per Execution (ms)",
]
OPERATIONS = [
    "Total Executions", "Avg Duration (ms)", "Avg Logical Reads", "Avg Logical Writes",
    "Regression Query Count", "Total Wait (ms)", "Avg Wait (ms)", "Waits per Execution (ms)",
]

_WAIT_STATES = {name for m in MEASURES.values() if m.fact == WAIT for name in m.states}


def _merge_sql(state: str) -> str:
    return f"max({state})" if state.startswith("max_") else f"sum({state})"


def _states(measures: Sequence[Measure], fact: str) -> dict[str, str]:
    """States of ``fact`` that the measures need; cross-fact ones are split up."""
    wanted = {}
    for m in measures:
        for name, sql in m.states.items():
            owner = m.fact if m.fact != BOTH else (WAIT if name in _WAIT_STATES else RUNTIME)
            if owner == fact:
                wanted[name] = sql
    return wanted


def fact_states(kind: str) -> dict[str, str]:
    """The states of all measures of a fact: what a stored roll-up has to hold."""
    return _states(list(MEASURES.values()), kind)


def group_states(
    fact: DataFrame,
    measures: Sequence[Measure],
    kind: str,
    by: Sequence[str],
    dates: DataFrame | None = None,
    rolled_up: bool = False,
) -> DataFrame:
    """All states, per-query sums and distinct counts of the measures, per group.

    With ``dates``, grouping columns may come from there. Figures that do not
    depend on single queries are reduced per interval before the dates are joined.
    ``rolled_up`` says that ``fact`` holds states per plan already, and no fact rows.
    """
    mine = [m for m in measures if m.fact in (kind, BOTH)]
    states = _states(mine, kind) or {"_rows": "count(1)"}
    per_query = {k: v for m in mine for k, v in m.per_query.items()}
    distinct = {k: v for m in mine for k, v in m.distinct.items()}
    needs_plans = any(PLANS_SEEN in sql for sql in per_query.values())
    merge = [F.expr(_merge_sql(name)).alias(name) for name in states]
    first = [F.expr(sql).alias(name) for name, sql in states.items()]
    if rolled_up:
        first = merge if _states(mine, kind) else first

    by_query = bool(per_query or distinct)
    grain = list(dict.fromkeys([*by, *(QUERY_KEY if by_query else ())]))
    plan_grain = list(dict.fromkeys([*grain, *(["PlanId"] if needs_plans else ())]))
    if dates is not None and by_query:
        # Per query and interval there is next to nothing to reduce beforehand.
        fact = fact.join(dates, INTERVAL_KEY)
    elif dates is not None:
        fact, first = per_interval(fact, states, plan_grain, dates), merge

    if not by_query:
        return fact.groupBy(*by).agg(*first)
    queries = fact.groupBy(*plan_grain).agg(*first)
    if needs_plans:
        queries = queries.groupBy(*grain).agg(*merge, F.count_distinct("PlanId").alias(PLANS_SEEN))
    return queries.groupBy(*by).agg(
        *merge,
        *[F.expr(f"sum({sql})").alias(name) for name, sql in per_query.items()],
        *[F.expr(f"count(DISTINCT {sql})").alias(name) for name, sql in distinct.items()],
    )


def per_interval(
    fact: DataFrame, states: dict[str, str], grain: Sequence[str], dates: DataFrame
) -> DataFrame:
    """States per interval within ``grain``, with the columns of ``dates`` added.

    Joining the dates to already reduced rows keeps the facts themselves out of
    the join, however many intervals there are.
    """
    own = [c for c in grain if c in INTERVAL_KEY or c not in dates.columns]
    reduced = fact.groupBy(*dict.fromkeys([*own, *INTERVAL_KEY])).agg(
        *[F.expr(sql).alias(name) for name, sql in states.items()]
    )
    return reduced.join(dates, INTERVAL_KEY)


def finish(states: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Apply the final expressions; output columns carry the measure names."""
    return states.select(*keep, *[F.expr(MEASURES[n].final).alias(n) for n in names])


def evaluate(
    names: Sequence[str],
    by: Sequence[str] = (),
    runtime: DataFrame | None = None,
    waits: DataFrame | None = None,
    dates: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Evaluate measures per group of ``by`` (the filter context of a report cell).

    ``runtime`` and ``waits`` are base tables or facts already sliced; only the
    facts the measures use need to be given. Each fact is aggregated before the
    two are joined, so neither multiplies the rows of the other. ``dates`` maps
    the interval key to further grouping columns. ``daily`` are stored daily states
    (``operators.rollup``) in place of runtime rows; their grouping columns, dates
    included, must be among their own.
    """
    measures = [MEASURES[n] for n in names]
    parts = [
        group_states(daily, measures, kind, by, rolled_up=True) if kind == RUNTIME and daily is not None
        else group_states(as_fact(fact, kind), measures, kind, by, dates)
        for kind, fact in ((RUNTIME, runtime), (WAIT, waits))
        if any(m.fact in (kind, BOTH) for m in measures)
    ]
    if len(parts) == 1:
        joined = parts[0]
    elif by:
        joined = parts[0].join(parts[1], list(by), "full_outer")
    else:
        # Two single rows: stacked and folded into one.
        both = parts[0].unionByName(parts[1], allowMissingColumns=True)
        joined = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return finish(joined, names, list(by))


def as_fact(df: DataFrame, kind: str) -> DataFrame:
    """Add the derived columns measures refer to, unless they are there already."""
    thousand = F.lit(1000.0)
    derived = {
        RUNTIME: {
            "AvgDurationSeconds": lambda: F.col("AvgDurationMs") / thousand,
            "AvgCpuTimeSeconds": lambda: F.col("AvgCpuTimeMs") / thousand,
        },
        WAIT: {
            "TotalWaitTimeMinutes": lambda: wait_minutes(),
            "WaitCategoryGroup": lambda: wait_category_group(F.col("WaitCategory")),
        },
    }[kind]
    missing = {name: make() for name, make in derived.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def server_duration_variance(runtime: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared distance of the servers' average duration from the overall one."""
    seconds = F.col("AvgDurationMs") / F.lit(1000.0)
    servers = runtime.groupBy(*by, "ServerName").agg(
        F.sum(seconds).alias("s"), F.count(seconds).alias("n")
    )
    overall = servers.groupBy(*by).agg((F.sum("s") / F.sum("n")).alias("overall"))
    compared = (
        servers.join(overall, list(by)) if by
        else servers.withColumn("overall", overall.scalar())
    )
    distance = F.pow(F.col("overall") - F.col("s") / F.col("n"), F.lit(2.0))
    return compared.groupBy(*by).agg(F.avg(distance).alias("Server Duration Variance"))


def rank_queries(
    runtime: DataFrame, measure: str, name: str, dense: bool = False, within: Sequence[str] = ()
) -> DataFrame:
    """Queries with a measure and their rank by it, highest first."""
    per_query = evaluate([measure], QUERY_KEY, runtime=runtime)
    return rank_desc(per_query, measure, name, dense, within)


def operations_by_query(runtime: DataFrame, waits: DataFrame) -> DataFrame:
    """The operations bundle per query, with the query's rank by duration."""
    bundle = evaluate(OPERATIONS, QUERY_KEY, runtime=runtime, waits=waits)
    return rank_desc(bundle, "Avg Duration (ms)", "Top Query Rank by Duration", dense=True)


def top_queries_count(runtime: DataFrame, n: int = 10) -> DataFrame:
    """Size of the top ``n`` queries by average duration; ties can make it larger."""
    return count_top(evaluate(["Avg Duration (seconds)"], QUERY_KEY, runtime=runtime),
                     "Avg Duration (seconds)", n)
