"""Measures over time: to-date totals, previous periods, period changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from plandrift.functions.columns import divide
from plandrift.functions.measures import (
    BOTH, MEASURES, PLANS_SEEN, RUNTIME, WAIT, _merge_sql, _states, as_fact, evaluate, finish,
    per_interval,
)
from plandrift.schemas import INTERVAL_KEY, QUERY_KEY

PERIODS = ("day", "week", "month", "quarter", "year")
DATE = "IntervalDate"


def date_lookup(intervals: DataFrame) -> DataFrame:
    """The date of every interval."""
    return intervals.select(*INTERVAL_KEY, F.to_date("IntervalStartTime").alias(DATE))


def _period_start(period: str, date: str = DATE):
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    return F.to_date(F.date_trunc(period, F.col(date)))


def _dated(daily: DataFrame) -> DataFrame:
    """Stored daily states whose date is known."""
    return daily.filter(F.col(DATE).isNotNull())


def to_date(
    names: Sequence[str],
    period: str,
    intervals: DataFrame | None = None,
    by: Sequence[str] = (),
    runtime: DataFrame | None = None,
    waits: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Measures accumulated from the start of the period to each date with data.

    Sums and maxima accumulate directly. A per-query figure changes only on
    dates the query has rows, so each query contributes the *change* of its
    figure on those dates and the changes are accumulated. Distinct values are
    counted on the first date they appear in the period. Every step is linear
    in the daily rows; no date is joined with the dates before it. With ``daily``,
    the stored daily states, neither runtime rows nor intervals are read.
    """
    measures = [MEASURES[n] for n in names]
    keys = list(by) or ["_all"]
    in_period = lambda df: df.withColumn("_period", _period_start(period))
    parts = []
    for kind, fact in ((RUNTIME, runtime), (WAIT, waits)):
        if any(m.fact in (kind, BOTH) for m in measures):
            stored = kind == RUNTIME and daily is not None
            fact = in_period(_dated(daily)) if stored else as_fact(fact, kind)
            if not by:
                fact = fact.withColumn("_all", F.lit(1))
            dates = None if stored else in_period(date_lookup(intervals))
            parts.append(_daily_changes(fact, measures, kind, [*keys, "_period"], dates))
    grain = [*keys, "_period", DATE]
    days = parts[0] if len(parts) == 1 else parts[0].join(parts[1], grain, "full_outer")

    so_far = (
        Window.partitionBy(*keys, "_period").orderBy(DATE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = [
        (F.max(c) if c.startswith("max_") else F.sum(c)).over(so_far).alias(c)
        for c in days.columns if c not in grain
    ]
    return finish(days.select(*grain, *totals), names, [*by, DATE])


def _daily_changes(
    fact: DataFrame, measures, kind: str, keys: list[str], dates: DataFrame | None
) -> DataFrame:
    """Per group and date: daily states and daily changes of non-additive figures.

    Without ``dates``, ``fact`` holds daily states per plan already. Rows meet once per
    query: the shuffle by query serves the plans' first days and all running values.
    """
    mine = [m for m in measures if m.fact in (kind, BOTH)]
    states = _states(mine, kind) or {"_rows": "count(1)"}
    per_query = {k: v for m in mine for k, v in m.per_query.items()}
    distinct = {k: v for m in mine for k, v in m.distinct.items()}
    merge = [F.expr(_merge_sql(name)).alias(name) for name in states]
    if "_rows" in states and dates is None:
        fact = fact.withColumn("_rows", F.lit(1).cast("long"))
    if not per_query and not distinct:
        reduced = fact if dates is None else per_interval(fact, states, [*keys, DATE], dates)
        return reduced.groupBy(*keys, DATE).agg(*merge)

    query = list(dict.fromkeys([*keys, *QUERY_KEY]))
    needs_plans = any(PLANS_SEEN in sql for sql in per_query.values())
    grain = [*query, *(["PlanId"] if needs_plans else [])]
    if dates is not None:
        fact = fact.join(dates, INTERVAL_KEY).groupBy(*grain, DATE).agg(
            *[F.expr(sql).alias(n) for n, sql in states.items()])
    # One exchange: whatever groups or orders by query below finds its rows together.
    daily = fact.select(*grain, DATE, *states).repartition(*query)
    if needs_plans:
        daily = daily.groupBy(*grain, DATE).agg(*merge)
        first_day = F.min(DATE).over(Window.partitionBy(*grain))
        daily = daily.withColumn("_new", (F.col(DATE) == first_day).cast("long"))
        merge.append(F.sum("_new").alias(PLANS_SEEN))
    daily = daily.groupBy(*query, DATE).agg(*merge)

    in_query = Window.partitionBy(*query).orderBy(DATE)
    so_far = in_query.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {
        c: (F.max(c) if c.startswith("max_") else F.sum(c)).over(so_far)
        for c in daily.columns if c not in (*query, DATE)
    }
    # Daily states keep a "_day_" copy; the plain names become running values.
    daily = daily.withColumns({f"_day_{c}": F.col(c) for c in states}).withColumns(running)
    daily = daily.withColumns({name: F.expr(sql) for name, sql in per_query.items()})
    changes = {
        f"_change_{name}": F.col(name) - F.coalesce(F.lag(name).over(in_query), F.lit(0))
        for name in per_query
    }
    daily = daily.withColumns(changes)
    result = daily.groupBy(*keys, DATE).agg(
        *[
            (F.max if c.startswith("max_") else F.sum)(f"_day_{c}").alias(c) for c in states
        ],
        *[F.sum(f"_change_{name}").alias(name) for name in per_query],
    )
    for name, sql in distinct.items():
        appears = (
            daily.withColumn("_value", F.expr(sql)).filter(F.col("_value").isNotNull())
            .groupBy(*keys, "_value").agg(F.min(DATE).alias(DATE))
            .groupBy(*keys, DATE).agg(F.count(F.lit(1)).alias(name))
        )
        result = result.join(appears, [*keys, DATE], "left").fillna(0, [name])
    return result


def previous_date(
    names: Sequence[str],
    intervals: DataFrame,
    by: Sequence[str] = (),
    months: int = 0,
    days: int = 0,
    runtime: DataFrame | None = None,
    waits: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Daily measures next to their values the given months or days earlier.

    ``daily`` are stored daily states, to be read in place of runtime rows.
    """
    stored = None if daily is None else _dated(daily)
    values = evaluate(names, [*by, DATE], runtime, waits, date_lookup(intervals), stored)
    earlier = values.select(
        *by, F.col(DATE).alias("_earlier"), *[F.col(n).alias(f"Previous {n}") for n in names]
    )
    shifted = F.add_months(F.col(DATE), -months) if months else F.date_sub(F.col(DATE), days)
    return (
        values.withColumn("_earlier", shifted)
        .join(earlier, [*by, "_earlier"], "left")
        .drop("_earlier")
    )


def duration_improvement(
    runtime: DataFrame, intervals: DataFrame, by: Sequence[str] = (), days: int = 30
) -> DataFrame:
    """How much the average duration fell against ``days`` earlier, in percent."""
    name = "Avg Duration (seconds)"
    both = previous_date([name], intervals, by, days=days, runtime=runtime)
    before, now = F.col(f"Previous {name}"), F.col(name)
    change = F.try_divide(before - now, before) * 100
    return both.select(*by, DATE, name, f"Previous {name}", change.alias("Duration Improvement %"))


def period_change(
    names: dict[str, str],
    period: str,
    intervals: DataFrame,
    by: Sequence[str] = (),
    runtime: DataFrame | None = None,
    waits: DataFrame | None = None,
    also: Sequence[str] = (),
    daily: DataFrame | None = None,
) -> DataFrame:
    """Change of measures against the period before, in percent.

    ``names`` maps a measure to the name of its change. Periods without data
    between the first and last of a group are filled in, so "the period
    before" is always the adjacent one: no change is reported after a gap, and
    a period without data itself counts as zero. ``daily`` are stored daily states,
    to be read in place of runtime rows.
    """
    wanted = [*names, *also]

    dates = date_lookup(intervals).withColumn("Period", _period_start(period))
    stored = None if daily is None else _dated(daily).withColumn("Period", _period_start(period))
    values = evaluate(wanted, [*by, "Period"], runtime, waits, dates, stored)
    keys = list(by) or ["_all"]
    if not by:
        values = values.withColumn("_all", F.lit(1))
    step = F.expr(f"INTERVAL {'3 MONTH' if period == 'quarter' else '1 ' + period.upper()}")
    calendar = values.groupBy(*keys).agg(
        F.min("Period").alias("_from"), F.max("Period").alias("_to")
    ).select(*keys, F.explode(F.sequence("_from", "_to", step)).alias("Period"))
    filled = calendar.join(values, [*keys, "Period"], "left")
    in_order = Window.partitionBy(*keys).orderBy("Period")
    changes = []
    for measure, label in names.items():
        before = F.lag(measure).over(in_order)
        now = F.coalesce(F.col(measure), F.lit(0))
        changes.append(
            F.when(before.isNotNull(), divide(now - before, before, 0) * 100).alias(label)
        )
    return filled.select(*by, "Period", *wanted, *changes)


# The three comparison measures and what they compare.
CHANGES = {
    "Avg Duration (seconds)": "Duration Change (%)",
    "Avg CPU Time (seconds)": "CPU Change (%)",
    "Total Executions": "Execution Count Change (%)",
}


def regression_risk(
    runtime: DataFrame | None, intervals: DataFrame, period: str = "month", by: Sequence[str] = (),
    daily: DataFrame | None = None,
) -> DataFrame:
    """Risk score per period: regressions weigh ten, a tenth of the duration change adds."""
    parts = period_change(
        {"Avg Duration (seconds)": "Duration Change (%)"}, period, intervals, by,
        runtime=runtime, also=["Plan Instability Count", "Regression Count"], daily=daily,
    )
    score = F.coalesce(F.col("Regression Count"), F.lit(0)) * 10 + F.coalesce(
        F.col("Duration Change (%)"), F.lit(0.0)
    ) / 10
    return parts.select(
        *by, "Period", "Plan Instability Count", "Regression Count", "Duration Change (%)",
        F.when(F.col("Plan Instability Count") > 0, score).otherwise(F.lit(0.0))
        .alias("Regression Risk Score"),
    )
