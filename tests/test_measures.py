import datetime as dt

import pytest
from pyspark.sql import functions as F

from plandrift import schemas as S
from plandrift.functions import measures as M, time_intelligence as TI


@pytest.fixture(scope="module")
def demo(make, runtime):
    """The one-row example model with its known results."""
    rt = runtime(("DemoTenant", 1, 1, 1, 125.5, {
        "CountExecutions": 10, "AvgCpuTimeMs": 42.2, "AvgLogicalIoReads": 18, "AvgLogicalIoWrites": 4}))
    waits = make(S.WAIT, [{
        "TenantName": "DemoTenant", "ServerName": "s", "DatabaseName": "d", "QueryId": 1,
        "PlanId": 1, "WaitCategory": "CPU", "TotalWaitTimeMs": 850, "AvgWaitTimeMs": 85.0,
        "CountWaits": 10}])
    return rt, waits


@pytest.mark.parametrize("name, value", [
    ("Total Executions", 10), ("Avg Duration (ms)", 125.5), ("Total CPU (ms)", 422.0),
    ("CPU per Execution (ms)", 42.2), ("Total Wait (ms)", 850), ("Waits per Execution (ms)", 85.0),
    ("Regression Rate %", 0.0), ("CPU Wait %", 100.0), ("IO Wait %", None),
    ("Avg IO per Execution", 22.0), ("Regression Count", None),
])
def test_example_model(demo, name, value):
    got = M.evaluate([name], runtime=demo[0], waits=demo[1]).first()[0]
    assert got == (pytest.approx(value) if value is not None else None)


def test_hours_are_summed_per_query(runtime):
    """Two queries: 2 x 3600 s and 4 x 1800 s, not the product of the totals."""
    rt = runtime(
        ("A", 1, 1, 1, 3_600_000.0, {"CountExecutions": 2}),
        ("A", 2, 2, 1, 1_800_000.0, {"CountExecutions": 4}))
    assert M.evaluate(["Total Elapsed Hours"], runtime=rt).first()[0] == pytest.approx(4.0)


def test_instability_counts_plans_of_each_query(runtime):
    rows = [("A", 1, p, 1, 1.0) for p in range(4)] + [("A", 2, p, 1, 1.0) for p in (10, 11)]
    got = M.evaluate(["Plan Instability Count", "Avg Plans per Query"], runtime=runtime(*rows)).first()
    assert tuple(got) == (1, 3.0)


def test_cross_fact_ratio_does_not_fan_out(make, runtime):
    rt = runtime(*[("A", 1, p, 1, 1.0, {"CountExecutions": 5}) for p in (1, 2)])
    wait = {"TenantName": "A", "ServerName": "s", "DatabaseName": "d", "QueryId": 1}
    waits = make(S.WAIT, [{**wait, "PlanId": p, "TotalWaitTimeMs": 50} for p in (1, 2, 3)])
    assert M.evaluate(["Waits per Execution (ms)"], ["TenantName"], rt, waits).first()[1] == 15.0


def test_group_on_one_side_only_is_kept(make, runtime):
    waits = make(S.WAIT, [{"TenantName": "B", "ServerName": "s", "DatabaseName": "d"}])
    rows = M.evaluate(
        ["Total Executions", "Total Wait (ms)"], ["TenantName"], runtime(("A", 1, 1, 1, 1.0)), waits)
    assert {tuple(r) for r in rows.collect()} == {("A", 1, None), ("B", None, 1)}


def test_grouping_by_columns_inside_and_outside_the_query_key(runtime):
    rows = runtime(("A", 1, 1, 1, 2000.0), ("A", 1, 1, 2, 1.0), ("A", 2, 2, 1, 5000.0))
    got = M.evaluate(
        ["Slow Query Count (>1s)", "Total Executions"], ["QueryId", "RuntimeStatsIntervalId"],
        runtime=rows)
    assert {tuple(r) for r in got.collect()} == {(1, 1, 1, 1), (1, 2, 0, 1), (2, 1, 1, 1)}


def _dated(make, days):
    """An interval table whose ids are day numbers."""
    return make(S.INTERVAL, [
        {"TenantName": "A", "ServerName": "s", "RuntimeStatsIntervalId": n,
         "IntervalStartTime": dt.datetime.combine(day, dt.time(6))}
        for n, day in enumerate(days)
    ])


def test_to_date_counts_queries_once_per_period(make, runtime):
    days = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    rt = runtime(("A", 1, 1, 0, 2000.0), ("A", 1, 1, 1, 2000.0), ("A", 2, 2, 1, 3000.0),
                 ("A", 1, 1, 2, 1.0))
    got = TI.to_date(
        ["Slow Query Count (>1s)", "Total Executions", "Avg Plans per Query"], "month",
        _dated(make, days), runtime=rt)
    rows = [tuple(r) for r in got.orderBy("IntervalDate").collect()]
    assert rows == [(days[0], 1, 1, 1.0), (days[1], 2, 3, 1.0), (days[2], 0, 1, 1.0)]


def test_previous_month_clips_to_month_end(make, runtime):
    days = [dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    rt = runtime(("A", 1, 1, 0, 1.0), ("A", 1, 1, 1, 1.0, {"CountExecutions": 4}))
    got = TI.previous_date(["Total Executions"], _dated(make, days), months=1, runtime=rt)
    rows = {r.IntervalDate: tuple(r)[1:] for r in got.collect()}
    assert rows == {days[0]: (1, None), days[1]: (4, 1)}


def test_period_change_over_a_gap(make, runtime):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 4)]
    rt = runtime(*[("A", 1, 1, n, 1.0, {"CountExecutions": c}) for n, c in ((0, 10), (1, 15), (2, 9))])
    got = TI.period_change({"Total Executions": "Change"}, "day", _dated(make, days), runtime=rt)
    rows = [(r.Period.day, r["Total Executions"], r.Change) for r in got.orderBy("Period").collect()]
    assert rows == [(1, 10, None), (2, 15, 50.0), (3, None, -100.0), (4, 9, None)]


def test_unknown_period_is_refused():
    with pytest.raises(ValueError):
        TI._period_start("fortnight")


def test_risk_is_zero_without_unstable_queries(make, runtime):
    rt = runtime(("A", 1, 1, 0, 1.0, {"IsRegression": True}))
    risk = TI.regression_risk(rt, _dated(make, [dt.date(2024, 1, 1)]), "day").first()
    assert risk["Regression Risk Score"] == 0.0 and risk["Regression Count"] == 1


def test_server_variance(runtime):
    rt = runtime(("A", 1, 1, 1, 1000.0), ("A", 1, 1, 1, 3000.0, {"ServerName": "other"}))
    assert M.server_duration_variance(rt).first()[0] == pytest.approx(1.0)


def test_simple_measures_need_one_shuffle(runtime):
    df = M.evaluate(["Avg Duration (ms)", "Total Executions"], ["TenantName"],
                    runtime=runtime(("A", 1, 1, 1, 1.0)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan


def test_query_counts_run_without_expanding_facts(runtime):
    names = [n for n in M.MEASURES if "Query Count (" in n or n == "Critical Query Count"]
    df = M.evaluate(names, ["TenantName"], runtime=runtime(("A", 1, 1, 1, 1.0)))
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.agg(F.count("*")).first()[0] == 1
