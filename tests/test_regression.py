from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from plandrift.operators import regression as R
from plandrift.schemas import QUERY_KEY

AS_OF = "2024-03-10 12:00:00"


def brute_force(rows, threshold):
    """Every pair of rows, as the definition reads."""
    pairs = {}
    for (t, q, p, i, d, *_), (t2, q2, p2, i2, d2, *_) in product(rows, rows):
        if (t, q) == (t2, q2) and p != p2 and i < i2:
            pairs.setdefault((t, q, p, p2), []).append((d, d2))
    found = {}
    for key, values in pairs.items():
        old = sum(v[0] for v in values) / len(values)
        new = sum(v[1] for v in values) / len(values)
        if old and (new - old) / old > threshold:
            found[key] = (old, new)
    return found


def detected(frame):
    return {
        (r.TenantName, r.QueryId, r.OldPlanId, r.NewPlanId): (r.OldAvgDurationMs, r.NewAvgDurationMs)
        for r in frame.collect()
    }


row = st.tuples(
    st.sampled_from(["A", "B"]), st.integers(1, 2), st.integers(1, 4), st.integers(1, 6),
    st.integers(0, 40).map(lambda n: n / 4),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, max_size=30), threshold=st.sampled_from([0.25, 1.0, -0.5]))
def test_agrees_with_all_row_pairs(runtime, rows, threshold):
    # Several rows of a plan in one interval differ in their execution type.
    rows = [(*r, {"ExecutionType": n}) for n, r in enumerate(rows)]
    expected = brute_force(rows, threshold)
    for intervals_per_bucket in (1, 2, 100):
        got = detected(R.detect_plan_regressions(
            runtime(*rows), None, AS_OF, threshold, intervals_per_bucket))
        assert got.keys() == expected.keys()
        for key, (old, new) in expected.items():
            assert got[key] == pytest.approx((old, new))


def test_buckets_of_any_width_give_the_same_pairs(runtime):
    rows = [("A", 1, plan, interval, float(plan * 10 + interval))
            for plan in range(1, 31) for interval in (1, 2, 3, 250, 251, 900)]
    whole = detected(R.plan_pair_averages(runtime(*rows), -1.0, 1000))
    assert len(whole) == 30 * 29
    for width in (1, 2, 100):
        split = detected(R.plan_pair_averages(runtime(*rows), -1.0, width))
        assert split.keys() == whole.keys()
        assert all(split[pair] == pytest.approx(whole[pair]) for pair in whole)


def test_a_state_holds_no_more_than_its_bucket(runtime):
    """However long the history of a plan: its rows are spread over buckets."""
    rows = [("A", 1, plan, interval, float(interval), {"ExecutionType": kind})
            for plan in (1, 2) for interval in range(0, 1000, 10) for kind in (0, 1)]
    states = R.plan_states(runtime(*rows), 100).collect()
    assert len(states) == 20 and {len(s.Series) for s in states} == {20}
    assert all(s.RuntimeStatsIntervalId <= s.FirstInterval <= s.LastInterval < s.RuntimeStatsIntervalId + 100
               for s in states)
    # The old plan's last bucket and a later one of the new plan pair by totals alone.
    late = [("A", 1, 1, 5, 4.0), ("A", 1, 1, 105, 8.0), ("A", 1, 2, 720, 30.0), ("A", 1, 3, 9000, 1.0)]
    assert detected(R.plan_pair_averages(runtime(*late), 0.25)) == {("A", 1, 1, 2): (6.0, 30.0)}


def test_equal_intervals_do_not_pair(runtime):
    assert R.plan_pair_averages(runtime(("A", 1, 1, 5, 1.0), ("A", 1, 2, 5, 9.0)), -1.0).count() == 0


def test_zero_old_duration_is_no_regression(runtime):
    rows = runtime(("A", 1, 1, 1, 0.0), ("A", 1, 2, 2, 9.0))
    assert R.detect_plan_regressions(rows, None, AS_OF).count() == 0


def test_same_day_detection_is_not_repeated_but_next_day_is(runtime):
    rows = runtime(("A", 1, 1, 1, 1.0), ("A", 1, 2, 2, 2.0))
    first = R.detect_plan_regressions(rows, None, AS_OF)
    assert first.count() == 1
    assert R.detect_plan_regressions(rows, first, "2024-03-10 23:00:00").count() == 0
    assert R.detect_plan_regressions(rows, first, "2024-03-11 00:00:01").count() == 1


def test_flag_is_sticky_and_stays_within_the_tenant(runtime):
    rows = runtime(
        ("A", 1, 1, 1, 1.0), ("A", 1, 2, 2, 2.0), ("B", 1, 2, 2, 2.0),
        ("A", 7, 9, 1, 1.0, {"IsRegression": True}),
    )
    found = R.detect_plan_regressions(rows, None, AS_OF)
    flagged = R.flag_regressions(rows, found, AS_OF)
    assert {(r.TenantName, r.QueryId, r.PlanId) for r in flagged.collect() if r.IsRegression} == {
        ("A", 1, 2), ("A", 7, 9)}
    later = R.flag_regressions(flagged, found, "2024-03-12 00:00:00")
    assert later.filter("IsRegression").count() == 2


def test_mark_investigated_changes_one_row(runtime):
    rows = runtime(*[("A", q, p, p, float(p)) for q in (1, 2) for p in (1, 2)])
    found = R.detect_plan_regressions(rows, None, AS_OF)
    target = found.filter("QueryId = 1").first().RegressionId
    marked = R.mark_investigated(found, target, "index added").collect()
    assert {(r.QueryId, r.IsInvestigated, r.Notes) for r in marked} == {
        (1, True, "index added"), (2, False, None)}


def test_regression_ids_are_unique(runtime):
    rows = runtime(*[("A", q, p, p, float(p)) for q in range(20) for p in (1, 2, 3)])
    found = R.detect_plan_regressions(rows, None, AS_OF)
    assert found.select("RegressionId").distinct().count() == found.count()
    assert set(QUERY_KEY) < set(found.columns)
