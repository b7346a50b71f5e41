"""Stored merges, summaries, refreshes and conflicts: what is written, and what is left alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plandrift import schemas as S
from checks.measures import _TO_DATE as TO_DATE
from plandrift.functions import time_intelligence as TI
from plandrift.functions.measures import fact_states
from plandrift.operators import regression as R
from plandrift.operators.rollup import daily_states
from plandrift.plans import load as L
from plandrift.sources.fixture import Fixture
from plandrift.sources.warehouse import Warehouse
from plandrift.streaming.ingest import refresh_all
from tests.conftest import DATA_DIR

OLD, NEW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
DAY = dt.datetime(2024, 1, 5)


def row(**other):
    return {"TenantName": "A", "ServerName": "s", "DatabaseName": "d", **other}


def files(root, table):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in (root / table.name).rglob("*.parquet")}


def merge(make, warehouse, table, rows, as_of=NEW):
    return L.merge_table(warehouse, table, make(None, rows, table.staging_schema), as_of).collect()


@pytest.mark.parametrize(("table", "key"), [(S.QUERY_TEXT, "QueryTextId"), (S.PLAN, "PlanId"), (S.INTERVAL, "RuntimeStatsIntervalId")])
def test_tables_that_only_grow_are_never_rewritten(make, spark, tmp_path, table, key):
    warehouse = Warehouse(spark, str(tmp_path))
    first = [{k: v for k, v in row(**{key: i}, LastExecutionTime=DAY).items()} for i in range(1, 6)]
    merge(make, warehouse, table, first, OLD)
    before = files(tmp_path, table)
    later = DAY + dt.timedelta(days=3)
    again = [{**r, "LastExecutionTime": later, "QueryTextContent": "y", "IntervalDurationMinutes": 9} for r in first[3:]]
    counts = merge(make, warehouse, table, again + [row(**{key: 77}, LastExecutionTime=later)])
    after = files(tmp_path, table)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert [(c.RecordsInserted, c.RecordsUpdated) for c in counts] == [(1, 2)]
    stored = {r[key]: r for r in warehouse.read(table).collect()}
    assert set(stored) == {1, 2, 3, 4, 5, 77}
    if table is S.PLAN:
        assert {k: r.LastExecutionTime for k, r in stored.items()} == {1: DAY, 2: DAY, 3: DAY, 4: later, 5: later, 77: later}
        assert warehouse.read(S.PLAN, stored=True).filter("PlanId = 4").first().LastExecutionTime == DAY
    # The same extract once more writes nothing at all.
    merge(make, warehouse, table, again)
    assert files(tmp_path, table) == after


def test_only_id_ranges_with_changed_queries_are_rewritten(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    old = [row(QueryId=i, CompilationCount=1) for i in (1, 9_999, 10_000, 50_000)]
    merge(make, warehouse, S.QUERY, old, OLD)
    before = files(tmp_path, S.QUERY)
    counts = merge(make, warehouse, S.QUERY, [row(QueryId=1, CompilationCount=1), row(QueryId=10_000, CompilationCount=2),
                                              row(QueryId=50_001, CompilationCount=1)])
    after = files(tmp_path, S.QUERY)
    kept = {p for p in before if after.get(p) == before[p]}
    assert {p.split("/")[2] for p in kept} == {"IdBucket=0", "IdBucket=5"}
    assert [(c.RecordsInserted, c.RecordsUpdated) for c in counts] == [(1, 2)]
    got = {r.QueryId: (r.CompilationCount, str(r.LoadDate)) for r in warehouse.read(S.QUERY).collect()}
    assert got == {1: (1, OLD), 9_999: (1, OLD), 10_000: (2, OLD), 50_000: (1, OLD), 50_001: (1, NEW)}


def test_facts_without_a_change_keep_their_files(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    fact = lambda i, n: row(RuntimeStatsIntervalId=i, QueryId=1, PlanId=1, ExecutionType=0, CountExecutions=n)
    merge(make, warehouse, S.RUNTIME, [fact(50, 1), fact(150, 1)], OLD)
    before = files(tmp_path, S.RUNTIME)
    merge(make, warehouse, S.RUNTIME, [fact(50, 1), fact(150, 3), fact(250, 1)])
    after = files(tmp_path, S.RUNTIME)
    assert {p.split("/")[2] for p in before if after.get(p) == before[p]} == {"IntervalBucket=0"}
    assert sorted(r.CountExecutions for r in warehouse.read(S.RUNTIME).collect()) == [1, 1, 3]


def test_compaction_keeps_the_rows(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for i in range(4):
        merge(make, warehouse, S.QUERY_TEXT, [row(QueryTextId=i), row(QueryTextId=i, TenantName="B")][: 2 if i == 0 else 1])
    assert len(files(tmp_path, S.QUERY_TEXT)) == 5
    rows = warehouse.read(S.QUERY_TEXT).collect()
    assert warehouse.compact(S.QUERY_TEXT, 3) == [("A",)]
    assert len(files(tmp_path, S.QUERY_TEXT)) == 2
    assert sorted(warehouse.read(S.QUERY_TEXT).collect()) == sorted(rows)
    assert warehouse.compact(S.QUERY_TEXT, 3) == [] and warehouse.compact(S.QUERY) == []


def test_stored_partitions_come_from_folders(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.stored(S.RUNTIME) == []
    facts = [row(RuntimeStatsIntervalId=i, QueryId=1, PlanId=1, ExecutionType=0, TenantName=t) for i, t in ((5, "a/b=c"), (250, "A"))]
    merge(make, warehouse, S.RUNTIME, facts)
    assert warehouse.stored(S.RUNTIME) == [("A", 2), ("a/b=c", 0)]
    assert warehouse.read(S.RUNTIME, warehouse.stored(S.RUNTIME)).count() == 2


# --- summaries --------------------------------------------------------------------

def test_states_follow_from_the_rows_whoever_wrote_them(runtime, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = runtime(*[("T", 1, p, i, float(p * i)) for p in (1, 2) for i in (1, 150, 250)])
    warehouse.create(S.RUNTIME, rows.filter("RuntimeStatsIntervalId < 200"))
    L.renew_states(warehouse)
    warehouse.append(S.RUNTIME, rows.filter("RuntimeStatsIntervalId > 200"))
    L.renew_states(warehouse)
    same = lambda: sorted(map(str, warehouse.read(S.PLAN_STATE).collect())) == sorted(
        map(str, R.plan_states(warehouse.read(S.RUNTIME)).collect()))
    assert warehouse.stored(S.PLAN_STATE) == [("T", 0), ("T", 1), ("T", 2)] and same()
    warehouse.drop_partitions(S.RUNTIME, [("T", 1)])
    L.renew_states(warehouse)
    assert warehouse.stored(S.PLAN_STATE) == [("T", 0), ("T", 2)] and same()


def test_a_load_detects_over_buckets_it_does_not_read(make, spark, tmp_path):
    """The old plan ran in a bucket of its own; only its summary is needed."""
    warehouse = Warehouse(spark, str(tmp_path))

    def run(as_of, *facts):
        staging = L.Staging(spark, warehouse)
        staging.write(S.RUNTIME, make(None, [
            row(RuntimeStatsIntervalId=i, QueryId=1, PlanId=p, ExecutionType=0, AvgDurationMs=d) for i, p, d in facts],
            S.RUNTIME.staging_schema))
        return tuple(L.load(warehouse, staging, as_of).first())

    assert run(OLD, (1, 1, 10.0), (2, 1, 20.0)) == (2, 0, 0, 0)
    before = files(tmp_path, S.RUNTIME)
    assert run(NEW, (501, 2, 60.0)) == (1, 0, 1, 0)
    assert before.items() <= files(tmp_path, S.RUNTIME).items()
    found = warehouse.read(S.REGRESSION).first()
    assert (found.OldPlanId, found.NewPlanId, found.OldAvgDurationMs, found.NewAvgDurationMs) == (1, 2, 15.0, 60.0)
    assert [r.PlanId for r in warehouse.read(S.RUNTIME).filter("IsRegression").collect()] == [2]
    ids = [r.ETLControlId for r in warehouse.read(S.RUN_LOG).collect()]
    assert run(NEW, (501, 2, 60.0)) == (0, 1, 1, 0)  # recorded at the same moment, by the run before
    assert warehouse.read(S.REGRESSION).count() == 1
    assert len({r.ETLControlId for r in warehouse.read(S.RUN_LOG).collect()}) == len(ids) + 1


def test_daily_states_follow_rows_flags_and_late_intervals(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert set(S.RUNTIME_DAILY.columns) == {*S.RUNTIME_DAILY.keys, *fact_states("runtime")}

    def run(as_of, facts, intervals):
        staging = L.Staging(spark, warehouse)
        if facts:
            staging.write(S.RUNTIME, make(None, [
                row(RuntimeStatsIntervalId=i, QueryId=q, PlanId=p, ExecutionType=0, AvgDurationMs=d, CountExecutions=n)
                for i, q, p, d, n in facts], S.RUNTIME.staging_schema))
        staging.write(S.INTERVAL, make(None, [
            row(RuntimeStatsIntervalId=i, IntervalStartTime=DAY + dt.timedelta(days=i)) for i in intervals],
            S.INTERVAL.staging_schema))
        L.load(warehouse, staging, as_of)

    def same():
        t, names = warehouse.telemetry(), list(TO_DATE)
        daily = warehouse.read(S.RUNTIME_DAILY)
        by = ["TenantName"]
        assert sorted(map(str, TI.to_date(names, "month", by=by, daily=daily).collect())) == sorted(
            map(str, TI.to_date(names, "month", t.intervals, by, t.runtime).collect()))
        assert sorted(map(str, daily.collect())) == sorted(
            map(str, daily_states(t.runtime, t.intervals).select(*daily.columns).collect()))
        return daily

    run(OLD, [(1, 1, 1, 8.0, 2), (2, 1, 1, 16.0, 3), (1, 2, 5, 2048.0, 1), (30, 1, 1, 4.0, 1), (140, 1, 1, 8.0, 1)], [1, 2, 140])
    assert same().filter("IntervalDate IS NULL").count() == 1
    before = files(tmp_path, S.RUNTIME_DAILY)
    # A late interval gives the waiting row its date; buckets without news stay as they are.
    run(NEW, [(31, 1, 2, 64.0, 4), (31, 2, 5, 2048.0, 4)], [30, 31])
    daily, t = same(), warehouse.telemetry()
    risk = lambda runtime, **o: TI.regression_risk(runtime, t.intervals, "month", ["TenantName"], **o).collect()
    assert risk(None, daily=daily) == risk(t.runtime)
    assert daily.filter("IntervalDate IS NULL").isEmpty()
    assert daily.filter("sum_regressed_rows > 0").select("PlanId").collect() == [(2,)]
    kept = files(tmp_path, S.RUNTIME_DAILY)
    assert any("IntervalBucket=1" in name and kept.get(name) == at for name, at in before.items())


def test_to_date_from_daily_states_reads_no_facts(spark):
    fixture = Fixture(spark, DATA_DIR)
    df = TI.to_date(TO_DATE, "year", by=["TenantName"], daily=fixture.table(S.RUNTIME_DAILY))
    assert {name.split("/" + S.RUNTIME_DAILY.name)[0] != name for name in df.inputFiles()} == {True}


# --- conflicts --------------------------------------------------------------------

def test_conflicting_intervals_are_stored_and_counted(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))

    def run(as_of, *starts):
        staging = L.Staging(spark, warehouse)
        staging.write(S.INTERVAL, make(None, [
            row(RuntimeStatsIntervalId=i, IntervalStartTime=DAY + dt.timedelta(hours=h), IntervalEndTime=DAY) for i, h in starts],
            S.INTERVAL.staging_schema))
        return tuple(L.load(warehouse, staging, as_of).first())

    assert run(OLD, (1, 0), (1, 2), (2, 0)) == (2, 0, 0, 1)
    assert run(NEW, (1, 2), (2, 5)) == (0, 2, 0, 1)
    got = {(r.RuntimeStatsIntervalId, r.Versions, r.FirstStart, r.LastStart, str(r.LoadDate))
           for r in warehouse.read(S.INTERVAL_CONFLICT).collect()}
    hour = dt.timedelta(hours=1)
    assert got == {(1, 2, DAY, DAY + 2 * hour, OLD), (2, 2, DAY, DAY + 5 * hour, NEW)}
    assert {r.RuntimeStatsIntervalId: r.IntervalStartTime for r in warehouse.read(S.INTERVAL).collect()} == {1: DAY + 2 * hour, 2: DAY}


# --- refresh of all tables ----------------------------------------------------------

def _waits(make, *rows):
    return make(None, [row(RuntimeStatsIntervalId=i, QueryId=1, PlanId=1, WaitCategory="CPU", QueryWaitTimeCategory=b,
                           TotalWaitTimeMs=t, CountWaits=1, AvgWaitTimeMs=float(t), MaxWaitTimeMs=t) for i, b, t in rows],
                S.WAIT.staging_schema)


def _runtime(make, *rows):
    return make(None, [row(RuntimeStatsIntervalId=i, QueryId=1, PlanId=p, ExecutionType=0, AvgDurationMs=d, CountExecutions=n)
                       for i, p, d, n in rows], S.RUNTIME.staging_schema)


LANDINGS = [
    (S.WAIT, [(1, 1, 100), (2, 1, 7)]), (S.RUNTIME, [(1, 1, 10.0, 5), (2, 2, 30.0, 1)]),
    (S.WAIT, [(1, 2, 50)]), (S.RUNTIME, [(2, 2, 30.0, 9)]), (S.WAIT, [(1, 1, 3), (300, 1, 8)]),
]


def refreshed(spark, make, root, splits):
    """Land the files in order, with a refresh after each number of files in ``splits``."""
    warehouse = Warehouse(spark, f"{root}/warehouse")
    result = None
    for n, (table, rows) in enumerate(LANDINGS, 1):
        frame = _waits(make, *rows) if table is S.WAIT else _runtime(make, *rows)
        frame.coalesce(1).write.mode("append").parquet(f"{root}/landing/{table.name}")
        if n in splits:
            result = refresh_all(spark, warehouse, f"{root}/landing", f"{root}/checkpoint", lambda: NEW).collect()
    return warehouse, result


def test_refresh_gives_the_same_rows_for_any_split_of_files(spark, make, tmp_path):
    stored = []
    for name, splits in (("one", {5}), ("two", {2, 5}), ("each", {1, 2, 3, 4, 5})):
        warehouse, _ = refreshed(spark, make, tmp_path / name, splits)
        waits = {(r.RuntimeStatsIntervalId, r.TotalWaitTimeMs, r.MaxWaitTimeMs, r.CountWaits) for r in warehouse.read(S.WAIT).collect()}
        runs = {(r.RuntimeStatsIntervalId, r.PlanId, r.CountExecutions, r.IsRegression) for r in warehouse.read(S.RUNTIME).collect()}
        stored.append((waits, runs, warehouse.read(S.REGRESSION).count()))
    assert stored[0] == ({(1, 153, 100, 3), (2, 7, 7, 1), (300, 8, 8, 1)}, {(1, 1, 5, False), (2, 2, 9, True)}, 1)
    assert stored[1] == stored[0] and stored[2] == stored[0]


def test_a_refresh_that_died_is_finished_by_the_next(spark, make, tmp_path, monkeypatch):
    """Files already taken from the stream stay pending until a load has merged them."""
    from plandrift.streaming import ingest

    def dies(*_):
        raise RuntimeError("lost")

    real = ingest.load
    monkeypatch.setattr(ingest, "load", dies)
    with pytest.raises(RuntimeError):
        refreshed(spark, make, tmp_path, {3})
    monkeypatch.setattr(ingest, "load", real)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    again = lambda: tuple(refresh_all(spark, warehouse, f"{tmp_path}/landing", f"{tmp_path}/checkpoint", lambda: NEW).first())
    assert again() == (4, 0, 1, 0)
    assert {(r.RuntimeStatsIntervalId, r.TotalWaitTimeMs) for r in warehouse.read(S.WAIT).collect()} == {(1, 150), (2, 7)}
    assert again() == (0, 0, 0, 0)
    assert warehouse.read(S.RUN_LOG).agg(F.count("*")).first()[0] == 1


def test_retention_drops_summaries_and_landed_buckets(spark, make, tmp_path):
    warehouse, _ = refreshed(spark, make, tmp_path, {5})
    warehouse.create(S.INTERVAL, make(S.INTERVAL, [
        row(RuntimeStatsIntervalId=i, IntervalStartTime=dt.datetime(2020, 1, 1) if i < 3 else DAY) for i in (1, 2, 300)]))
    assert warehouse.stored(S.PLAN_STATE) == [("A", 0)]
    L.apply_retention(warehouse, NEW)
    assert warehouse.stored(S.PLAN_STATE) == warehouse.stored(S.RUNTIME) == []
    assert {r.RuntimeStatsIntervalId for r in warehouse.read(S.WAIT_BUCKET).collect()} == {300}


# --- zone map -----------------------------------------------------------------------

def _scan(frame):
    """Partition filters of the one scan of a plan."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]


def test_load_date_windows_prune_partitions(make, spark, tmp_path):
    """A bucket of old interval ids loaded late is read, recent ids loaded early are not."""
    from plandrift.plans import reports

    warehouse = Warehouse(spark, str(tmp_path))
    fact = lambda i, day, t="A": row(RuntimeStatsIntervalId=i, QueryId=i, PlanId=1, ExecutionType=0, TenantName=t,
                                     LoadDate=dt.datetime(2024, 1, day), WaitCategory="CPU")
    for table in (S.RUNTIME, S.WAIT):
        warehouse.create(table, make(table, [fact(5, 30), fact(6, 1), fact(250, 2), fact(350, 29), fact(355, 3, "B")]))
    t = warehouse.telemetry()
    for name in ("runtime", "waits"):
        recent = t.loaded_since(name, "2024-01-31 10:00:00", 7)
        assert {r.RuntimeStatsIntervalId for r in recent.collect()} == {5, 350}
        filters = _scan(recent)
        assert "IntervalBucket" in filters and "INSET" not in filters.upper().replace("IN (", "")
        assert "0" in filters and "3" in filters and "2," not in filters and "B" not in filters.split("TenantName")[1][:12]
    assert {r.QueryId for r in reports.slowest_queries(t, "2024-01-31 10:00:00").collect()} == set()
    # What a report narrowed itself is filtered, never read anew.
    from dataclasses import replace
    own = replace(t, runtime=t.runtime.filter("QueryId = 350"))
    assert [r.QueryId for r in own.loaded_since("runtime", "2024-01-31 10:00:00", 7).collect()] == [350]
    assert warehouse.loaded_since(S.RUNTIME, "2025-01-01", 7) == []
    assert t.loaded_since("runtime", "2025-01-01", 7).count() == 0


def test_zones_measure_new_files_only(make, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    day = lambda n: dt.datetime(2024, 1, n)
    fact = lambda i, n: row(RuntimeStatsIntervalId=i, QueryId=1, PlanId=n, ExecutionType=0, LoadDate=day(n), TenantName="a b/c")
    assert warehouse.zones(S.RUNTIME) == {}
    warehouse.append(S.RUNTIME, make(S.RUNTIME, [fact(5, 3), fact(205, 4)]))
    assert warehouse.zones(S.RUNTIME) == {("a b/c", 0): (day(3), day(3)), ("a b/c", 2): (day(4), day(4))}
    warehouse.append(S.RUNTIME, make(S.RUNTIME, [fact(6, 1), fact(7, 9)]))
    spark.sparkContext.setJobGroup("zones", "")
    assert warehouse.zones(S.RUNTIME) == {("a b/c", 0): (day(1), day(9)), ("a b/c", 2): (day(4), day(4))}
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("zones"))
    assert before > 0 and warehouse.zones(S.RUNTIME)[("a b/c", 0)] == (day(1), day(9))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("zones")) == before  # known files: no job
    spark.sparkContext.setJobGroup("", "")
    warehouse.drop_partitions(S.RUNTIME, [("a b/c", 0)])
    assert Warehouse(spark, str(tmp_path)).zones(S.RUNTIME) == {("a b/c", 2): (day(4), day(4))}
    assert len(list((tmp_path / "_zones" / S.RUNTIME.name).iterdir())) <= 3
