import datetime as dt

import pytest
from pyspark.sql import functions as F

from plandrift import schemas as S
from plandrift.operators import upsert as U
from plandrift.plans.load import DuplicateStagingRows, merge_table
from plandrift.sources.warehouse import Warehouse

OLD, NEW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def key(interval=1, **other):
    return {
        "TenantName": "A", "ServerName": "s", "DatabaseName": "d",
        "RuntimeStatsIntervalId": interval, "QueryId": 1, "PlanId": 1, "ExecutionType": 0, **other,
    }


def staged(make, *rows):
    return make(None, rows, S.RUNTIME.staging_schema)


def test_update_keeps_what_is_not_updatable(make):
    target = make(S.RUNTIME, [key(ExecutionTypeDesc="Regular", IsRegression=True, CountExecutions=5)])
    merged = U.merge_runtime_stats(
        target, staged(make, key(ExecutionTypeDesc="Other", CountExecutions=9)), NEW).first()
    assert (merged.CountExecutions, merged.ExecutionTypeDesc, merged.IsRegression) == (9, "Regular", True)
    assert merged.LoadDate == dt.datetime(2024, 3, 10, 12)


def test_update_to_null_is_an_update(make):
    target = make(S.RUNTIME, [key(StdevDurationMs=4.0)])
    merged = U.merge_runtime_stats(target, staged(make, key(StdevDurationMs=None)), NEW).first()
    assert merged.StdevDurationMs is None


def test_insert_sets_load_date_flag_and_surrogate(make):
    merged = U.merge_runtime_stats(make(S.RUNTIME, []), staged(make, key()), NEW).first()
    assert merged.LoadDate == dt.datetime(2024, 2, 1)
    assert merged.IsRegression is False and merged.RuntimeStatsId is not None


def test_merge_is_idempotent_and_covers_all_keys(make):
    target = make(S.RUNTIME, [key(i, CountExecutions=i) for i in range(10)])
    extract = staged(make, *[key(i, CountExecutions=i * 2) for i in range(5, 15)])
    once = U.merge_runtime_stats(target, extract, NEW)
    twice = U.merge_runtime_stats(once, extract, NEW)
    assert once.count() == 15
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_text_and_interval_are_insert_only():
    assert S.QUERY_TEXT.update == [] and S.INTERVAL.update == []
    assert len(S.RUNTIME.update) == 29 and len(S.QUERY.update) == 7 and len(S.WAIT.update) == 4


def test_wait_buckets_collapse_to_the_merge_key(make):
    row = {"TenantName": "A", "ServerName": "s", "DatabaseName": "d", "WaitCategory": "CPU"}
    rows = [
        {**row, "QueryWaitTimeCategory": b, "TotalWaitTimeMs": t, "AvgWaitTimeMs": a,
         "MaxWaitTimeMs": m, "CountWaits": n}
        for b, t, a, m, n in ((1, 10, 2.0, 7, 5), (2, 30, 4.0, 9, 1))
    ]
    merged = U.merge_wait_stats(make(S.WAIT, []), make(None, rows, S.WAIT.staging_schema), NEW)
    got = merged.select("TotalWaitTimeMs", "AvgWaitTimeMs", "MaxWaitTimeMs", "CountWaits").collect()
    assert [tuple(r) for r in got] == [(40, 3.0, 9, 6)]


def test_duplicate_staging_rows_are_reported_and_reducible(make):
    extract = staged(make, key(CountExecutions=1), key(CountExecutions=3), key(2))
    assert U.staging_duplicates(extract, S.RUNTIME).first().Copies == 2
    latest = U.keep_latest(extract, S.RUNTIME, ["CountExecutions"])
    assert sorted(r.CountExecutions for r in latest.collect()) == [1, 3]


def test_stored_merge_rejects_duplicates(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(DuplicateStagingRows):
        merge_table(warehouse, S.RUNTIME, staged(make, key(), key()), NEW)


def test_stored_merge_touches_only_its_partitions(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.create(S.RUNTIME, make(S.RUNTIME, [
        key(50), key(250), key(250, TenantName="B"),
    ]))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    counts = merge_table(
        warehouse, S.RUNTIME, staged(make, key(250, CountExecutions=8), key(251)), NEW)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    kept = [p for p in before if after.get(p) == before[p]]
    assert {tuple(p.parts[-3:-1]) for p in kept} == {
        ("TenantName=A", "IntervalBucket=0"), ("TenantName=B", "IntervalBucket=2")}
    assert [(r.RecordsInserted, r.RecordsUpdated) for r in counts.collect()] == [(1, 1)]
    rows = warehouse.read(S.RUNTIME).groupBy("TenantName").agg(
        F.count("*").alias("n"), F.sum("CountExecutions").alias("c"))
    assert {r.TenantName: (r.n, r.c) for r in rows.collect()} == {"A": (3, 10), "B": (1, 1)}


def test_plan_history_versions(make):
    plan = {"TenantName": "A", "ServerName": "s", "DatabaseName": "d", "PlanId": 1}
    first = U.scd2_upsert(None, make(S.PLAN, [{**plan, "CompatibilityLevel": 150}]), OLD)
    same = U.scd2_upsert(first, make(S.PLAN, [{**plan, "CompatibilityLevel": 150}]), NEW)
    assert same.count() == 1
    changed = U.scd2_upsert(first, make(S.PLAN, [{**plan, "CompatibilityLevel": 160}]), NEW)
    rows = [(r.CompatibilityLevel, r.IsCurrent, r.ValidTo) for r in changed.orderBy("ValidFrom").collect()]
    assert rows == [(150, False, dt.datetime(2024, 2, 1)), (160, True, None)]
