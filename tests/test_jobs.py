import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plandrift import schemas as S
from plandrift.functions.filters import slice_source
from plandrift.operators import quality, retention, runlog
from plandrift.plans import load as L, reports, views
from plandrift.sources import config, extract
from plandrift.sources.warehouse import Telemetry, Warehouse
from plandrift.streaming.ingest import refresh

AS_OF = "2024-03-10 12:00:00"
TODAY = dt.datetime(2024, 3, 10)


def at(tenant="A", **other):
    return {"TenantName": tenant, "ServerName": "s", "DatabaseName": "d", **other}


@pytest.fixture(scope="module")
def telemetry(make):
    """Two tenants sharing interval ids: 1 is old, 2 is recent, 3 is unknown."""
    def days(n):
        return TODAY - dt.timedelta(days=n)

    intervals = [
        {"TenantName": t, "ServerName": "s", "RuntimeStatsIntervalId": i, "IntervalStartTime": days(n)}
        for t in "AB" for i, n in ((1, 120), (2, 5))
    ]
    facts = [at(t, RuntimeStatsIntervalId=i, QueryId=1, PlanId=i, LoadDate=days(n))
             for t in "AB" for i, n in ((1, 120), (2, 5), (3, 1))]
    plans = [at(t, PlanId=p, QueryId=1) for t in "AB" for p in (1, 2, 9)]
    return Telemetry(
        runtime=make(S.RUNTIME, facts), waits=make(S.WAIT, facts),
        intervals=make(S.INTERVAL, intervals), queries=make(S.QUERY, [at(QueryId=1)]),
        texts=make(S.QUERY_TEXT, []), plans=make(S.PLAN, plans),
        regressions=make(S.REGRESSION, [
            at(t, DetectionDate=days(n), RegressionId=n) for t in "AB" for n in (1, 100)]),
        run_log=make(S.RUN_LOG, [
            at(t, LastExtractTime=days(n), ETLControlId=n) for t in "AB" for n in (1, 70)]),
    )


def store(spark, t, root):
    warehouse = Warehouse(spark, str(root))
    for table, df in ((S.RUNTIME, t.runtime), (S.WAIT, t.waits), (S.INTERVAL, t.intervals),
                      (S.QUERY, t.queries), (S.QUERY_TEXT, t.texts), (S.PLAN, t.plans),
                      (S.REGRESSION, t.regressions), (S.RUN_LOG, t.run_log)):
        if df.count():
            warehouse.create(table, df)
    return warehouse


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- retention --------------------------------------------------------------------

def test_report_equals_what_is_deleted(telemetry):
    report = retention.cleanup_report(telemetry, AS_OF).first()
    kept = retention.cleanup(telemetry, AS_OF)
    deleted = [
        before.count() - after.count()
        for before, after in ((telemetry.runtime, kept.runtime), (telemetry.waits, kept.waits),
                              (telemetry.intervals, kept.intervals))
    ]
    assert deleted == [report.RuntimeStatistics, report.WaitStatistics, report.Intervals] == [2, 2, 2]
    assert report.TotalRecords == 6 and report.OrphanedPlans == 2


def test_cleaning_one_tenant_leaves_the_other_alone(telemetry):
    kept = retention.cleanup(telemetry, AS_OF, tenant="A", drop_stale_plans=True)
    for name in ("runtime", "waits", "intervals", "regressions", "plans"):
        before = getattr(telemetry, name).filter("TenantName = 'B'")
        assert same(before, getattr(kept, name).filter("TenantName = 'B'")), name
    assert kept.runtime.filter("TenantName = 'A'").count() == 2


def test_facts_of_unknown_intervals_survive(telemetry):
    kept = retention.cleanup(telemetry, AS_OF, retention_days=1)
    assert {r[0] for r in kept.runtime.select("RuntimeStatsIntervalId").collect()} == {3}


def test_stale_and_orphaned_plans_are_different(telemetry):
    stale = retention.stale_plans(telemetry.plans, telemetry.runtime, AS_OF, 90)
    orphaned = retention.orphaned_plans(telemetry.plans, telemetry.runtime)
    assert {r.PlanId for r in stale.collect()} == {1}
    assert {r.PlanId for r in orphaned.collect()} == {9}


def test_policy_ages_each_kind_separately(telemetry):
    kept = retention.cleanup(telemetry, AS_OF, policy=retention.RetentionPolicy(200, 30, 90, 60))
    assert kept.runtime.count() == 6 and kept.waits.count() == 4
    # The old interval stays: runtime rows still refer to it.
    assert kept.intervals.count() == 4
    assert kept.regressions.count() == 2 and kept.run_log.count() == 2


def test_stored_retention_drops_emptied_partitions(spark, telemetry, tmp_path):
    moved = telemetry.runtime.withColumn(
        "RuntimeStatsIntervalId", F.col("RuntimeStatsIntervalId") * 100)
    intervals = telemetry.intervals.withColumn(
        "RuntimeStatsIntervalId", F.col("RuntimeStatsIntervalId") * 100)
    warehouse = store(spark, telemetry.__class__(**{
        **telemetry.__dict__, "runtime": moved, "intervals": intervals}), tmp_path)
    L.apply_retention(warehouse, AS_OF, tenant="A")
    left = {
        (r.TenantName, r.RuntimeStatsIntervalId) for r in warehouse.read(S.RUNTIME).collect()}
    assert left == {("A", 200), ("A", 300), ("B", 100), ("B", 200), ("B", 300)}
    folders = {p.name for p in (tmp_path / S.RUNTIME.name / "TenantName=A").iterdir()}
    assert folders == {"IntervalBucket=2", "IntervalBucket=3"}
    report = retention.cleanup_report(warehouse.telemetry(), AS_OF, tenant="A").first()
    assert report.TotalRecords == 0


def test_stored_retention_matches_the_lazy_one(spark, telemetry, tmp_path):
    warehouse = store(spark, telemetry, tmp_path)
    policy = retention.RetentionPolicy(90, 30, 90, 60)
    expected = retention.cleanup(telemetry, AS_OF, policy=policy, drop_stale_plans=True)
    L.apply_retention(warehouse, AS_OF, policy=policy, drop_stale_plans=True)
    got = warehouse.telemetry()
    for name in ("runtime", "waits", "intervals", "regressions", "run_log", "plans"):
        assert same(getattr(expected, name), getattr(got, name)), name


# --- load -------------------------------------------------------------------------

def raw_source(spark, make, tenant, durations):
    """Staging rows of one source: one query, one plan per interval."""
    rows = [at(tenant, RuntimeStatsIntervalId=i, QueryId=1, PlanId=i, AvgDurationMs=d, ExecutionType=0)
            for i, d in durations.items()]
    return {S.RUNTIME.name: make(None, rows, S.RUNTIME.staging_schema),
            S.QUERY.name: make(None, [at(tenant, QueryId=1)], S.QUERY.staging_schema)}


def test_load_merges_detects_flags_and_logs(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    sources = spark.createDataFrame(
        [("A", "s", "d"), ("B", "s", "d"), ("C", "s", "d")], S.KEYS).collect()
    extracts = {"A": {1: 10.0, 2: 20.0}, "B": {1: 10.0, 2: 11.0}}

    def extract_one(source):
        if source.TenantName == "C":
            raise ConnectionError("source unreachable")
        return raw_source(spark, make, source.TenantName, extracts[source.TenantName])

    staging = L.Staging(spark, warehouse)
    results = L.stage_sources(staging, sources, extract_one)
    assert [(r.tenant, r.status, r.records) for r in results] == [
        ("A", "SUCCESS", 3), ("B", "SUCCESS", 3), ("C", "FAILED", 0)]
    assert tuple(L.load(warehouse, staging, AS_OF).first()) == (6, 0, 1, 0)
    L.log_failed_sources(warehouse, results, AS_OF)

    flagged = warehouse.read(S.RUNTIME).filter("IsRegression").collect()
    assert [(r.TenantName, r.PlanId) for r in flagged] == [("A", 2)]
    log = warehouse.read(S.RUN_LOG)
    assert {(r.TenantName, r.ExtractStatus, r.RecordsInserted) for r in log.collect()} == {
        ("A", "SUCCESS", 3), ("B", "SUCCESS", 3), ("C", "FAILED", 0)}
    assert "unreachable" in log.filter("TenantName = 'C'").first().ErrorMessage
    totals = runlog.run_totals(log).first()
    assert tuple(totals) == (2, 1, 6)

    # The same extracts again later that day: updates only, nothing detected twice.
    again = L.Staging(spark, warehouse)
    L.stage_sources(again, sources[:2], extract_one)
    before = warehouse.read(S.RUNTIME).collect()
    assert tuple(L.load(warehouse, again, "2024-03-10 18:00:00").first()) == (0, 6, 0, 0)
    assert sorted(before) == sorted(warehouse.read(S.RUNTIME).collect())


def test_investigation_is_recorded_in_place(spark, telemetry, tmp_path):
    warehouse = store(spark, telemetry, tmp_path)
    L.record_investigation(warehouse, 100, "missing index")
    rows = warehouse.read(S.REGRESSION).collect()
    assert {(r.TenantName, r.RegressionId, r.IsInvestigated, r.Notes) for r in rows} == {
        ("A", 1, False, None), ("B", 1, False, None),
        ("A", 100, True, "missing index"), ("B", 100, True, "missing index")}


def test_failed_load_is_logged(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    staging = L.Staging(spark, warehouse)
    row = at(QueryId=1)
    staging.write(S.QUERY, make(None, [row, row], S.QUERY.staging_schema))
    with pytest.raises(L.DuplicateStagingRows):
        L.load(warehouse, staging, AS_OF)
    assert [r.ExtractStatus for r in warehouse.read(S.RUN_LOG).collect()] == ["FAILED"]


def test_load_at_the_wall_clock_counts_its_inserts(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    staging = L.Staging(spark, warehouse)
    for table, rows in raw_source(spark, make, "A", {1: 10.0, 2: 20.0}).items():
        staging.write(S.TABLES[table], rows)
    assert tuple(L.load(warehouse, staging, None).first()) == (3, 0, 1, 0)


def test_databases_may_disagree_on_an_interval(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = [
        {"TenantName": "A", "ServerName": "s", "RuntimeStatsIntervalId": 1,
         "IntervalStartTime": TODAY + dt.timedelta(hours=h)} for h in (0, 1, 1)]
    staged = make(None, rows, S.INTERVAL.staging_schema)
    assert L.merge_table(warehouse, S.INTERVAL, staged, AS_OF).first().RecordsInserted == 1
    stored = warehouse.read(S.INTERVAL).collect()
    assert [r.IntervalStartTime for r in stored] == [TODAY + dt.timedelta(hours=1)]


def test_empty_load(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert tuple(L.load(warehouse, L.Staging(spark, warehouse), AS_OF).first()) == (0, 0, 0, 0)


def test_refresh_loads_only_new_files(spark, make, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def land_and_refresh(count, as_of):
        row = at(RuntimeStatsIntervalId=1, QueryId=1, PlanId=1, ExecutionType=0, CountExecutions=count)
        make(None, [row], S.RUNTIME.staging_schema).write.mode("append").parquet(landing)
        refresh(spark, warehouse, S.RUNTIME, landing, checkpoint, lambda: as_of,
                ["CountExecutions"]).awaitTermination()
        return [(r.CountExecutions, str(r.LoadDate)) for r in warehouse.read(S.RUNTIME).collect()]

    assert land_and_refresh(9, "2024-01-01 00:00:00") == [(9, "2024-01-01 00:00:00")]
    # Were the first file read again, the larger count would win within the batch.
    assert land_and_refresh(4, "2024-01-02 00:00:00") == [(4, "2024-01-01 00:00:00")]


# --- sources ----------------------------------------------------------------------

def test_config_lists_every_database_and_drops_credentials(spark, tmp_path):
    path = tmp_path / "servers.json"
    path.write_text(json.dumps({
        "servers": [
            {"serverName": "one", "tenantName": "Tenant_A", "databases": ["x", "y"],
             "useWindowsAuth": True},
            {"serverName": "two\\inst", "tenantName": "Tenant_B", "databases": ["z"],
             "useWindowsAuth": False, "username": "u", "password": "p"},
        ],
        "configuration": {"retentionDays": 90, "queryTimeout": 300},
    }, indent=2))
    read = config.read_config(spark, str(path))
    items = {tuple(r) for r in config.work_items(read).collect()}
    assert items == {
        ("Tenant_A", "one", "x", True), ("Tenant_A", "one", "y", True),
        ("Tenant_B", "two\\inst", "z", False)}
    assert "password" not in read.schema.json()
    assert config.settings(read).first().retentionDays == 90


def test_landing_folders_tag_the_rows(spark, tmp_path):
    raw = spark.createDataFrame([(7, "SELECT 1", None)],
                                "query_text_id bigint, query_sql_text string, statement_sql_handle string")
    for tenant in ("007", "B"):
        extract.tag(raw, tenant, "s\\1", "d").write.mode("append").partitionBy(*S.KEYS).parquet(
            f"{tmp_path}/query_text")
    landed = extract.read_landing(spark, str(tmp_path), S.QUERY_TEXT)
    texts = extract.extract_query_texts(landed)
    assert {(r.TenantName, r.ServerName) for r in texts.collect()} == {("007", "s\\1"), ("B", "s\\1")}
    assert [len(r.QueryHash) for r in texts.collect()] == [8, 8]


def test_recent_intervals_are_judged_per_source(spark):
    def intervals(tenant, newest):
        rows = spark.range(1, newest + 1).select(F.col("id").alias("runtime_stats_interval_id"))
        return extract.tag(rows, tenant, "s", "d")

    both = extract.combine([intervals("A", 300), intervals("B", 50)])
    kept = extract._recent(both, both, 100).groupBy("TenantName").count().collect()
    assert {tuple(r) for r in kept} == {("A", 101), ("B", 50)}


def test_remote_reader_is_configured_without_connecting(spark):
    plain = extract.jdbc_reader(spark, "jdbc:none:x", "SELECT 1")
    split = extract.jdbc_reader(spark, "jdbc:none:x", "SELECT 1", partition=("id", 0, 9, 3))
    assert plain is not None and split is not None


# --- quality and views ------------------------------------------------------------

def test_schema_checks(make):
    df = make(S.QUERY, [at(QueryId=1), at(QueryId=1), at("B", QueryId=1)])
    assert quality.duplicate_keys(df, S.QUERY).count() == 1
    nulled = df.withColumn("QueryTextId", F.when(F.col("TenantName") == "A", F.col("QueryTextId")))
    counts = {r.ColumnName: r.NullCount for r in quality.required_null_counts(nulled, S.QUERY).collect()}
    assert counts["QueryTextId"] == 1 and counts["QueryId"] == 0 and "ObjectId" not in counts


def test_interval_conflicts_between_databases(spark):
    rows = [("A", "s", 1, TODAY), ("A", "s", 1, TODAY + dt.timedelta(hours=1)), ("B", "s", 1, TODAY)]
    df = spark.createDataFrame(rows, [*S.INTERVAL_KEY, "IntervalStartTime"]).withColumn(
        "IntervalEndTime", F.col("IntervalStartTime"))
    assert [(r.TenantName, r.Versions) for r in quality.interval_conflicts(df).collect()] == [("A", 2)]


def test_views_are_available_to_sql(spark, telemetry):
    views.register_views(spark, telemetry)
    got = spark.sql("""SELECT f.TenantName, count(*) AS n FROM FactRuntimeStats f
        LEFT JOIN DimInterval i USING (TenantName, ServerName, RuntimeStatsIntervalId)
        WHERE i.IntervalDate >= DATE '2024-01-01' GROUP BY f.TenantName""")
    assert {tuple(r) for r in got.collect()} == {("A", 1), ("B", 1)}


def test_partition_filter_reaches_the_scan(spark, telemetry, tmp_path):
    warehouse = store(spark, telemetry, tmp_path)
    scoped = slice_source(warehouse.read(S.RUNTIME), "A", "s", "d").agg(F.max("LoadDate"))
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TenantName" in plan
    assert "AvgDurationMs" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_csv_export(spark, telemetry, tmp_path):
    reports.export_csv(reports.top_query_export(telemetry), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 2 and "AvgMemoryMB" in back.columns


def test_wait_buckets_of_a_refresh_add_up_over_files(spark, tmp_path, make):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landing = str(tmp_path / "landing")
    columns = S.WAIT.staging_schema
    row = make(S.WAIT, [{}], columns).first().asDict()
    for total in (100, 250):
        spark.createDataFrame([tuple((row | {"TotalWaitTimeMs": total})[c] for c in columns.fieldNames())], columns) \
            .coalesce(1).write.mode("append").parquet(landing)
    refresh(spark, warehouse, S.WAIT, landing, str(tmp_path / "checkpoint"), lambda: "2024-01-01 00:00:00",
            ["TotalWaitTimeMs"]).awaitTermination()
    assert [r.TotalWaitTimeMs for r in warehouse.read(S.WAIT).collect()] == [350]


def test_counts_of_two_loads_with_one_moment(spark, tmp_path, make):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    rows = lambda ids: make(S.INTERVAL, [{"RuntimeStatsIntervalId": k} for k in ids], S.INTERVAL.staging_schema)
    results = []
    for ids in (range(1, 9), range(5, 11)):
        staging = L.Staging(spark, warehouse)
        staging.write(S.INTERVAL, rows(ids))
        results.append(tuple(L.load(warehouse, staging, "2024-01-01 00:00:00").first())[:2])
    assert results[0] == (8, 0) and results[1] == (2, 4)
    assert warehouse.read(S.INTERVAL).count() == 10


def test_window_prunes_interval_buckets(spark, make, runtime, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "pruned"))
    warehouse.create(S.RUNTIME, runtime(("T", 1, 1, 5, 1.0), ("T", 1, 1, 250, 2.0), ("U", 1, 1, 251, 3.0)))
    recent = make(S.INTERVAL, [{"TenantName": "T", "ServerName": "s", "RuntimeStatsIntervalId": 250}])
    kept = warehouse.telemetry(recent).runtime
    assert [(r.TenantName, r.RuntimeStatsIntervalId) for r in kept.collect()] == [("T", 250)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert S.BUCKET_COLUMN in filters and "TenantName" in filters
