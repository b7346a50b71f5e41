import datetime as dt

import pytest
from pyspark.sql import functions as F

from plandrift import schemas as S
from plandrift.functions import columns as C, filters as FI, ranking
from plandrift.plans import views


@pytest.mark.parametrize("name, group", [
    ("CPU", "CPU Contention"), ("Memory", "Memory Pressure"),
    ("RESOURCE_SEMAPHORE", "Memory Pressure"), ("resource-semaphore", "Memory Pressure"),
    ("Buffer IO", "IO Contention"), ("Network IO", "IO Contention"),
    ("Replication", "IO Contention"), ("Compilation", "IO Contention"),
    ("Lock", "Lock Contention"), ("Latch", "Latch Contention"), ("NETWORK", "Network"),
    ("Idle", "Other"), ("Worker Thread", "Other"),
])
def test_wait_group(spark, name, group):
    df = spark.range(1).select(C.wait_category_group(F.lit(name)).alias("g"))
    assert df.first().g == group


@pytest.mark.parametrize("unit, start, end, crossed", [
    ("hour", "2024-01-01 00:59:00", "2024-01-01 01:01:00", 1),
    ("hour", "2024-01-01 01:01:00", "2024-01-01 00:59:00", -1),
    ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
    ("day", "2024-01-01 23:59:00", "2024-01-02 00:01:00", 1),
    ("hour", "2024-01-01 01:00:00", "2024-01-01 01:59:59", 0),
])
def test_boundary_diff(spark, unit, start, end, crossed):
    at = [F.lit(m).cast("timestamp") for m in (start, end)]
    assert spark.range(1).select(C.boundary_diff(unit, *at).alias("n")).first().n == crossed


def test_divide(spark):
    one = F.lit(1.0)
    df = spark.range(1).select(
        C.divide(one, F.lit(0.0)).alias("blank"), C.divide(one, F.lit(0.0), 7).alias("alternate"),
        C.divide(one, F.lit(4.0)).alias("plain"))
    assert tuple(df.first()) == (None, 7.0, 0.25)


def test_fact_view_on_zero_duration_and_missing_stdev(runtime):
    fact = views.fact_runtime_stats(
        runtime(("A", 1, 1, 1, 0.0, {"StdevDurationMs": None, "AvgCpuTimeMs": 5.0}))).first()
    assert fact.CpuPercentageOfDuration is None and fact.StdevDurationMs == 0.0


def test_interval_view_formats(make):
    start = dt.datetime(2024, 1, 1, 9, 5)
    row = views.dim_interval(make(S.INTERVAL, [{"IntervalStartTime": start}])).first()
    assert (row.IntervalTimeOfDay, row.IntervalDayOfWeek) == ("9:05", "Monday")


def test_query_type(spark):
    df = spark.createDataFrame([(5,), (0,), (None,), (-3,)], "o bigint")
    kinds = [r[0] for r in df.select(C.query_type(F.col("o"))).collect()]
    assert kinds == ["Stored Procedure", "Ad-hoc Query", "Unknown", "Unknown"]


def test_dim_query_keys_do_not_mix_tenants(make):
    at = {"ServerName": "s", "DatabaseName": "d", "QueryId": 1, "QueryTextId": 1}
    queries = make(S.QUERY, [{**at, "TenantName": "A"}, {**at, "TenantName": "B"}])
    texts = make(S.QUERY_TEXT, [{**at, "TenantName": "A", "QueryTextContent": "of A"}])
    got = {r.TenantName: r.QueryText for r in views.dim_query(queries, texts).collect()}
    assert got == {"A": "of A", "B": None}


def test_as_of_accepts_text_datetime_and_column(spark):
    moment = dt.datetime(2024, 5, 6, 7, 8, 9)
    row = spark.range(1).select(
        C.as_of_column("2024-05-06 07:08:09"), C.as_of_column(moment), C.as_of_column(F.lit(moment))
    ).first()
    assert set(row) == {moment}


def test_scope_without_arguments_adds_no_filter(runtime):
    df = runtime(("A", 1, 1, 1, 1.0))
    assert FI.optional_scope(df) is df


@pytest.mark.parametrize("dense, expected", [
    (False, [1, 1, 3, 4, 5]), (True, [1, 1, 2, 3, 4]),
])
def test_rank_ties_and_nulls(spark, dense, expected):
    values = [(1, 9.0), (2, 9.0), (3, 8.9), (4, -2.0), (5, None)]
    df = spark.createDataFrame(values, "id int, v double")
    ranked = ranking.rank_desc(df, "v", "r", dense)
    assert [r.r for r in ranked.orderBy("id").collect()] == expected


def test_rank_over_many_bands(spark):
    df = spark.range(5000).select("id", (F.pow(F.col("id") - 2500, F.lit(3.0)) / 7).alias("v"))
    ranked = ranking.rank_desc(df, "v", "r")
    assert ranked.filter(F.col("r") != 5000 - F.col("id")).count() == 0


def test_count_top_keeps_edge_ties(spark):
    df = spark.createDataFrame([(3.0,), (2.0,), (2.0,), (1.0,)], "v double")
    assert ranking.count_top(df, "v", 2).first().TopQueries == 3
