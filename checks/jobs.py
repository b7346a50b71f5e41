"""Checks of extraction, merges, regression jobs, retention and the load job."""

import uuid

from pyspark.sql import functions as F

from checks.base import K, NOW, QK, Check, each
from checks.views import _split
from plandrift import schemas as S
from plandrift.operators import quality, regression, retention, runlog, upsert
from plandrift.plans.load import LOAD_ORDER, Staging, load, merge_table
from plandrift.schemas import INTERVAL_KEY, KEYS, PLAN_KEY, QUERY_KEY
from plandrift.sources import config, extract
from plandrift.sources.fixture import AS_OF, _wait_events
from plandrift.sources.warehouse import Warehouse, shared_dir
from plandrift.streaming.ingest import refresh_all

CHECKS: dict[str, Check] = {}

TODAY = f"date_trunc('day', {NOW})"
_RT_COLUMNS = [c for c in S.RUNTIME.columns if c != "RuntimeStatsId"]


def _new_root(f) -> str:
    return f"{shared_dir(f.spark)}/plandrift/{f.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


# --- sources ----------------------------------------------------------------------

def _config_items(f):
    """Write each tenant's sources as a configuration document and read it back."""
    servers = f.table(S.RUNTIME).select(*KEYS).distinct().groupBy("TenantName", "ServerName").agg(
        F.sort_array(F.collect_list("DatabaseName")).alias("databases")
    )
    server = F.struct(
        F.col("ServerName").alias("serverName"), F.col("TenantName").alias("tenantName"),
        "databases", F.lit(True).alias("useWindowsAuth"), F.lit("secret").alias("password"),
    )
    documents = servers.groupBy("TenantName").agg(F.collect_list(server).alias("servers")).select(
        F.to_json(F.struct("servers")).alias("document")
    )
    parsed = documents.select(F.from_json("document", config.CONFIG_SCHEMA).alias("c"))
    return config.work_items(parsed.select("c.*"))


CHECKS["s1_server_list"] = Check(
    _config_items, f"SELECT DISTINCT {K}, true AS UseIntegratedAuth FROM rt", ["rt"])


def _raw_intervals(f):
    sources = f.table(S.RUNTIME).select(*KEYS, "RuntimeStatsIntervalId").distinct()
    return sources.join(f.table(S.INTERVAL), INTERVAL_KEY).select(
        *KEYS, F.col("RuntimeStatsIntervalId").alias("runtime_stats_interval_id"),
        F.col("IntervalStartTime").alias("start_time"), F.col("IntervalEndTime").alias("end_time"),
    )


CHECKS["s2_extract_intervals"] = Check(
    lambda f: extract.extract_intervals(_raw_intervals(f), AS_OF, days=800).distinct(),
    f"""SELECT TenantName, ServerName, RuntimeStatsIntervalId, IntervalStartTime, IntervalEndTime,
      IntervalDurationMinutes, CapturedDate, CapturedTime FROM intervals
      WHERE IntervalStartTime >= {NOW} - INTERVAL 800 DAY""", ["intervals"],
)
_QUERY_NAMES = {
    "QueryId": "query_id", "QueryTextId": "query_text_id",
    "ContextSettingsId": "context_settings_id", "ObjectId": "object_id",
    "CompilationStartTime": "creation_time", "CompilationEndTime": "last_compile_start_time",
    "LastCompilationBatch": "last_compile_batch_id",
    "LastCompilationBatchUTC": "last_compile_batch_time_ms",
    "CompilationCount": "count_compiles", "AvgCompileCpuTimeMs": "avg_compile_cpu_time_ms",
    "MaxCompileCpuTimeMs": "max_compile_cpu_time_ms",
    "AvgCompileMemoryMb": "avg_compile_memory_mb", "MaxCompileMemoryMb": "max_compile_memory_mb",
}
_QUERY_COLUMNS = ", ".join(f.name for f in S.QUERY.staging_schema.fields)
CHECKS["s3_extract_queries"] = Check(
    lambda f: extract.extract_queries(f.table(S.QUERY).withColumnsRenamed(_QUERY_NAMES), AS_OF),
    f"""SELECT {_QUERY_COLUMNS.replace('ObjectId', 'CAST(ObjectId AS BIGINT) AS ObjectId')}
      FROM queries WHERE CompilationStartTime >= {NOW} - INTERVAL 30 DAY""", ["queries"],
)


def _raw_texts(f):
    return f.table(S.QUERY_TEXT).select(
        *KEYS, F.col("QueryTextId").alias("query_text_id"),
        F.col("QueryTextContent").alias("query_sql_text"),
        F.col("StatementType").alias("statement_sql_handle"),
    )


CHECKS["s4_extract_texts"] = Check(
    lambda f: extract.extract_query_texts(_raw_texts(f)).select(
        *KEYS, "QueryTextId", "QueryTextContent", "StatementType",
        F.length("QueryHash").alias("HashBytes")),
    f"SELECT {K}, QueryTextId, QueryTextContent, StatementType, 8 AS HashBytes FROM texts", ["texts"],
)


def _hash_summary(texts):
    """Every text has one hash of its own; said in figures that SQL can state without the hash."""
    pairs = texts.select("QueryTextContent", "QueryHash").distinct()
    more = lambda key: pairs.groupBy(key).count().where("count > 1").agg(
        F.count(F.lit(1)).alias("n")).scalar()
    return pairs.agg(
        F.count_distinct("QueryTextContent").alias("texts"), F.count_distinct("QueryHash").alias("hashes"),
        F.max(F.length("QueryHash")).alias("hash_bytes"),
    ).withColumns({"texts_with_more_hashes": more("QueryTextContent"),
                   "hashes_with_more_texts": more("QueryHash")})


CHECKS["s4_text_hashes"] = Check(
    lambda f: _hash_summary(extract.extract_query_texts(_raw_texts(f))),
    """SELECT count(DISTINCT QueryTextContent) AS texts, count(DISTINCT QueryTextContent) AS hashes,
      0 AS texts_with_more_hashes, 0 AS hashes_with_more_texts, 8 AS hash_bytes FROM texts""",
    ["texts"],
)


def _raw_plans(f):
    return f.table(S.PLAN).select(
        *KEYS, F.col("PlanId").alias("plan_id"), F.col("QueryId").alias("query_id"),
        F.col("EngineVersion").alias("engine_version"),
        F.col("CompatibilityLevel").alias("compatibility_level"),
        F.col("QueryPlanHash").alias("query_plan_hash"), F.col("PlanHandle").alias("plan_handle"),
        F.col("CreationTime").alias("creation_time"),
        F.col("LastExecutionTime").alias("last_execution_time"),
        F.col("QueryPlanText").alias("query_plan"),
    )


CHECKS["s5_extract_plans"] = Check(
    lambda f: extract.extract_plans(_raw_plans(f)).select(
        *KEYS, "PlanId", "QueryId", "EngineVersion", "CompatibilityLevel",
        F.hex("QueryPlanHash").alias("QueryPlanHash"), F.hex("QueryHash").alias("QueryHash"),
        "CreationTime", "LastExecutionTime", "QueryPlanText", "IsOnlineIndexPlan"),
    f"""SELECT {K}, PlanId, QueryId, EngineVersion, CompatibilityLevel, QueryPlanHash,
      CAST(NULL AS VARCHAR) AS QueryHash, CreationTime, LastExecutionTime, QueryPlanText,
      CAST(NULL AS BOOLEAN) AS IsOnlineIndexPlan FROM plans""", ["plans"],
)


def _raw_runtime(f):
    names = {ours: raw for raw, ours in extract.raw_metric_names().items()}
    return f.table(S.RUNTIME).withColumnsRenamed({
        **names, "RuntimeStatsIntervalId": "runtime_stats_interval_id", "QueryId": "query_id",
        "PlanId": "plan_id", "ExecutionType": "execution_type",
    }).drop("ExecutionTypeDesc", "IsRegression", "LoadDate", "RuntimeStatsId")


_RT_STAGING = ", ".join(f.name for f in S.RUNTIME.staging_schema.fields)
CHECKS["s6_extract_runtime_stats"] = Check(
    lambda f: extract.extract_runtime_stats(_raw_runtime(f), _raw_intervals(f), last=10),
    f"""SELECT {_RT_STAGING} FROM rt JOIN (
        SELECT {K}, max(RuntimeStatsIntervalId) - 10 AS oldest FROM rt GROUP BY {K}) USING ({K})
      WHERE RuntimeStatsIntervalId >= oldest""", ["rt"], {"StdevDurationMs": 4},
)


def _raw_waits(f):
    events = _wait_events(f.read_source)
    raw = events.select(
        *KEYS, F.col("QueryId").alias("query_id"), F.col("PlanId").alias("plan_id"),
        F.col("RuntimeStatsIntervalId").alias("runtime_stats_interval_id"),
        F.col("WaitCategoryId").alias("wait_category"),
        F.col("bucket").alias("query_wait_time_bucket_id"),
        F.col("cents").alias("total_query_wait_time_ms"),
        F.col("cents").cast("double").alias("avg_query_wait_time_ms"),
        F.col("cents").alias("max_query_wait_time_ms"),
        F.lit(1).cast("long").alias("count_executions"),
    )
    categories = events.select(
        F.col("WaitCategoryId").alias("wait_category"), F.col("WaitCategory").alias("wait_category_desc")
    ).distinct()
    return raw, categories


def _extract_waits(f):
    raw, categories = _raw_waits(f)
    return extract.extract_wait_buckets(raw, _raw_runtime(f), _raw_intervals(f), categories, last=20)


_WAIT_BUCKETS = f"""SELECT {QK}, PlanId, RuntimeStatsIntervalId, WaitCategory, bucket AS QueryWaitTimeCategory,
      CAST(sum(cents) AS BIGINT) AS TotalWaitTimeMs, avg(CAST(cents AS DOUBLE)) AS AvgWaitTimeMs,
      max(cents) AS MaxWaitTimeMs, stddev_samp(CAST(cents AS DOUBLE)) AS StdevWaitTimeMs,
      count(*) AS CountWaits
    FROM wait_events SEMI JOIN rt USING ({QK}, PlanId, RuntimeStatsIntervalId)
    JOIN (SELECT {K}, max(RuntimeStatsIntervalId) - 20 AS oldest FROM rt GROUP BY {K}) USING ({K})
    WHERE RuntimeStatsIntervalId >= oldest
    GROUP BY {QK}, PlanId, RuntimeStatsIntervalId, WaitCategory, bucket"""
CHECKS["s7_extract_wait_stats"] = Check(
    lambda f: _extract_waits(f).drop("WaitCategoryId"), _WAIT_BUCKETS, ["wait_events", "rt"],
    each("AvgWaitTimeMs StdevWaitTimeMs", 4),
)
CHECKS["j13_lateral_waits_per_category"] = Check(
    lambda f: _extract_waits(f).groupBy("TenantName", "WaitCategory").agg(
        F.sum("TotalWaitTimeMs").alias("TotalWaitTimeMs"), F.count(F.lit(1)).alias("n")),
    f"""SELECT TenantName, WaitCategory, CAST(sum(TotalWaitTimeMs) AS BIGINT) AS TotalWaitTimeMs,
      count(*) AS n FROM ({_WAIT_BUCKETS}) GROUP BY 1, 2""", ["wait_events", "rt"],
)
CHECKS["a6_stdev_of_waits"] = Check(
    lambda f: _raw_waits(f)[0].groupBy(*KEYS, "wait_category").agg(
        F.stddev_samp("avg_query_wait_time_ms").alias("stdev"), F.count(F.lit(1)).alias("n")
    ).join(_raw_waits(f)[1], "wait_category").select(*KEYS, "wait_category_desc", "stdev", "n"),
    f"""SELECT {K}, WaitCategory AS wait_category_desc, stddev_samp(CAST(cents AS DOUBLE)) AS stdev,
      count(*) AS n FROM wait_events GROUP BY {K}, WaitCategory""",
    ["wait_events"], {"stdev": 4},
)


def _tagged(f):
    rt = f.table(S.RUNTIME)
    sources = [
        extract.tag(
            rt.filter(F.col("DatabaseName") == db).drop(*KEYS).withColumn("Part", F.lit(db)),
            f"Tenant_{db}", "central", db)
        for db in ("DB_F", "DB_O")
    ]
    return extract.combine(sources).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("CountExecutions").alias("executions"))


CHECKS["s8_tagged_sources"] = Check(
    _tagged,
    """SELECT 'Tenant_' || DatabaseName AS TenantName, 'central' AS ServerName, DatabaseName,
      count(*) AS n, CAST(sum(CountExecutions) AS BIGINT) AS executions FROM rt GROUP BY DatabaseName""",
    ["rt"],
)


def _bulk_load(f):
    """Every table appended in two parts, and what the warehouse then holds."""
    warehouse = Warehouse(f.spark, _new_root(f))
    halves = {
        S.QUERY.name: "QueryId", S.QUERY_TEXT.name: "QueryTextId", S.PLAN.name: "PlanId",
        S.INTERVAL.name: "RuntimeStatsIntervalId", S.RUNTIME.name: "RuntimeStatsIntervalId",
        S.WAIT.name: "RuntimeStatsIntervalId",
    }
    for table in LOAD_ORDER:
        odd = F.col(halves[table.name]) % 2 == 1
        warehouse.append(table, f.table(table).filter(odd))
        warehouse.append(table, f.table(table).filter(~odd))
    return extract.combine([
        warehouse.read(table).groupBy("TenantName").agg(
            F.count(F.lit(1)).alias("n"), F.sum(halves[table.name]).cast("long").alias("ids"))
        .withColumn("TableName", F.lit(table.name)) for table in LOAD_ORDER])


_STORED = [
    ("QueryStoreQuery", "queries", "QueryId"), ("QueryStoreQueryText", "texts", "QueryTextId"),
    ("QueryStorePlan", "plans", "PlanId"), ("RuntimeStatsInterval", "intervals", "RuntimeStatsIntervalId"),
    ("QueryStoreRuntimeStats", "rt", "RuntimeStatsIntervalId"), ("QueryStoreWaitStats", "waits", "RuntimeStatsIntervalId"),
]
CHECKS["s9_bulk_load"] = Check(
    _bulk_load,
    " UNION ALL ".join(
        f"""SELECT '{name}' AS TableName, TenantName, count(*) AS n, CAST(sum({column}) AS BIGINT) AS ids
        FROM {view} GROUP BY TenantName""" for name, view, column in _STORED),
    ["queries", "texts", "plans", "intervals", "rt", "waits"],
)
CHECKS["s10_run_totals"] = Check(
    lambda f: runlog.run_totals(f.table(S.RUN_LOG)),
    """SELECT count(*) FILTER (WHERE ExtractStatus = 'SUCCESS') AS SuccessfulExtractions,
      count(*) FILTER (WHERE ExtractStatus = 'FAILED') AS FailedExtractions,
      CAST(sum(RecordsInserted + RecordsUpdated) FILTER (WHERE ExtractStatus = 'SUCCESS') AS BIGINT) AS TotalRecordsLoaded
      FROM log""", ["log"],
)

# --- merges -----------------------------------------------------------------------

CHECKS["m1_merge_query"] = Check(
    lambda f: upsert.merge_query(
        f.table(S.QUERY).filter(F.col("QueryId") % 5 != 0),
        f.table(S.QUERY).filter(F.col("QueryId") % 2 == 0).withColumns({
            "CompilationCount": F.col("CompilationCount") + 100,
            "ContextSettingsId": F.lit(7).cast("long"),
            "AvgCompileMemoryMb": F.col("AvgCompileMemoryMb") * 2}),
        AS_OF),
    f"""SELECT * REPLACE (
        CAST(ObjectId AS BIGINT) AS ObjectId,
        CASE WHEN QueryId % 2 = 0 THEN CompilationCount + 100 ELSE CompilationCount END AS CompilationCount,
        CASE WHEN QueryId % 2 = 0 THEN AvgCompileMemoryMb * 2 ELSE AvgCompileMemoryMb END AS AvgCompileMemoryMb,
        CASE WHEN QueryId % 5 = 0 THEN CAST(7 AS BIGINT) ELSE ContextSettingsId END AS ContextSettingsId,
        CASE WHEN QueryId % 5 = 0 THEN {NOW} ELSE LoadDate END AS LoadDate)
      FROM queries WHERE QueryId % 5 <> 0 OR QueryId % 2 = 0""", ["queries"],
)
def _stored(f, table, target, staged):
    """The same merge on stored tables: what is new is appended, what differs rewritten."""
    warehouse = Warehouse(f.spark, _new_root(f))
    warehouse.create(table, target)
    merge_table(warehouse, table, staged.select(*table.staging_schema.fieldNames()), AS_OF)
    return warehouse.read(table)


CHECKS["m1_stored_merge_query"] = Check(
    lambda f: _stored(
        f, S.QUERY, f.table(S.QUERY).filter(F.col("QueryId") % 5 != 0),
        f.table(S.QUERY).filter(F.col("QueryId") % 2 == 0).withColumns({
            "CompilationCount": F.col("CompilationCount") + 100,
            "ContextSettingsId": F.lit(7).cast("long"),
            "AvgCompileMemoryMb": F.col("AvgCompileMemoryMb") * 2})),
    CHECKS["m1_merge_query"].sql, ["queries"],
)
CHECKS["m2_merge_query_text"] = Check(
    lambda f: upsert.merge_query_text(
        f.table(S.QUERY_TEXT).filter(F.col("QueryTextId") % 5 != 0),
        f.table(S.QUERY_TEXT).withColumn("QueryTextContent", F.upper("QueryTextContent")), AS_OF
    ).select(*KEYS, "QueryTextId", "QueryTextContent", "LoadDate"),
    f"""SELECT {K}, QueryTextId,
      CASE WHEN QueryTextId % 5 = 0 THEN upper(QueryTextContent) ELSE QueryTextContent END AS QueryTextContent,
      CASE WHEN QueryTextId % 5 = 0 THEN {NOW} ELSE LoadDate END AS LoadDate FROM texts""", ["texts"],
)
CHECKS["m2_stored_merge_query_text"] = Check(
    lambda f: _stored(
        f, S.QUERY_TEXT, f.table(S.QUERY_TEXT).filter(F.col("QueryTextId") % 5 != 0),
        f.table(S.QUERY_TEXT).withColumn("QueryTextContent", F.upper("QueryTextContent"))
    ).select(*KEYS, "QueryTextId", "QueryTextContent", "LoadDate"),
    CHECKS["m2_merge_query_text"].sql, ["texts"],
)
CHECKS["m3_merge_plan"] = Check(
    lambda f: upsert.merge_plan(
        f.table(S.PLAN).filter(F.col("PlanId") % 3 != 0),
        f.table(S.PLAN).filter(F.col("PlanId") % 2 == 0).withColumns({
            "LastExecutionTime": F.col("LastExecutionTime") + F.expr("INTERVAL 1 DAY"),
            "CompatibilityLevel": F.lit(999)}), AS_OF
    ).select(*PLAN_KEY, "QueryId", "CompatibilityLevel", "LastExecutionTime", "LoadDate"),
    f"""SELECT {K}, PlanId, QueryId,
      CASE WHEN PlanId % 3 = 0 THEN 999 ELSE CompatibilityLevel END AS CompatibilityLevel,
      CASE WHEN PlanId % 2 = 0 THEN LastExecutionTime + INTERVAL 1 DAY ELSE LastExecutionTime END AS LastExecutionTime,
      CASE WHEN PlanId % 3 = 0 THEN {NOW} ELSE LoadDate END AS LoadDate
      FROM plans WHERE PlanId % 3 <> 0 OR PlanId % 2 = 0""", ["plans"],
)
CHECKS["m3_stored_merge_plan"] = Check(
    lambda f: _stored(
        f, S.PLAN, f.table(S.PLAN).filter(F.col("PlanId") % 3 != 0),
        f.table(S.PLAN).filter(F.col("PlanId") % 2 == 0).withColumns({
            "LastExecutionTime": F.col("LastExecutionTime") + F.expr("INTERVAL 1 DAY"),
            "CompatibilityLevel": F.lit(999)})
    ).select(*PLAN_KEY, "QueryId", "CompatibilityLevel", "LastExecutionTime", "LoadDate"),
    CHECKS["m3_merge_plan"].sql, ["plans"],
)
CHECKS["m4_merge_interval"] = Check(
    lambda f: upsert.merge_interval(
        f.table(S.INTERVAL).filter(F.col("RuntimeStatsIntervalId") < 8000),
        f.table(S.INTERVAL).filter(F.col("RuntimeStatsIntervalId") >= 7998).withColumn(
            "IntervalDurationMinutes", F.lit(1)), AS_OF),
    f"""SELECT * REPLACE (
        CASE WHEN RuntimeStatsIntervalId >= 8000 THEN 1 ELSE IntervalDurationMinutes END AS IntervalDurationMinutes,
        CASE WHEN RuntimeStatsIntervalId >= 8000 THEN {NOW} ELSE LoadDate END AS LoadDate)
      FROM intervals""", ["intervals"],
)
CHECKS["m4_stored_merge_interval"] = Check(
    lambda f: _stored(
        f, S.INTERVAL, f.table(S.INTERVAL).filter(F.col("RuntimeStatsIntervalId") < 8000),
        f.table(S.INTERVAL).filter(F.col("RuntimeStatsIntervalId") >= 7998).withColumn(
            "IntervalDurationMinutes", F.lit(1))),
    CHECKS["m4_merge_interval"].sql, ["intervals"],
)
_RT_LIST = ", ".join(_RT_COLUMNS)
CHECKS["m5_merge_runtime_stats"] = Check(
    lambda f: upsert.merge_runtime_stats(*_split(f), AS_OF).drop("RuntimeStatsId"),
    f"""SELECT * REPLACE (
        CASE WHEN RuntimeStatsIntervalId >= 7998 THEN CountExecutions + 1 ELSE CountExecutions END AS CountExecutions,
        CASE WHEN RuntimeStatsIntervalId >= 8000 THEN {NOW} ELSE LoadDate END AS LoadDate,
        IsRegression AND RuntimeStatsIntervalId < 8000 AS IsRegression)
      FROM (SELECT {_RT_LIST} FROM rt)""", ["rt"], {"StdevDurationMs": 4},
)


def _merge_waits(f):
    raw, categories = _raw_waits(f)
    staged = extract.extract_wait_buckets(raw, _raw_runtime(f), _raw_intervals(f), categories)
    target = f.table(S.WAIT).filter(F.col("RuntimeStatsIntervalId") < 8000)
    staged = staged.filter(F.col("RuntimeStatsIntervalId") >= 7998)
    return upsert.merge_wait_stats(target, staged, AS_OF).drop("WaitStatsId", "WaitCategoryId")


CHECKS["m6_merge_wait_stats"] = Check(
    _merge_waits,
    f"""WITH key AS (SELECT DISTINCT {QK}, PlanId, RuntimeStatsIntervalId FROM rt),
      buckets AS (SELECT {QK}, PlanId, RuntimeStatsIntervalId, WaitCategory, bucket,
          sum(cents) AS t, avg(CAST(cents AS DOUBLE)) AS a, max(cents) AS m, count(*) AS n
        FROM wait_events SEMI JOIN key USING ({QK}, PlanId, RuntimeStatsIntervalId)
        WHERE RuntimeStatsIntervalId >= 7998 GROUP BY ALL),
      staged AS (SELECT {QK}, PlanId, RuntimeStatsIntervalId, WaitCategory,
          CAST(sum(t) AS BIGINT) AS t, avg(a) AS a, max(m) AS m, CAST(min(bucket) AS INTEGER) AS b,
          CAST(sum(n) AS BIGINT) AS n FROM buckets GROUP BY ALL),
      old AS (SELECT * FROM waits WHERE RuntimeStatsIntervalId < 8000)
    SELECT {QK}, PlanId, RuntimeStatsIntervalId, WaitCategory,
      coalesce(t, TotalWaitTimeMs) AS TotalWaitTimeMs, coalesce(a, AvgWaitTimeMs) AS AvgWaitTimeMs,
      coalesce(m, MaxWaitTimeMs) AS MaxWaitTimeMs,
      coalesce(QueryWaitTimeCategory, b) AS QueryWaitTimeCategory,
      coalesce(n, CountWaits) AS CountWaits, coalesce(LoadDate, {NOW}) AS LoadDate
    FROM old FULL JOIN staged USING ({QK}, PlanId, RuntimeStatsIntervalId, WaitCategory)""",
    ["wait_events", "rt", "waits"], {"AvgWaitTimeMs": 4},
)
CHECKS["m7_detect_regressions"] = Check(
    lambda f: regression.detect_plan_regressions(f.table(S.RUNTIME), None, AS_OF).drop("RegressionId"),
    f"""SELECT {QK}, OldPlanId, NewPlanId, OldAvgDurationMs, NewAvgDurationMs,
      DurationChangePercentage, {NOW} AS DetectionDate, false AS IsInvestigated,
      CAST(NULL AS VARCHAR) AS Notes FROM found""",
    ["found"], each("OldAvgDurationMs NewAvgDurationMs DurationChangePercentage", 4),
)
CHECKS["m7_detect_regressions_split_groups"] = Check(
    lambda f: regression.detect_plan_regressions(
        f.table(S.RUNTIME), f.table(S.REGRESSION), AS_OF, threshold=0.5, intervals_per_bucket=3
    ).select(*QUERY_KEY, "OldPlanId", "NewPlanId"),
    f"""SELECT {QK}, OldPlanId, NewPlanId FROM found WHERE DurationChangePercentage > 50
      EXCEPT SELECT {QK}, OldPlanId, NewPlanId FROM regs WHERE CAST(DetectionDate AS DATE) >= CAST({NOW} AS DATE)""",
    ["regs"],
)
CHECKS["m8_flag_regressions"] = Check(
    lambda f: regression.flag_regressions(
        f.table(S.RUNTIME), f.table(S.REGRESSION), "2001-10-20 12:00:00"
    ).select("RuntimeStatsId", "IsRegression"),
    f"""SELECT RuntimeStatsId, IsRegression OR (TenantName, ServerName, DatabaseName, QueryId, PlanId) IN (
        SELECT (TenantName, ServerName, DatabaseName, QueryId, NewPlanId) FROM regs
        WHERE date_diff('day', DetectionDate, TIMESTAMP '2001-10-20 12:00:00') < 1) AS IsRegression
      FROM rt""", ["rt", "regs"],
)


def _logged(f):
    target, staged = _split(f)
    actions = upsert.upsert(target, staged, S.RUNTIME, AS_OF, with_action=True)
    per_source = actions.groupBy(*KEYS).agg(
        F.count(F.when(F.col(upsert.ACTION) == "INSERT", 1)).alias("RecordsInserted"),
        F.count(F.when(F.col(upsert.ACTION) == "UPDATE", 1)).alias("RecordsUpdated"),
    )
    return runlog.log_rows(per_source, AS_OF, 12).drop("ETLControlId")


CHECKS["m9_log_rows"] = Check(
    _logged,
    f"""SELECT {K}, {NOW} AS LastExtractTime, 12 AS ExtractDurationSeconds,
      count(*) FILTER (WHERE RuntimeStatsIntervalId >= 8000) AS RecordsInserted,
      count(*) FILTER (WHERE RuntimeStatsIntervalId BETWEEN 7998 AND 7999) AS RecordsUpdated,
      'SUCCESS' AS ExtractStatus, CAST(NULL AS VARCHAR) AS ErrorMessage, {NOW} AS LoadDate
      FROM rt GROUP BY {K}""", ["rt"],
)
CHECKS["m10_merge_counts"] = Check(
    lambda f: upsert.merge_counts(*_split(f), S.RUNTIME),
    """SELECT count(*) FILTER (WHERE RuntimeStatsIntervalId >= 8000) AS RecordsInserted,
      count(*) FILTER (WHERE RuntimeStatsIntervalId BETWEEN 7998 AND 7999) AS RecordsUpdated FROM rt""",
    ["rt"],
)


def _halves(f):
    """All six tables as they were stored, and as the next run extracts them."""
    runtime, staged_runtime = _split(f)
    waits, queries, texts = f.table(S.WAIT), f.table(S.QUERY), f.table(S.QUERY_TEXT)
    plans, intervals = f.table(S.PLAN), f.table(S.INTERVAL)
    interval, recent = F.col("RuntimeStatsIntervalId"), intervals.filter("RuntimeStatsIntervalId >= 7998")
    # Two databases of a server disagree on every fifth interval.
    other = recent.filter(interval % 5 == 0).withColumn(
        "IntervalStartTime", F.col("IntervalStartTime") - F.expr("INTERVAL 1 HOUR"))
    return [
        (S.INTERVAL, intervals.filter(interval < 8000), recent.unionByName(other)),
        (S.QUERY, queries.filter(F.col("QueryId") % 5 != 0), queries.filter(F.col("QueryId") % 2 == 0).withColumn(
            "CompilationCount", F.col("CompilationCount") + 100)),
        (S.QUERY_TEXT, texts.filter(F.col("QueryTextId") % 5 != 0), texts),
        (S.PLAN, plans.filter(F.col("PlanId") % 3 != 0), plans.filter(F.col("PlanId") % 2 == 0)),
        (S.RUNTIME, runtime, staged_runtime),
        (S.WAIT, waits.filter(interval < 8000), waits.filter(interval >= 7998)),
    ]


def _load_job(f):
    """A warehouse with the older part of all tables, and an incremental load of the rest."""
    warehouse = Warehouse(f.spark, _new_root(f))
    staging = Staging(f.spark, warehouse)
    for table, target, staged in _halves(f):
        warehouse.create(table, target)
        staging.write(table, staged)
    return load(warehouse, staging, AS_OF)


_LOADED = """SELECT RuntimeStatsIntervalId >= 8000 AS new FROM rt WHERE RuntimeStatsIntervalId >= 7998
      UNION ALL SELECT RuntimeStatsIntervalId >= 8000 FROM waits WHERE RuntimeStatsIntervalId >= 7998
      UNION ALL SELECT QueryId % 5 = 0 FROM queries WHERE QueryId % 2 = 0
      UNION ALL SELECT QueryTextId % 5 = 0 FROM texts
      UNION ALL SELECT PlanId % 3 = 0 FROM plans WHERE PlanId % 2 = 0"""
CHECKS["m10_load_job"] = Check(
    _load_job,
    """SELECT count(*) FILTER (WHERE new) AS RecordsInserted,
      count(*) FILTER (WHERE NOT new) AS RecordsUpdated,
      (SELECT count(*) FROM found) AS RegressionsDetected,
      (SELECT count(*) FROM intervals WHERE RuntimeStatsIntervalId >= 7998
        AND RuntimeStatsIntervalId % 5 = 0) AS IntervalConflicts FROM staged""",
    ["rt", "waits", "queries", "texts", "plans", "intervals", "found"], extra={"staged": _LOADED},
)


def _loaded_conflicts(f):
    """The conflicts that a load of intervals stores, older rows and the extract together."""
    warehouse = Warehouse(f.spark, _new_root(f))
    staging = Staging(f.spark, warehouse)
    (_, target, staged), *_ = _halves(f)
    warehouse.create(S.INTERVAL, target.withColumn("IntervalEndTime", F.when(
        F.col("RuntimeStatsIntervalId") % 2 == 0, F.col("IntervalStartTime")).otherwise(F.col("IntervalEndTime"))))
    staging.write(S.INTERVAL, staged)
    load(warehouse, staging, AS_OF)
    return warehouse.read(S.INTERVAL_CONFLICT)


CHECKS["m10_interval_conflicts"] = Check(
    _loaded_conflicts,
    f"""SELECT TenantName, ServerName, RuntimeStatsIntervalId,
      CAST(1 + CASE WHEN RuntimeStatsIntervalId % 5 = 0 THEN 1 ELSE 0 END
        + CASE WHEN RuntimeStatsIntervalId = 7998 THEN 1 ELSE 0 END AS BIGINT) AS Versions,
      CASE WHEN RuntimeStatsIntervalId % 5 = 0 THEN IntervalStartTime - INTERVAL 1 HOUR
        ELSE IntervalStartTime END AS FirstStart,
      IntervalStartTime AS LastStart, {NOW} AS LoadDate
      FROM intervals WHERE RuntimeStatsIntervalId >= 7998
        AND (RuntimeStatsIntervalId % 5 = 0 OR RuntimeStatsIntervalId = 7998)""", ["intervals"],
)


def _expired(days, alias):
    return f"""(SELECT count(*) FROM {alias} JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)
      WHERE IntervalStartTime < {TODAY} - INTERVAL {days} DAY"""


def _cleanup_sql(days, scope, tenant):
    where = f" AND {scope})" if scope else ")"
    plan_where = f"WHERE {scope}" if scope else ""
    return f"""SELECT *, RuntimeStatistics + WaitStatistics + Intervals AS TotalRecords FROM (SELECT
      {days} AS RetentionDays, CAST({TODAY} - INTERVAL {days} DAY AS DATE) AS CutoffDate,
      '{tenant}' AS TenantFilter, 'ALL' AS ServerFilter,
      {_expired(days, 'rt')}{where} AS RuntimeStatistics,
      {_expired(days, 'waits')}{where} AS WaitStatistics,
      (SELECT count(*) FROM intervals WHERE IntervalStartTime < {TODAY} - INTERVAL {days} DAY{where} AS Intervals,
      (SELECT count(*) FROM plans ANTI JOIN rt USING ({K}, PlanId) {plan_where}) AS OrphanedPlans)"""


CHECKS["m11_cleanup_report"] = Check(
    lambda f: retention.cleanup_report(f.telemetry, AS_OF),
    _cleanup_sql(90, None, "ALL"), ["rt", "waits", "intervals", "plans"],
)
CHECKS["m11_cleanup_report_one_tenant"] = Check(
    lambda f: retention.cleanup_report(f.telemetry, AS_OF, 400, tenant="ASIA"),
    _cleanup_sql(400, "TenantName = 'ASIA'", "ASIA"), ["rt", "waits", "intervals", "plans"],
)


def _kept_counts(t):
    frames = {
        "runtime": t.runtime, "waits": t.waits, "intervals": t.intervals,
        "regressions": t.regressions, "run_log": t.run_log, "plans": t.plans,
    }
    return extract.combine([
        df.groupBy("TenantName").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
        for kind, df in frames.items()
    ])


def _kept_sql(stats, regressions, waits, run_log, plans):
    def fact(name, days):
        return f"""SELECT TenantName, count(*) AS n, '{name[1]}' AS kind FROM {name[0]}
          JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)
          WHERE IntervalStartTime >= {TODAY} - INTERVAL {days} DAY GROUP BY 1"""

    def dated(name, column, days):
        return f"""SELECT TenantName, count(*) AS n, '{name[1]}' AS kind FROM {name[0]}
          WHERE {column} >= {TODAY} - INTERVAL {days} DAY GROUP BY 1"""

    return " UNION ALL ".join([
        fact(("rt", "runtime"), stats),
        # Waits of intervals unknown to the interval table are never expired.
        f"""SELECT TenantName, count(*) AS n, 'waits' AS kind FROM waits
          LEFT JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId)
          WHERE IntervalStartTime IS NULL OR IntervalStartTime >= {TODAY} - INTERVAL {waits} DAY GROUP BY 1""",
        dated(("intervals", "intervals"), "IntervalStartTime", max(stats, waits)),
        dated(("regs", "regressions"), "DetectionDate", regressions),
        dated(("log", "run_log"), "LastExtractTime", run_log) if run_log else
        "SELECT TenantName, count(*) AS n, 'run_log' AS kind FROM log GROUP BY 1",
        f"""SELECT TenantName, count(*) AS n, 'plans' AS kind FROM plans {plans} GROUP BY 1""",
    ])


_NOT_STALE = f"""ANTI JOIN (SELECT {K}, PlanId FROM rt GROUP BY {K}, PlanId
  HAVING max(LoadDate) < {TODAY} - INTERVAL 400 DAY) USING ({K}, PlanId)"""
CHECKS["m12_cleanup_applied"] = Check(
    lambda f: _kept_counts(retention.cleanup(f.telemetry, AS_OF, 400, drop_stale_plans=True)),
    _kept_sql(400, 400, 400, None, _NOT_STALE),
    ["rt", "waits", "intervals", "regs", "log", "plans"],
)
CHECKS["m13_retention_policy"] = Check(
    lambda f: _kept_counts(retention.cleanup(
        f.telemetry, AS_OF, policy=retention.RetentionPolicy(500, 30, 400, 60))),
    _kept_sql(500, 30, 400, 60, ""), ["rt", "waits", "intervals", "regs", "log", "plans"],
)
CHECKS["m14_mark_investigated"] = Check(
    lambda f: regression.mark_investigated(
        f.table(S.REGRESSION), f.table(S.REGRESSION).agg(F.min("RegressionId")).first()[0],
        "Root cause identified").select(
        "RegressionId", "IsInvestigated", "Notes"),
    """SELECT RegressionId, IsInvestigated OR RegressionId = low AS IsInvestigated,
      CASE WHEN RegressionId = low THEN 'Root cause identified' ELSE Notes END AS Notes
    FROM regs, (SELECT min(RegressionId) AS low FROM regs)""",
    ["regs"],
)


def _plan_history(f):
    plans = f.table(S.PLAN)
    first = upsert.scd2_upsert(None, plans.filter(F.col("PlanId") % 4 != 0), "2001-11-01 00:00:00")
    changed = plans.withColumn(
        "CompatibilityLevel",
        F.when(F.col("PlanId") % 3 == 0, 170).otherwise(F.col("CompatibilityLevel")))
    return upsert.scd2_upsert(first, changed, AS_OF).select(
        *PLAN_KEY, "CompatibilityLevel", "ValidFrom", "ValidTo", "IsCurrent")


CHECKS["m15_plan_history"] = Check(
    _plan_history,
    f"""SELECT {K}, PlanId, CompatibilityLevel, TIMESTAMP '2001-11-01' AS ValidFrom,
        CASE WHEN PlanId % 3 = 0 THEN {NOW} END AS ValidTo, PlanId % 3 <> 0 AS IsCurrent
      FROM plans WHERE PlanId % 4 <> 0
      UNION ALL SELECT {K}, PlanId, CASE WHEN PlanId % 3 = 0 THEN 170 ELSE CompatibilityLevel END,
        {NOW}, CAST(NULL AS TIMESTAMP), true FROM plans WHERE PlanId % 4 = 0 OR PlanId % 3 = 0""",
    ["plans"],
)
CHECKS["m16_table_sizes"] = Check(
    lambda f: quality.storage_usage(f.telemetry).select("TableName", "RowCount"),
    " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, count(*) AS RowCount FROM {cte}"
        for name, cte in (
            ("QueryStoreQuery", "queries"), ("QueryStoreQueryText", "texts"),
            ("QueryStorePlan", "plans"), ("QueryStoreRuntimeStats", "rt"),
            ("QueryStoreWaitStats", "waits"), ("RuntimeStatsInterval", "intervals"),
            ("PlanRegressions", "regs"), ("ETLControl", "log"),
        )
    ),
    ["queries", "texts", "plans", "waits", "intervals", "regs", "log"],
)
CHECKS["m16_storage_usage"] = Check(
    lambda f: quality.storage_usage(f.telemetry).select(
        "TableName", "RowCount", (F.col("Files") > 0).alias("HasFiles"),
        (F.col("TableSizeMB") > 0).alias("HasSize")),
    " UNION ALL ".join(
        f"SELECT '{table.name}' AS TableName, count(*) AS RowCount, true AS HasFiles, true AS HasSize FROM {view}"
        for table, view in ((S.QUERY, "queries"), (S.QUERY_TEXT, "texts"), (S.PLAN, "plans"), (S.RUNTIME, "rt"),
                            (S.WAIT, "waits"), (S.INTERVAL, "intervals"), (S.REGRESSION, "regs"),
                            (S.RUN_LOG, "log"))),
    ["queries", "texts", "plans", "rt", "waits", "intervals", "regs", "log"],
)

# --- staging and interval quality, incremental refresh -----------------------------

CHECKS["d15_interval_conflicts"] = Check(
    lambda f: quality.interval_conflicts(_raw_intervals(f).select(
        *KEYS, F.col("runtime_stats_interval_id").alias("RuntimeStatsIntervalId"),
        F.when((F.col("DatabaseName") == "DB_O") & (F.col("runtime_stats_interval_id") % 5 == 0),
               F.col("start_time") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("start_time"))
        .alias("IntervalStartTime"),
        F.col("end_time").alias("IntervalEndTime"))),
    f"""SELECT TenantName, ServerName, RuntimeStatsIntervalId, count(DISTINCT s) AS Versions,
      min(s) AS FirstStart, max(s) AS LastStart
    FROM (SELECT DISTINCT {K}, RuntimeStatsIntervalId, CASE WHEN DatabaseName = 'DB_O'
        AND RuntimeStatsIntervalId % 5 = 0 THEN IntervalStartTime + INTERVAL 1 HOUR
        ELSE IntervalStartTime END AS s
      FROM rt JOIN intervals USING (TenantName, ServerName, RuntimeStatsIntervalId))
    GROUP BY 1, 2, 3 HAVING count(DISTINCT s) > 1""", ["rt", "intervals"],
)


def _twice(f):
    rt = f.table(S.RUNTIME)
    again = rt.filter(F.col("QueryId") % 10 == 3).withColumn(
        "CountExecutions", F.col("CountExecutions") + 5)
    return rt.unionByName(again)


CHECKS["d16_staging_duplicates"] = Check(
    lambda f: upsert.staging_duplicates(_twice(f), S.RUNTIME),
    f"""SELECT {QK}, RuntimeStatsIntervalId, PlanId, ExecutionType, CAST(2 AS BIGINT) AS Copies
      FROM rt WHERE QueryId % 10 = 3""", ["rt"],
)
CHECKS["d16_keep_latest"] = Check(
    lambda f: upsert.keep_latest(_twice(f), S.RUNTIME, ["CountExecutions"]).select(
        "RuntimeStatsId", "CountExecutions", "AvgDurationMs"),
    """SELECT RuntimeStatsId, CASE WHEN QueryId % 10 = 3 THEN CountExecutions + 5
      ELSE CountExecutions END AS CountExecutions, AvgDurationMs FROM rt""", ["rt"],
)
CHECKS["d16_duplicate_keys"] = Check(
    lambda f: quality.duplicate_keys(_twice(f), S.RUNTIME).agg(F.count(F.lit(1)).alias("n")),
    "SELECT count(*) AS n FROM rt WHERE QueryId % 10 = 3", ["rt"],
)
CHECKS["d_required_nulls"] = Check(
    lambda f: quality.required_null_counts(f.table(S.RUNTIME), S.RUNTIME).filter(
        F.col("NullCount") > 0).unionByName(
        quality.null_counts(f.table(S.RUNTIME), S.RUNTIME.name, ["StdevDurationMs"])),
    """SELECT 'QueryStoreRuntimeStats' AS TableName, 'StdevDurationMs' AS ColumnName,
      count(*) FILTER (WHERE StdevDurationMs IS NULL) AS NullCount FROM rt""", ["rt"],
)


def _refreshed(f):
    """Two runs over all six tables; the wait buckets of a key land in different runs."""
    root = _new_root(f)
    warehouse = Warehouse(f.spark, root)
    raw, categories = _raw_waits(f)
    buckets = extract.extract_wait_buckets(raw, _raw_runtime(f), _raw_intervals(f), categories)
    halves = {table.name: (table, target, staged) for table, target, staged in _halves(f)}
    bucket = F.col("QueryWaitTimeCategory")
    halves[S.WAIT.name] = (S.WAIT, buckets.filter(bucket == 0), buckets.filter(bucket != 0))
    for run in (1, 2):
        for table, *parts in halves.values():
            parts[run - 1].select(*table.staging_schema.fieldNames()).write.mode("append").parquet(
                f"{root}/landing/{table.name}")
        refresh_all(f.spark, warehouse, f"{root}/landing", f"{root}/checkpoint", lambda: AS_OF)
    totals = [
        (S.INTERVAL, "RuntimeStatsIntervalId"), (S.QUERY, "CompilationCount"), (S.QUERY_TEXT, "QueryTextId"),
        (S.PLAN, "PlanId"), (S.RUNTIME, "CountExecutions"), (S.WAIT, "TotalWaitTimeMs"),
        (S.REGRESSION, "NewPlanId"), (S.RUN_LOG, "RecordsInserted"),
    ]
    frames = [(table.name, warehouse.read(table), column) for table, column in totals]
    frames.append(("Flagged", warehouse.read(S.RUNTIME).filter("IsRegression"), "PlanId"))
    return extract.combine([
        df.groupBy("TenantName").agg(F.count(F.lit(1)).alias("n"), F.sum(column).cast("long").alias("total"))
        .withColumn("TableName", F.lit(name)) for name, df, column in frames])


_EARLY = f"""SELECT {QK}, OldPlanId, NewPlanId FROM (
      SELECT o.TenantName, o.ServerName, o.DatabaseName, o.QueryId, o.PlanId AS OldPlanId,
        n.PlanId AS NewPlanId, avg(o.AvgDurationMs) AS a, avg(n.AvgDurationMs) AS b
      FROM rt o JOIN rt n USING ({QK})
      WHERE o.PlanId <> n.PlanId AND o.RuntimeStatsIntervalId < n.RuntimeStatsIntervalId
        AND n.RuntimeStatsIntervalId < 8000 GROUP BY ALL) WHERE a <> 0 AND (b - a) / a > 0.25"""
_EVER = f"SELECT {QK}, OldPlanId, NewPlanId FROM found UNION SELECT * FROM early"
_WAIT_KEYS = f"""SELECT {QK}, PlanId, RuntimeStatsIntervalId, WaitCategory, min(bucket) AS first,
      CAST(sum(cents) AS BIGINT) AS total
    FROM wait_events SEMI JOIN rt USING ({QK}, PlanId, RuntimeStatsIntervalId) GROUP BY ALL"""
_INSERTED = " UNION ALL ".join([
    "SELECT TenantName, DatabaseName, ServerName, count(*) AS n FROM rt WHERE RuntimeStatsIntervalId {0} 8000 GROUP BY ALL",
    "SELECT TenantName, DatabaseName, ServerName, count(*) AS n FROM landed WHERE first {4} 0 GROUP BY ALL",
    "SELECT TenantName, DatabaseName, ServerName, count(*) AS n FROM queries WHERE QueryId % 5 {1} 0 {2} GROUP BY ALL",
    "SELECT TenantName, DatabaseName, ServerName, count(*) AS n FROM texts WHERE QueryTextId % 5 {1} 0 GROUP BY ALL",
    "SELECT TenantName, DatabaseName, ServerName, count(*) AS n FROM plans WHERE PlanId % 3 {1} 0 {3} GROUP BY ALL",
])
CHECKS["r34_incremental_refresh"] = Check(
    _refreshed,
    """SELECT 'RuntimeStatsInterval' AS TableName, TenantName, count(*) AS n,
        CAST(sum(RuntimeStatsIntervalId) AS BIGINT) AS total FROM intervals GROUP BY TenantName
      UNION ALL SELECT 'QueryStoreQuery', TenantName, count(*),
        CAST(sum(CompilationCount + CASE WHEN QueryId % 2 = 0 THEN 100 ELSE 0 END) AS BIGINT)
        FROM queries WHERE QueryId % 5 <> 0 OR QueryId % 2 = 0 GROUP BY TenantName
      UNION ALL SELECT 'QueryStoreQueryText', TenantName, count(*), CAST(sum(QueryTextId) AS BIGINT) FROM texts GROUP BY TenantName
      UNION ALL SELECT 'QueryStorePlan', TenantName, count(*), CAST(sum(PlanId) AS BIGINT)
        FROM plans WHERE PlanId % 3 <> 0 OR PlanId % 2 = 0 GROUP BY TenantName
      UNION ALL SELECT 'QueryStoreRuntimeStats', TenantName, count(*), CAST(sum(CountExecutions +
        CASE WHEN RuntimeStatsIntervalId >= 7998 THEN 1 ELSE 0 END) AS BIGINT) FROM rt GROUP BY TenantName
      UNION ALL SELECT 'QueryStoreWaitStats', TenantName, count(*), CAST(sum(total) AS BIGINT) FROM landed GROUP BY TenantName
      UNION ALL SELECT 'PlanRegressions', TenantName, count(*), CAST(sum(NewPlanId) AS BIGINT) FROM ever GROUP BY TenantName
      UNION ALL SELECT 'ETLControl', TenantName, count(*), CAST(sum(n) AS BIGINT) FROM runs GROUP BY TenantName
      UNION ALL SELECT 'Flagged', TenantName, count(*), CAST(sum(PlanId) AS BIGINT) FROM rt
        SEMI JOIN (SELECT TenantName, ServerName, DatabaseName, QueryId, NewPlanId AS PlanId FROM ever)
        USING (TenantName, ServerName, DatabaseName, QueryId, PlanId) GROUP BY TenantName""",
    ["rt", "wait_events", "queries", "texts", "plans", "intervals", "found"],
    extra={
        "early": _EARLY, "ever": _EVER, "landed": _WAIT_KEYS,
        "runs": "SELECT TenantName, ServerName, DatabaseName, run, sum(n) AS n FROM ("
                + f"SELECT 1 AS run, * FROM ({_INSERTED.format('<', '<>', '', '', '=')}) UNION ALL SELECT 2, * FROM ("
                + _INSERTED.format(">=", "=", "AND QueryId % 2 = 0", "AND PlanId % 2 = 0", "<>")
                + ")) GROUP BY ALL",
    },
)
