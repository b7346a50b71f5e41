"""Table definitions of the telemetry warehouse.

Every table has a fixed schema, a natural key that a merge matches on, the
columns a merge may overwrite, and the physical layout it is stored with.
Keys are checked by jobs (see ``operators.quality``); Parquet enforces none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEYS = ["TenantName", "ServerName", "DatabaseName"]
QUERY_KEY = [*KEYS, "QueryId"]
PLAN_KEY = [*KEYS, "PlanId"]
INTERVAL_KEY = ["TenantName", "ServerName", "RuntimeStatsIntervalId"]

# An extraction re-reads the newest 100 intervals of a source, so with buckets
# of the same width a merge rewrites at most two buckets per tenant.
INTERVALS_PER_BUCKET = 100
BUCKET_COLUMN = "IntervalBucket"

# Queries and plans get ascending ids, so ranges of ids are ranges of age: what a
# load updates lies in few of them.
IDS_PER_BUCKET = 10_000
ID_BUCKET_COLUMN = "IdBucket"

# Rows kept per landed batch replace themselves if the batch is repeated.
BATCH_COLUMN = "LandingBatch"

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
    "series": T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("d", T.DoubleType())])),
}


def _struct(*columns: str) -> T.StructType:
    """Build a schema from ``"Name type"`` items; a ``?`` marks a nullable column."""
    fields = []
    for column in columns:
        name, kind = column.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


def _keys() -> list[str]:
    return [f"{k} string" for k in KEYS]


def _avg_max_min(metric: str, kind: str) -> list[str]:
    return [f"{stat}{metric} {kind}" for stat in ("Avg", "Max", "Min")]


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    keys: list[str]
    update: list[str] = field(default_factory=list)
    surrogate: str | None = None
    by_interval: bool = False
    by_id: str | None = None
    by_batch: bool = False

    @property
    def bucket(self) -> tuple[str, str, int] | None:
        """Partition column below the tenant, the id it is a range of, and its width."""
        if self.by_interval:
            return BUCKET_COLUMN, "RuntimeStatsIntervalId", INTERVALS_PER_BUCKET
        if self.by_id:
            return ID_BUCKET_COLUMN, self.by_id, IDS_PER_BUCKET
        return None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def partitions(self) -> list[str]:
        below = [self.bucket[0]] if self.bucket else []
        return ["TenantName", *below, *([BATCH_COLUMN] if self.by_batch else [])]

    @property
    def staging_schema(self) -> T.StructType:
        """Columns an extract delivers: no surrogate, load date or regression flag."""
        own = {self.surrogate, "LoadDate", "IsRegression"}
        return T.StructType([f for f in self.schema.fields if f.name not in own])


INTERVAL = Table(
    "RuntimeStatsInterval",
    _struct(
        "TenantName string", "ServerName string", "RuntimeStatsIntervalId int",
        "IntervalStartTime timestamp", "IntervalEndTime timestamp",
        "IntervalDurationMinutes int", "CapturedDate date", "CapturedTime string",
        "LoadDate timestamp",
    ),
    keys=INTERVAL_KEY,
)

QUERY = Table(
    "QueryStoreQuery",
    _struct(
        *_keys(), "QueryId long", "QueryTextId long", "ContextSettingsId long",
        "ObjectId long?", "CompilationStartTime timestamp", "CompilationEndTime timestamp",
        "LastCompilationBatch long", "LastCompilationBatchUTC timestamp",
        "CompilationCount long", "AvgCompileCpuTimeMs double", "MaxCompileCpuTimeMs double",
        "AvgCompileMemoryMb double", "MaxCompileMemoryMb double", "LoadDate timestamp",
    ),
    keys=QUERY_KEY,
    update=[
        "CompilationCount", "AvgCompileCpuTimeMs", "MaxCompileCpuTimeMs",
        "AvgCompileMemoryMb", "MaxCompileMemoryMb", "CompilationEndTime",
        "LastCompilationBatchUTC",
    ],
    by_id="QueryId",
)

QUERY_TEXT = Table(
    "QueryStoreQueryText",
    _struct(
        *_keys(), "QueryTextId long", "QueryTextContent string", "StatementType string?",
        "QueryHash binary?", "QueryPlanHash binary?", "LoadDate timestamp",
    ),
    keys=[*KEYS, "QueryTextId"],
)

PLAN = Table(
    "QueryStorePlan",
    _struct(
        *_keys(), "PlanId long", "QueryId long", "EngineVersion string",
        "CompatibilityLevel int", "QueryPlanHash binary?", "QueryHash binary?",
        "PlanHandle binary?", "CreationTime timestamp", "LastExecutionTime timestamp",
        "QueryPlanCompressed binary?", "QueryPlanText string?",
        "IsOnlineIndexPlan boolean?", "IsParallelizable boolean?", "LoadDate timestamp",
    ),
    keys=PLAN_KEY,
    update=["LastExecutionTime"],
)

# The one column of plans that changes, apart from them: plans are appended only.
PLAN_ACTIVITY = Table(
    "QueryStorePlanActivity",
    _struct(*_keys(), "PlanId long", "LastExecutionTime timestamp"),
    keys=PLAN_KEY,
    update=["LastExecutionTime"],
    by_id="PlanId",
)

# Interval ids that a load was given with several times; the latest start was kept.
INTERVAL_CONFLICT = Table(
    "RuntimeStatsIntervalConflict",
    _struct(
        "TenantName string", "ServerName string", "RuntimeStatsIntervalId int", "Versions long",
        "FirstStart timestamp", "LastStart timestamp", "LoadDate timestamp",
    ),
    keys=[*INTERVAL_KEY, "LoadDate"],
)

_RUNTIME_METRICS = [
    "CountExecutions long",
    *_avg_max_min("DurationMs", "double"),
    "StdevDurationMs double?",
    *_avg_max_min("LogicalIoReads", "long"),
    *_avg_max_min("LogicalIoWrites", "long"),
    *_avg_max_min("PhysicalIoReads", "long"),
    *_avg_max_min("CpuTimeMs", "double"),
    *_avg_max_min("ClrTimeMs", "double"),
    *_avg_max_min("ElapsedTimeMs", "double"),
    *_avg_max_min("MemoryUsedMb", "double"),
    "AvgRowCount double", "MaxRowCount long", "MinRowCount long",
]

RUNTIME = Table(
    "QueryStoreRuntimeStats",
    _struct(
        "RuntimeStatsId long", *_keys(), "RuntimeStatsIntervalId int", "QueryId long",
        "PlanId long", "ExecutionType int", "ExecutionTypeDesc string",
        *_RUNTIME_METRICS, "LoadDate timestamp", "IsRegression boolean",
    ),
    keys=[*KEYS, "RuntimeStatsIntervalId", "QueryId", "PlanId", "ExecutionType"],
    update=[m.split()[0] for m in _RUNTIME_METRICS],
    surrogate="RuntimeStatsId",
    by_interval=True,
)

WAIT = Table(
    "QueryStoreWaitStats",
    _struct(
        "WaitStatsId long", *_keys(), "RuntimeStatsIntervalId int", "QueryId long",
        "PlanId long", "WaitCategory string", "WaitCategoryId int", "TotalWaitTimeMs long",
        "AvgWaitTimeMs double", "MaxWaitTimeMs long", "QueryWaitTimeCategory int",
        "CountWaits long", "LoadDate timestamp",
    ),
    keys=[*KEYS, "RuntimeStatsIntervalId", "QueryId", "PlanId", "WaitCategory"],
    update=["TotalWaitTimeMs", "AvgWaitTimeMs", "MaxWaitTimeMs", "CountWaits"],
    surrogate="WaitStatsId",
    by_interval=True,
)

# Wait buckets as they landed. Those of one key can land in several batches; the
# key's waits are summed over all of them (see ``streaming.ingest``).
WAIT_BUCKET = Table(
    "QueryStoreWaitBuckets",
    T.StructType([
        *[f for f in WAIT.schema.fields if f.name not in ("WaitStatsId", "LoadDate")],
        T.StructField(BATCH_COLUMN, T.LongType(), False),
    ]),
    keys=[*WAIT.keys, "QueryWaitTimeCategory", BATCH_COLUMN],
    by_interval=True,
    by_batch=True,
)

# Summaries of runtime rows per plan and bucket of intervals, from which plan
# regressions are found (see ``operators.regression``). The interval id is the
# first of the bucket; a load renews the buckets it touched.
PLAN_STATE = Table(
    "PlanBucketStates",
    _struct(
        *_keys(), "QueryId long", "PlanId long", "RuntimeStatsIntervalId int", "StateRows long",
        "DurationSum double", "FastestMs double", "SlowestMs double",
        "FirstInterval int", "LastInterval int", "Series series",
    ),
    keys=[*KEYS, "RuntimeStatsIntervalId", "QueryId", "PlanId"],
    by_interval=True,
)

_DAILY_MEANS = {
    "AvgDurationSeconds": "double", "AvgCpuTimeSeconds": "double", "AvgLogicalIoReads": "long",
    "AvgPhysicalIoReads": "long", "AvgMemoryUsedMb": "double", "AvgDurationMs": "double",
    "AvgCpuTimeMs": "double", "AvgRowCount": "double", "AvgLogicalIoWrites": "long",
}
_DAILY_FLAGS = ["slow", "high_memory", "high_io", "critical", "index_review", "regressed"]

# States of all runtime measures per plan and day (see ``operators.rollup``), kept in
# the partitions of the runtime rows they follow from. Rows whose interval is not
# known yet have no date.
RUNTIME_DAILY = Table(
    "RuntimeDailyStates",
    _struct(
        *_keys(), "QueryId long", "PlanId long", "RuntimeStatsIntervalId int", "IntervalDate date?",
        *[f"sum_{c} {kind}?" for c, kind in _DAILY_MEANS.items()],
        *[f"count_{c} long" for c in _DAILY_MEANS],
        "sum_CountExecutions long?", "sum_weighted_cpu double?", "sum_regressed_rows long?",
        "max_MaxDurationMs double?", "max_MaxCpuTimeMs double?",
        *[f"max_{name} int" for name in _DAILY_FLAGS],
    ),
    keys=[*KEYS, "RuntimeStatsIntervalId", "QueryId", "PlanId", "IntervalDate"],
    by_interval=True,
)

RUN_LOG = Table(
    "ETLControl",
    _struct(
        "ETLControlId long", *_keys(), "LastExtractTime timestamp",
        "ExtractDurationSeconds int", "RecordsInserted long", "RecordsUpdated long",
        "ExtractStatus string", "ErrorMessage string?", "LoadDate timestamp",
    ),
    keys=[*KEYS, "ETLControlId"],
    surrogate="ETLControlId",
)

REGRESSION = Table(
    "PlanRegressions",
    _struct(
        "RegressionId long", *_keys(), "QueryId long", "OldPlanId long", "NewPlanId long",
        "OldAvgDurationMs double", "NewAvgDurationMs double",
        "DurationChangePercentage double", "DetectionDate timestamp",
        "IsInvestigated boolean", "Notes string?",
    ),
    keys=[*QUERY_KEY, "OldPlanId", "NewPlanId", "DetectionDate"],
    update=["IsInvestigated", "Notes"],
    surrogate="RegressionId",
)

TABLES = {
    t.name: t
    for t in (INTERVAL, QUERY, QUERY_TEXT, PLAN, RUNTIME, WAIT, RUN_LOG, REGRESSION)
}
