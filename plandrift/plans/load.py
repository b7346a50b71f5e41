"""The load job: extract, stage, merge, detect, flag, log; and the retention job.

Each step ends in a written table, so no step depends on cached data and a
failed run can be repeated from the start: merges are idempotent.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from plandrift import schemas as S
from plandrift.functions.columns import AsOf, as_of_column, pinned
from plandrift.operators.quality import interval_conflicts
from plandrift.operators.regression import (
    DEFAULT_THRESHOLD, detect_from_states, detected_today, flag_regressions, mark_investigated,
    plan_states,
)
from plandrift.operators.retention import RetentionPolicy, cleanup, expired_intervals
from plandrift.operators.rollup import daily_states
from plandrift.operators.runlog import failed_rows, log_rows, merge_result
from plandrift.operators.upsert import (
    collapse_wait_buckets, inserted_rows, keep_latest, merge_marks, staging_duplicates, upsert,
)
from plandrift.schemas import INTERVAL_KEY, KEYS, QUERY_KEY, Table
from plandrift.sources.warehouse import Warehouse, shared_dir

# Dimensions first, so that no fact is ever visible without its dimensions.
LOAD_ORDER = (S.INTERVAL, S.QUERY, S.QUERY_TEXT, S.PLAN, S.RUNTIME, S.WAIT)


class DuplicateStagingRows(ValueError):
    """An extract holds several rows for one key, so the merge would be ambiguous."""


@dataclass(frozen=True)
class SourceResult:
    tenant: str
    server: str
    database: str
    status: str
    seconds: float
    records: int = 0
    error: str | None = None


class Staging:
    """Extracted rows of one run, written before any merge.

    Every source has its own folder below a table's, since sources are written
    at the same time. A table no source delivered has no folder.
    """

    def __init__(self, spark: SparkSession, warehouse: Warehouse, run_id: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.root = f"{warehouse.root}/_staging/{self.run_id}"

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def _filesystem(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def write(self, table: Table, rows: DataFrame, source: str = "all") -> int:
        """Write the rows of one source and return how many they were.

        Counting the written files reads only their footers.
        """
        path = f"{self.path(table)}/{source}"
        rows.select(*table.staging_schema.fieldNames()).write.mode("append").parquet(path)
        return self.spark.read.schema(table.staging_schema).parquet(path).count()

    def discard(self, source: str) -> None:
        """Remove what a failed source had already written."""
        for table in LOAD_ORDER:
            fs, path = self._filesystem(f"{self.path(table)}/{source}")
            fs.delete(path, True)

    def clear(self) -> None:
        """Remove the staged rows once they are merged; a failed run keeps them."""
        fs, path = self._filesystem(self.root)
        fs.delete(path, True)

    def has(self, table: Table) -> bool:
        fs, path = self._filesystem(self.path(table))
        return fs.exists(path) and len(fs.listStatus(path)) > 0

    def read(self, table: Table) -> DataFrame:
        reader = self.spark.read.schema(table.staging_schema).option("recursiveFileLookup", True)
        return reader.parquet(self.path(table))


def stage_sources(
    staging: Staging,
    sources: Sequence[Row],
    extract: Callable[[Row], Mapping[str, DataFrame]],
    parallel: int = 4,
) -> list[SourceResult]:
    """Extract every source and stage its rows; one failing source stops no other.

    A source that fails part of the way contributes nothing.
    """
    def run(source: Row) -> SourceResult:
        started, folder = time.monotonic(), uuid.uuid4().hex
        names = (source.TenantName, source.ServerName, source.DatabaseName)
        try:
            extracts = extract(source)
            records = sum(
                staging.write(table, extracts[table.name], folder)
                for table in LOAD_ORDER if table.name in extracts
            )
        except Exception as problem:  # noqa: BLE001 - recorded, and the next source goes on
            staging.discard(folder)
            reason = str(problem).splitlines()[0]
            return SourceResult(*names, "FAILED", time.monotonic() - started, error=reason)
        return SourceResult(*names, "SUCCESS", time.monotonic() - started, records)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(run, sources))


def merge_table(warehouse: Warehouse, table: Table, staged: DataFrame, as_of: AsOf) -> DataFrame:
    """Merge staged rows into the stored table; inserted and updated rows per source.

    Keys and updatable columns are compared first. New rows are appended, and only
    partitions in which a value differs are rewritten, so texts, plans and
    intervals are never rewritten by a load: the one column of plans that changes
    is merged into the small activity table. Every database of a server delivers
    the server's intervals; should they disagree, the later start is kept
    (``record_interval_conflicts`` stores such ids).
    """
    as_of = pinned(warehouse.spark, as_of)
    if table is S.WAIT:
        staged = collapse_wait_buckets(staged)
    elif table is S.INTERVAL:
        staged = keep_latest(staged, table, ["IntervalStartTime"])
    clash = staging_duplicates(staged, table).limit(1).collect()
    if clash:
        raise DuplicateStagingRows(f"{table.name}: {clash[0].asDict()}")
    source = [k for k in KEYS if k in table.columns]
    partitions = warehouse.touched(staged, table)
    known = sorted(set(partitions) & set(warehouse.stored(table)))
    compared = [] if table is S.PLAN else table.update
    # Checkpointed, as the writes below replace files that it is read from.
    shared_dir(warehouse.spark)
    target = warehouse.read(table, known, stored=True)
    marks = merge_marks(target, staged, table, compared).checkpoint()
    counts = marks.groupBy(*source).agg(
        F.count(F.when(~F.col("Known"), 1)).alias("RecordsInserted"),
        F.count(F.when(F.col("Known"), 1)).alias("RecordsUpdated"),
    )
    rewritten = warehouse.touched(marks.filter("Changed"), table) if compared and known else []
    added = marks.filter(~F.col("Known"))
    if rewritten:
        rows = warehouse.within(staged, table, rewritten)
        warehouse.replace_partitions(table, upsert(warehouse.read(table, rewritten, stored=True), rows, table, as_of))
        added = warehouse.within(added, table, rewritten, inside=False)
    if not added.isEmpty():
        new = staged if not known else staged.join(added, table.keys, "left_semi")
        warehouse.append(table, inserted_rows(new, table, as_of))
    if table is S.PLAN:
        merge_table(warehouse, S.PLAN_ACTIVITY, staged.select(*S.PLAN_ACTIVITY.columns), as_of)
    return counts


def record_interval_conflicts(warehouse: Warehouse, staged: DataFrame, as_of: AsOf) -> int:
    """Store the interval ids whose times differ within the extracts or from what is stored.

    Call before the intervals are merged. Returns the number of ids.
    """
    columns = [*INTERVAL_KEY, "IntervalStartTime", "IntervalEndTime"]
    earlier = warehouse.read(S.INTERVAL, warehouse.touched(staged, S.INTERVAL)).select(*columns).join(
        staged.select(*INTERVAL_KEY).distinct(), INTERVAL_KEY, "left_semi")
    found = interval_conflicts(staged.select(*columns).unionByName(earlier)).withColumn(
        "LoadDate", as_of_column(as_of)).select(*S.INTERVAL_CONFLICT.columns).checkpoint()
    n = found.count()
    if n:
        warehouse.append(S.INTERVAL_CONFLICT, found)
    return n


def renew_states(
    warehouse: Warehouse, partitions: Iterable[tuple] = (), table: Table = S.PLAN_STATE
) -> None:
    """Summarise the given runtime partitions again, and those without a summary.

    ``table`` is ``PLAN_STATE`` or ``RUNTIME_DAILY``. Summaries of partitions that are
    gone are dropped, so the stored states always follow from the stored runtime
    rows, whoever wrote them.
    """
    runtime, states = set(warehouse.stored(S.RUNTIME)), set(warehouse.stored(table))
    warehouse.drop_partitions(table, sorted(states - runtime))
    stale = sorted((runtime - states) | (set(partitions) & runtime))
    if stale:
        rows = warehouse.read(S.RUNTIME, stale)
        daily = table is S.RUNTIME_DAILY
        summary = daily_states(rows, warehouse.read(S.INTERVAL)) if daily else plan_states(rows)
        warehouse.replace_partitions(table, summary)


def detect_and_flag(
    warehouse: Warehouse, sources: DataFrame, as_of: AsOf, threshold: float = DEFAULT_THRESHOLD,
    touched: Iterable[tuple] | None = None,
) -> int:
    """Record new regressions of the given sources and flag their runtime rows.

    Both follow from the stored summaries, renewed for the ``touched`` runtime
    partitions (all by default); runtime rows are read only where some are flagged.
    The daily states of touched and flagged partitions are renewed last.
    """
    as_of = pinned(warehouse.spark, as_of)
    touched = warehouse.stored(S.RUNTIME) if touched is None else list(touched)
    renew_states(warehouse, touched)
    ours = lambda df: df.join(sources, KEYS, "left_semi")
    states = ours(warehouse.read(S.PLAN_STATE))
    existing = ours(detected_today(warehouse.read(S.REGRESSION), as_of))
    warehouse.append(S.REGRESSION, detect_from_states(states, existing, as_of, threshold))
    recorded = ours(detected_today(warehouse.read(S.REGRESSION), as_of))
    new = recorded.filter(F.col("DetectionDate") == as_of_column(as_of)).count()
    regressed = recorded.select(*QUERY_KEY, F.col("NewPlanId").alias("PlanId"))
    # Where those plans have rows follows from the summaries; flags are read there only.
    known = states.join(regressed, [*QUERY_KEY, "PlanId"], "left_semi")
    unflagged = warehouse.read(S.RUNTIME, warehouse.touched(known, S.RUNTIME)).filter(
        ~F.col("IsRegression")).join(regressed, [*QUERY_KEY, "PlanId"], "left_semi")
    partitions = warehouse.touched(unflagged, S.RUNTIME)
    if partitions:
        rows = warehouse.read(S.RUNTIME, partitions)
        warehouse.replace_partitions(S.RUNTIME, flag_regressions(rows, recorded, as_of))
    # Daily states hold the flags, so they come after them.
    renew_states(warehouse, {*touched, *partitions}, S.RUNTIME_DAILY)
    return new


def merge_staged(warehouse: Warehouse, staging: Staging, tables: Sequence[Table], as_of: AsOf) -> dict[str, DataFrame]:
    """Merge the tables' staged rows; counts by table. Dimensions come before facts,
    and the tables of either kind side by side, as they share nothing."""
    def merge(table: Table) -> tuple[str, DataFrame]:
        return table.name, merge_table(warehouse, table, staging.read(table), as_of)

    counts: dict[str, DataFrame] = {}
    for facts in (False, True):
        kind = [table for table in tables if table.by_interval == facts]
        with ThreadPoolExecutor(max_workers=max(1, len(kind))) as pool:
            counts.update(pool.map(merge, kind))
    return counts


def load(
    warehouse: Warehouse, staging: Staging, as_of: AsOf, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Merge everything staged, detect regressions, write the run log.

    Returns inserted, updated, regression and interval-conflict counts of the run.
    """
    spark, started = warehouse.spark, time.monotonic()
    as_of = pinned(spark, as_of)
    tables = [table for table in LOAD_ORDER if staging.has(table)]
    of_source = [table for table in tables if table is not S.INTERVAL]
    sources = reduce(
        DataFrame.unionByName, [staging.read(table).select(*KEYS).distinct() for table in of_source]
    ).distinct() if of_source else None
    shared_dir(spark)
    try:
        conflicts = record_interval_conflicts(warehouse, staging.read(S.INTERVAL), as_of) if S.INTERVAL in tables else 0
        counts = merge_staged(warehouse, staging, tables, as_of)
        regressions, touched = 0, []
        if staging.has(S.RUNTIME):
            touched = warehouse.touched(staging.read(S.RUNTIME), S.RUNTIME)
            regressions = detect_and_flag(warehouse, sources, as_of, threshold, touched)
        if S.INTERVAL in tables:
            # Rows loaded before their interval get their date now.
            dated = set(warehouse.touched(staging.read(S.INTERVAL), S.RUNTIME)) - set(touched)
            renew_states(warehouse, dated, S.RUNTIME_DAILY)
    except Exception as problem:
        if sources is not None:
            seconds = int(time.monotonic() - started)
            reason = str(problem).splitlines()[0]
            warehouse.append(S.RUN_LOG, failed_rows(sources, as_of, seconds, reason, staging.run_id))
        raise
    # Intervals belong to a server; they count only if there is no source to log.
    logged = of_source or tables
    if not logged:
        return merge_result(spark, 0, 0, 0, 0)
    merged = reduce(DataFrame.unionByName, [
        counts[table.name].select("RecordsInserted", "RecordsUpdated", *keys)
        for table in logged for keys in [KEYS if of_source else []]
    ])
    if of_source:
        merged = merged.groupBy(*KEYS).agg(
            F.sum("RecordsInserted").alias("RecordsInserted"),
            F.sum("RecordsUpdated").alias("RecordsUpdated"),
        )
        seconds = int(time.monotonic() - started)
        warehouse.append(S.RUN_LOG, log_rows(merged, as_of, seconds, run_id=staging.run_id))
    totals = merged.agg(
        F.sum("RecordsInserted").alias("inserted"), F.sum("RecordsUpdated").alias("updated")
    ).first()
    return merge_result(spark, totals.inserted or 0, totals.updated or 0, regressions, conflicts)


def log_failed_sources(
    warehouse: Warehouse, results: Sequence[SourceResult], as_of: AsOf, run_id: str = ""
) -> None:
    """Run-log rows for sources whose extraction failed, in one write."""
    failed = [(r.tenant, r.server, r.database, int(r.seconds), r.error) for r in results if r.status == "FAILED"]
    if not failed:
        return
    rows = warehouse.spark.createDataFrame(
        failed, "TenantName string, ServerName string, DatabaseName string, seconds int, error string")
    logged = failed_rows(rows, as_of, 0, "", run_id).drop("ExtractDurationSeconds", "ErrorMessage")
    warehouse.append(S.RUN_LOG, logged.join(rows, KEYS).withColumnsRenamed(
        {"seconds": "ExtractDurationSeconds", "error": "ErrorMessage"}))


def record_investigation(warehouse: Warehouse, regression_id: int, note: str) -> None:
    """Mark a stored regression as investigated; rewrites only its tenant."""
    stored = warehouse.read(S.REGRESSION)
    partitions = warehouse.touched(stored.filter(F.col("RegressionId") == regression_id), S.REGRESSION)
    if partitions:
        rows = warehouse.read(S.REGRESSION, partitions)
        warehouse.replace_partitions(S.REGRESSION, mark_investigated(rows, regression_id, note))


def apply_retention(
    warehouse: Warehouse,
    as_of: AsOf,
    retention_days: int = 90,
    tenant: str | None = None,
    server: str | None = None,
    policy: RetentionPolicy | None = None,
    drop_stale_plans: bool = False,
) -> None:
    """Delete expired rows from the stored tables.

    Which fact partitions can hold expired rows follows from the interval
    table alone, so recent partitions are not even read. A partition left
    without rows is dropped. Intervals go last: they decide what is expired.
    """
    as_of = pinned(warehouse.spark, as_of)
    t = warehouse.telemetry()
    policy_days = policy or RetentionPolicy(retention_days, retention_days, retention_days, 0)
    scoped = {"tenant": tenant, "server": server}

    def fact_partitions(table: Table, days: int) -> list[tuple]:
        return warehouse.touched(expired_intervals(t.intervals, as_of, days, **scoped), table)

    runtime_parts = fact_partitions(S.RUNTIME, policy_days.stats_days)
    wait_parts = fact_partitions(S.WAIT, policy_days.wait_days)
    narrowed = replace(
        t,
        runtime=warehouse.read(S.RUNTIME, runtime_parts),
        waits=warehouse.read(S.WAIT, wait_parts),
    )
    # Plans are judged against all runtime rows, before any of them is deleted.
    kept_plans = cleanup(t, as_of, retention_days, tenant, server, policy, drop_stale_plans).plans
    kept = cleanup(narrowed, as_of, retention_days, tenant, server, policy)

    def tenants(df: DataFrame, table: Table) -> list[tuple]:
        scope = df if tenant is None else df.filter(F.col("TenantName") == tenant)
        return warehouse.touched(scope, table)

    if drop_stale_plans:
        _rewrite(warehouse, S.PLAN, kept_plans, tenants(t.plans, S.PLAN))
    _rewrite(warehouse, S.RUNTIME, kept.runtime, runtime_parts)
    renew_states(warehouse, runtime_parts)
    renew_states(warehouse, runtime_parts, S.RUNTIME_DAILY)
    _rewrite(warehouse, S.WAIT, kept.waits, wait_parts)
    # Landed buckets leave when the whole partition has.
    gone = set(wait_parts) - set(warehouse.stored(S.WAIT))
    warehouse.drop_partitions(S.WAIT_BUCKET, sorted(gone))
    _rewrite(warehouse, S.REGRESSION, kept.regressions, tenants(t.regressions, S.REGRESSION))
    if policy is not None:
        _rewrite(warehouse, S.RUN_LOG, kept.run_log, tenants(t.run_log, S.RUN_LOG))
    _rewrite(warehouse, S.INTERVAL, kept.intervals, tenants(t.intervals, S.INTERVAL))


def _rewrite(
    warehouse: Warehouse, table: Table, survivors: DataFrame, partitions: list[tuple]
) -> None:
    """Replace the given partitions by their surviving rows."""
    if not partitions:
        return
    rows = survivors.filter(
        F.col("TenantName").isin(sorted({tenant for tenant, *_ in partitions}))
    )
    remaining = set(warehouse.touched(rows, table))
    emptied = [p for p in partitions if p not in remaining]
    if remaining:
        warehouse.replace_partitions(table, rows)
    warehouse.drop_partitions(table, emptied)
