"""Incremental merges: update matched rows, insert new ones, keep the rest.

A merge is one full outer join on the natural key, so each side is shuffled
once and every row of both sides is seen exactly once. Natural keys are unique,
hence no key can become hot. Stored tables are merged by ``plans.load``, which
joins keys and compared values only, appends what is new and rewrites no
partition in which nothing changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plandrift import schemas as S
from plandrift.functions.columns import AsOf, as_of_column
from plandrift.schemas import Table

ACTION = "MergeAction"


def upsert(
    target: DataFrame, staging: DataFrame, table: Table, as_of: AsOf, with_action: bool = False
) -> DataFrame:
    """``target`` after merging ``staging``; idempotent for the same ``as_of``.

    Matched rows take the staging value of the updatable columns and keep all
    else, load date included. ``with_action`` adds INSERT, UPDATE or KEEP.
    """
    incoming = [f.name for f in table.staging_schema.fields if f.name not in table.keys]
    old = target.select(*table.columns, F.lit(True).alias("_in_target"))
    new = staging.select(
        *table.keys, *[F.col(c).alias(f"_new_{c}") for c in incoming], F.lit(True).alias("_in_staging")
    )
    joined = old.join(new, table.keys, "full_outer")
    in_target, in_staging = F.col("_in_target").isNotNull(), F.col("_in_staging").isNotNull()

    inserted = {"LoadDate": as_of_column(as_of), "IsRegression": F.lit(False)}
    if table.surrogate:
        inserted[table.surrogate] = F.xxhash64(*table.keys)
    merged = []
    for name in table.columns:
        if name in table.keys:
            merged.append(F.col(name))
        elif name in table.update:
            merged.append(F.when(in_staging, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        else:
            value = inserted.get(name, F.col(f"_new_{name}") if name in incoming else None)
            merged.append(F.when(in_target, F.col(name)).otherwise(value).alias(name))
    if with_action:
        action = (
            F.when(in_target & in_staging, "UPDATE").when(in_staging, "INSERT").otherwise("KEEP")
        )
        merged.append(action.alias(ACTION))
    return joined.select(*merged)


def inserted_rows(staging: DataFrame, table: Table, as_of: AsOf) -> DataFrame:
    """Staged rows as a merge inserts them."""
    own = {"LoadDate": as_of_column(as_of), "IsRegression": F.lit(False)}
    if table.surrogate:
        own[table.surrogate] = F.xxhash64(*table.keys)
    return staging.select(*[own[c].alias(c) if c in own else F.col(c) for c in table.columns])


def merge_marks(target: DataFrame, staging: DataFrame, table: Table, compared: list[str]) -> DataFrame:
    """Keys of ``staging`` with whether the target has them, and whether a compared value differs."""
    old = target.select(*table.keys, *[F.col(c).alias(f"_old_{c}") for c in compared], F.lit(True).alias("Known"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return staging.select(*table.keys, *compared).join(old, table.keys, "left").select(
        *table.keys, F.coalesce("Known", F.lit(False)).alias("Known"),
        (F.col("Known").isNotNull() & ~same).alias("Changed"),
    )


def merge_query(target, staging, as_of) -> DataFrame:
    return upsert(target, staging, S.QUERY, as_of)


def merge_query_text(target, staging, as_of) -> DataFrame:
    return upsert(target, staging, S.QUERY_TEXT, as_of)


def merge_plan(target, staging, as_of) -> DataFrame:
    return upsert(target, staging, S.PLAN, as_of)


def merge_interval(target, staging, as_of) -> DataFrame:
    return upsert(target, staging, S.INTERVAL, as_of)


def merge_runtime_stats(target, staging, as_of) -> DataFrame:
    return upsert(target, staging, S.RUNTIME, as_of)


def merge_wait_stats(target, staging, as_of) -> DataFrame:
    """Wait extracts hold one row per duration bucket; the merge key has none."""
    return upsert(target, collapse_wait_buckets(staging), S.WAIT, as_of)


def collapse_wait_buckets(staging: DataFrame) -> DataFrame:
    """Fold bucket rows to the merge key: totals add up, averages average.

    The category id and bucket of a key are the smallest ones seen.
    """
    return staging.groupBy(*S.WAIT.keys).agg(
        F.min("WaitCategoryId").alias("WaitCategoryId"),
        F.sum("TotalWaitTimeMs").alias("TotalWaitTimeMs"),
        F.avg("AvgWaitTimeMs").alias("AvgWaitTimeMs"),
        F.max("MaxWaitTimeMs").alias("MaxWaitTimeMs"),
        F.min("QueryWaitTimeCategory").alias("QueryWaitTimeCategory"),
        F.sum("CountWaits").alias("CountWaits"),
    )


def merge_counts(target: DataFrame, staging: DataFrame, table: Table) -> DataFrame:
    """One row: how many staging rows insert and how many update."""
    known = target.select(*table.keys, F.lit(1).alias("_known"))
    return (
        staging.select(*table.keys)
        .join(known, table.keys, "left")
        .agg(
            F.count(F.when(F.col("_known").isNull(), 1)).alias("RecordsInserted"),
            F.count("_known").alias("RecordsUpdated"),
        )
    )


def staging_duplicates(staging: DataFrame, table: Table) -> DataFrame:
    """Keys that occur more than once in an extract; a merge rejects them."""
    return (
        staging.groupBy(*table.keys).agg(F.count(F.lit(1)).alias("Copies"))
        .filter(F.col("Copies") > 1)
    )


def keep_latest(staging: DataFrame, table: Table, order_by: list[str]) -> DataFrame:
    """One row per key: the last by ``order_by``, decided the same way every run.

    The maximum of a struct is combined on the map side, so many copies of one
    key never meet in a single task.
    """
    rest = [c for c in staging.columns if c not in table.keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *rest)).alias("_row")
    return staging.groupBy(*table.keys).agg(newest).select(
        *[F.col(c) if c in table.keys else F.col(f"_row.{c}").alias(c) for c in staging.columns]
    )


TRACKED_PLAN_COLUMNS = [
    "QueryId", "EngineVersion", "CompatibilityLevel", "QueryPlanHash", "QueryHash",
    "PlanHandle", "CreationTime", "LastExecutionTime", "QueryPlanCompressed",
    "QueryPlanText", "IsOnlineIndexPlan", "IsParallelizable",
]


def scd2_upsert(history: DataFrame | None, staging: DataFrame, as_of: AsOf) -> DataFrame:
    """Plan history with validity ranges (type 2).

    A plan whose tracked columns differ from its current version gets a new
    version from ``as_of``; the previous one is closed at that moment.
    """
    version = staging.select(*S.PLAN_KEY, *TRACKED_PLAN_COLUMNS).withColumn(
        "ValidFrom", as_of_column(as_of)
    )
    if history is not None:
        version = history.select(*version.columns).unionByName(version)
    by_time = Window.partitionBy(*S.PLAN_KEY).orderBy("ValidFrom")
    tracked = F.struct(*TRACKED_PLAN_COLUMNS)
    changed = (
        version.withColumn("_previous", F.lag(tracked).over(by_time))
        .withColumn("_n", F.row_number().over(by_time))
        .filter((F.col("_n") == 1) | ~tracked.eqNullSafe(F.col("_previous")))
        .drop("_previous", "_n")
    )
    return changed.withColumn("ValidTo", F.lead("ValidFrom").over(by_time)).withColumn(
        "IsCurrent", F.col("ValidTo").isNull()
    )
