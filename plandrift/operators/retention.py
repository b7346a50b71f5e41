"""Retention: what is too old, what would go, and what remains.

Expiry is decided per (tenant, server, interval), since interval ids repeat
across tenants. Dry-run counts and applied deletions use the same rule.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from plandrift.functions.columns import AsOf, ago, start_of_day
from plandrift.functions.filters import optional_scope
from plandrift.schemas import INTERVAL_KEY, PLAN_KEY
from plandrift.sources.warehouse import Telemetry

DEFAULT_RETENTION_DAYS = 90


@dataclass(frozen=True)
class RetentionPolicy:
    """Days to keep each kind of record. The documented policy."""

    stats_days: int = 90
    regression_days: int = 30
    wait_days: int = 90
    run_log_days: int = 60


def expired_intervals(
    intervals: DataFrame, as_of: AsOf, days: int, tenant: str | None = None, server: str | None = None
) -> DataFrame:
    cutoff = ago(start_of_day(as_of), days, "day")
    return optional_scope(intervals, tenant, server).filter(
        F.col("IntervalStartTime") < cutoff
    ).select(*INTERVAL_KEY)


def _expired_rows(fact: DataFrame, expired: DataFrame) -> DataFrame:
    """Expired rows of a fact, counted per interval before they meet the intervals."""
    per_interval = fact.groupBy(*INTERVAL_KEY).agg(F.count(F.lit(1)).alias("n"))
    return per_interval.join(expired, INTERVAL_KEY).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    )


def cleanup_report(
    t: Telemetry,
    as_of: AsOf,
    retention_days: int = DEFAULT_RETENTION_DAYS,
    tenant: str | None = None,
    server: str | None = None,
) -> DataFrame:
    """The dry run: one row of counts. Orphaned plans are not part of the total."""
    expired = expired_intervals(t.intervals, as_of, retention_days, tenant, server)
    parts = {
        "RuntimeStatistics": _expired_rows(optional_scope(t.runtime, tenant, server), expired),
        "WaitStatistics": _expired_rows(optional_scope(t.waits, tenant, server), expired),
        "Intervals": expired.agg(F.count(F.lit(1)).alias("n")),
        "OrphanedPlans": orphaned_plans(
            optional_scope(t.plans, tenant, server), optional_scope(t.runtime, tenant, server)
        ).agg(F.count(F.lit(1)).alias("n")),
    }
    counts = None
    for kind, part in parts.items():
        row = part.select(F.lit(kind).alias("kind"), F.col("n").cast("long").alias("n"))
        counts = row if counts is None else counts.unionByName(row)
    one_row = counts.agg(
        *[F.max(F.when(F.col("kind") == kind, F.col("n"))).alias(kind) for kind in parts]
    )
    return one_row.select(
        F.lit(retention_days).alias("RetentionDays"),
        F.to_date(ago(start_of_day(as_of), retention_days, "day")).alias("CutoffDate"),
        F.lit("ALL" if tenant is None else tenant).alias("TenantFilter"),
        F.lit("ALL" if server is None else server).alias("ServerFilter"),
        *parts,
        (F.col("RuntimeStatistics") + F.col("WaitStatistics") + F.col("Intervals"))
        .alias("TotalRecords"),
    )


def cleanup(
    t: Telemetry,
    as_of: AsOf,
    retention_days: int = DEFAULT_RETENTION_DAYS,
    tenant: str | None = None,
    server: str | None = None,
    policy: RetentionPolicy | None = None,
    drop_stale_plans: bool = False,
) -> Telemetry:
    """The tables after deletion, as lazy frames; rows out of scope are untouched.

    ``policy`` gives each kind of record its own age, and then covers the run
    log as well; without it, one age applies and the run log is left alone.
    """
    p = policy or RetentionPolicy(retention_days, retention_days, retention_days, 0)

    def too_old(df: DataFrame, column: str, days: int) -> DataFrame:
        """Drop scoped rows dated before the cutoff."""
        old = F.col(column) < ago(start_of_day(as_of), days, "day")
        if tenant is not None:
            old = old & (F.col("TenantName") == tenant)
        if server is not None:
            old = old & (F.col("ServerName") == server)
        return df.filter(~F.coalesce(old, F.lit(False)))

    def survivors(fact: DataFrame, days: int) -> DataFrame:
        gone = expired_intervals(t.intervals, as_of, days, tenant, server)
        return fact.join(gone, INTERVAL_KEY, "left_anti").select(*fact.columns)

    # An interval must outlive every fact that still points at it.
    interval_days = max(p.stats_days, p.wait_days)
    kept = replace(
        t,
        runtime=survivors(t.runtime, p.stats_days),
        waits=survivors(t.waits, p.wait_days),
        intervals=too_old(t.intervals, "IntervalStartTime", interval_days),
        regressions=too_old(t.regressions, "DetectionDate", p.regression_days),
    )
    if policy is not None:
        kept = replace(kept, run_log=too_old(t.run_log, "LastExtractTime", p.run_log_days))
    if drop_stale_plans:
        stale = stale_plans(t.plans, t.runtime, as_of, retention_days)
        stale = optional_scope(stale, tenant, server).select(*PLAN_KEY)
        kept = replace(
            kept, plans=t.plans.join(stale, PLAN_KEY, "left_anti").select(*t.plans.columns)
        )
    return kept


def orphaned_plans(plans: DataFrame, runtime: DataFrame) -> DataFrame:
    """Plans no runtime row refers to."""
    used = runtime.select(*PLAN_KEY).distinct()
    return plans.join(used, PLAN_KEY, "left_anti").select(*plans.columns)


def stale_plans(plans: DataFrame, runtime: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Plans last loaded before the cutoff; plans never used have no such date."""
    last_used = runtime.groupBy(*PLAN_KEY).agg(F.max("LoadDate").alias("LastUsed"))
    cutoff = ago(start_of_day(as_of), days, "day")
    return plans.join(last_used, PLAN_KEY, "left").filter(F.col("LastUsed") < cutoff)
