"""The run log: one row per source and load, and totals over a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plandrift.functions.columns import AsOf, as_of_column
from plandrift.schemas import KEYS, RUN_LOG

SUCCESS, FAILED = "SUCCESS", "FAILED"


def log_rows(
    per_source: DataFrame, as_of: AsOf, duration_seconds: int, status: str = SUCCESS,
    error: str | None = None, run_id: str = "",
) -> DataFrame:
    """Run-log rows for sources with their inserted and updated counts.

    The id tells runs apart by ``run_id``, also if they share a moment.
    """
    now = as_of_column(as_of)
    return per_source.select(
        *KEYS, now.alias("LastExtractTime"),
        F.lit(int(duration_seconds)).alias("ExtractDurationSeconds"),
        F.col("RecordsInserted").cast("long").alias("RecordsInserted"),
        F.col("RecordsUpdated").cast("long").alias("RecordsUpdated"),
        F.lit(status).alias("ExtractStatus"), F.lit(error).cast("string").alias("ErrorMessage"),
        now.alias("LoadDate"),
    ).withColumn(
        "ETLControlId", F.xxhash64(*KEYS, "LastExtractTime", "ExtractStatus", F.lit(run_id))
    ).select(*RUN_LOG.columns)


def failed_rows(
    sources: DataFrame, as_of: AsOf, duration_seconds: int, error: str, run_id: str = ""
) -> DataFrame:
    nothing = sources.select(
        *KEYS, F.lit(0).alias("RecordsInserted"), F.lit(0).alias("RecordsUpdated")
    )
    return log_rows(nothing, as_of, duration_seconds, FAILED, error, run_id)


def run_totals(log: DataFrame) -> DataFrame:
    """Successful and failed extractions and rows loaded."""
    ok = F.col("ExtractStatus") == SUCCESS
    return log.agg(
        F.count(F.when(ok, 1)).alias("SuccessfulExtractions"),
        F.count(F.when(F.col("ExtractStatus") == FAILED, 1)).alias("FailedExtractions"),
        F.coalesce(
            F.sum(F.when(ok, F.col("RecordsInserted") + F.col("RecordsUpdated"))), F.lit(0)
        ).alias("TotalRecordsLoaded"),
    )


def merge_result(
    spark: SparkSession, inserted: int, updated: int, regressions: int | None = None,
    conflicts: int | None = None,
) -> DataFrame:
    """The one-row result of a merge job."""
    row = {"RecordsInserted": inserted, "RecordsUpdated": updated}
    if regressions is not None:
        row["RegressionsDetected"] = regressions
    if conflicts is not None:
        row["IntervalConflicts"] = conflicts
    return spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in row.items()])
