"""Incremental refresh: pick up newly landed extracts and merge them.

A file stream remembers which files it has processed, so each run loads only
what is new. Every batch goes through the same merge as the daily job; a batch
repeated after a failure changes nothing, because merges are idempotent.

``refresh_all`` takes all tables as one unit: streams only move what landed to
a ledger of pending batches, and one load merges, detects, flags and logs it.
Pending batches go when the load is done, so a run that dies is finished by the
next one. Of several versions of a row the one that landed last counts, and the
wait buckets of a key add up over all batches: how files are spread over runs
makes no difference to the rows stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plandrift.functions.columns import AsOf
from plandrift.operators.regression import DEFAULT_THRESHOLD
from plandrift.operators.upsert import keep_latest
from plandrift.plans.load import LOAD_ORDER, Staging, load, merge_table
from plandrift.schemas import BATCH_COLUMN, INTERVAL, WAIT, WAIT_BUCKET, Table
from plandrift.sources.warehouse import Warehouse


def refresh(
    spark: SparkSession,
    warehouse: Warehouse,
    table: Table,
    landing: str,
    checkpoint: str,
    as_of: Callable[[], AsOf],
    order_by: list[str],
) -> StreamingQuery:
    """Merge all files that landed since the last run as one unit, then stop.

    A key that arrives several times is reduced to its latest version by
    ``order_by``, whatever files it is spread over; the wait buckets of a key add
    up instead. A later run's version of a key replaces that of an earlier one.
    """
    rows = spark.readStream.schema(table.staging_schema).parquet(landing)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Staged under a new name each time, so that a repeated batch starts clean.
        staging = Staging(spark, warehouse)
        staging.write(table, batch if table is WAIT else keep_latest(batch, table, order_by))
        merge_table(warehouse, table, staging.read(table), as_of())
        staging.clear()

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Where and when a row landed: the order in which versions of a key follow.
_LANDED = ["LandedAt", "LandedFile"]


def _collect(spark: SparkSession, warehouse: Warehouse, table: Table, landing: str, checkpoint: str) -> StreamingQuery:
    """Move newly landed files of a table to its pending batches."""
    rows = spark.readStream.schema(table.staging_schema).parquet(f"{landing}/{table.name}").select(
        "*", F.col("_metadata.file_modification_time").alias("LandedAt"),
        F.col("_metadata.file_path").alias("LandedFile"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{_pending(warehouse, table)}/{BATCH_COLUMN}={batch_id}")

    return (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{checkpoint}/{table.name}")
        .trigger(availableNow=True)
        .start()
    )


def _pending(warehouse: Warehouse, table: Table) -> str:
    return f"{warehouse.root}/_landed/{table.name}"


def _read_pending(spark: SparkSession, warehouse: Warehouse, table: Table) -> DataFrame:
    schema = T.StructType([
        *table.staging_schema.fields, T.StructField("LandedAt", T.TimestampType()),
        T.StructField("LandedFile", T.StringType()), T.StructField(BATCH_COLUMN, T.LongType()),
    ])
    return spark.read.schema(schema).parquet(_pending(warehouse, table))


def retain_wait_buckets(warehouse: Warehouse, landed: DataFrame) -> DataFrame:
    """Keep landed wait buckets by batch; all buckets so far of the keys that landed."""
    warehouse.replace_partitions(WAIT_BUCKET, landed.select(*WAIT_BUCKET.columns))
    keys = landed.select(*WAIT.keys).distinct()
    kept = warehouse.read(WAIT_BUCKET, warehouse.touched(landed, WAIT_BUCKET))
    return kept.join(keys, WAIT.keys, "left_semi")


def refresh_all(
    spark: SparkSession,
    warehouse: Warehouse,
    landing: str,
    checkpoint: str,
    as_of: Callable[[], AsOf],
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Load everything below ``landing``/<table> that no earlier run has loaded.

    Files hold staging rows; wait files hold increments, one row per duration
    bucket. Returns the counts of the load (see ``plans.load.load``).
    """
    fs, _ = warehouse._filesystem(landing)
    path = spark._jvm.org.apache.hadoop.fs.Path
    present = [t for t in LOAD_ORDER if fs.exists(path(f"{landing}/{t.name}"))]
    for stream in [_collect(spark, warehouse, t, landing, checkpoint) for t in present]:
        stream.awaitTermination()

    staging = Staging(spark, warehouse)
    store, _ = warehouse._filesystem(warehouse.root)
    waiting = [t for t in LOAD_ORDER if store.exists(path(_pending(warehouse, t)))]
    for table in waiting:
        rows = _read_pending(spark, warehouse, table)
        if table is WAIT:
            rows = retain_wait_buckets(warehouse, rows)
        elif table is not INTERVAL:  # all versions of an interval, so that conflicts are seen
            rows = keep_latest(rows.drop(BATCH_COLUMN), table, _LANDED)
        staging.write(table, rows)
    result = load(warehouse, staging, as_of(), threshold)
    staging.clear()
    for table in waiting:
        store.delete(path(_pending(warehouse, table)), True)
    return result
