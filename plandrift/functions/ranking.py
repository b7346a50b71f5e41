"""Top-n cuts and ranks, always over already aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plandrift.sources.warehouse import shared_dir


def top(df: DataFrame, n: int, order: Sequence[Column], tie_break: Sequence[str]) -> DataFrame:
    """First ``n`` rows; the natural key decides ties so that runs agree."""
    return df.orderBy(*order, *[F.asc(c) for c in tie_break]).limit(n)


def _checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def rank_desc(
    df: DataFrame, value: str, name: str, dense: bool = False, within: Sequence[str] = ()
) -> DataFrame:
    """Add the rank of ``value``, highest first; nulls rank last, ties share a rank.

    A window over all rows would sort everything in one task, and a tie shared
    by many rows would do the same to any split of the rows. So the distinct
    values are ranked: they are range-partitioned into even parts, each part
    accumulates its own row counts, and the totals of the parts before it are
    added. Both the rows and the parts are checkpointed, so that a repeated
    task cannot see other numbers than the ones already used.
    """
    df = _checkpointed(df)
    keys = [*within, value]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    step = F.lit(1) if dense else F.col("_rows")
    placed = _checkpointed(
        values.repartitionByRange(*within, F.desc_nulls_last(value)).select(
            *keys, step.alias("_step"), F.spark_partition_id().alias("_part")
        )
    )
    before = (Window.unboundedPreceding, -1)
    parts = placed.groupBy(*within, "_part").agg(F.sum("_step").alias("_total"))
    earlier_parts = Window.partitionBy(*within).orderBy("_part").rowsBetween(*before)
    offsets = parts.select(
        *within, "_part", F.coalesce(F.sum("_total").over(earlier_parts), F.lit(0)).alias("_offset")
    )
    in_part = (
        Window.partitionBy(*within, "_part").orderBy(F.desc_nulls_last(value)).rowsBetween(*before)
    )
    local = placed.withColumn("_local", F.coalesce(F.sum("_step").over(in_part), F.lit(0)))
    ranked = local.join(offsets, [*within, "_part"]).select(
        *[F.col(c).alias(f"_{c}") for c in keys],
        (F.col("_offset") + F.col("_local") + 1).alias(name),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return df.join(ranked, same).select(*df.columns, name)


def count_top(df: DataFrame, value: str, n: int) -> DataFrame:
    """How many rows a top ``n`` by ``value`` holds when ties at the edge stay in.

    Checkpointed like a rank: the edge and the rows compared with it must come
    from the same evaluation of ``value``.
    """
    df = _checkpointed(df)
    edge = df.orderBy(F.desc_nulls_last(value)).limit(n).agg(F.min(value).alias("_edge"))
    kept = df.filter(F.col(value) >= edge.scalar())
    return kept.agg(F.count(F.lit(1)).alias("TopQueries"))
