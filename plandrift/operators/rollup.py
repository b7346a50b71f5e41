"""Daily states of the runtime measures, stored beside the facts.

A state is a sum, a count or a maximum, so states of days, plans and buckets merge
into those of any period or group (see ``functions.measures``). One row stands for
a plan, a day and a bucket of intervals. Plans are kept apart, so that exact numbers
of plans and of queries follow as well: a plan counts on the first day it appears.
To-date totals, comparisons of periods and reports by day read these rows, not the
facts; a load renews the buckets it touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plandrift import schemas as S
from plandrift.functions.measures import RUNTIME, as_fact, fact_states
from plandrift.functions.time_intelligence import DATE, date_lookup
from plandrift.schemas import INTERVAL_KEY, QUERY_KEY, RUNTIME_DAILY


def daily_states(
    runtime: DataFrame, intervals: DataFrame, intervals_per_bucket: int = S.INTERVALS_PER_BUCKET
) -> DataFrame:
    """States per plan, day and bucket; ``RuntimeStatsIntervalId`` is the bucket's first id.

    Rows of an interval that is not known yet keep a null date, so that a bucket
    with rows always has states; they count as soon as the interval is loaded.
    """
    first = F.floor(F.col("RuntimeStatsIntervalId") / intervals_per_bucket) * intervals_per_bucket
    states = [F.expr(sql).alias(name) for name, sql in fact_states(RUNTIME).items()]
    return (
        as_fact(runtime, RUNTIME).join(date_lookup(intervals), INTERVAL_KEY, "left")
        .withColumn("_bucket", first.cast("int"))
        .groupBy(*QUERY_KEY, "PlanId", "_bucket", DATE).agg(*states)
        .withColumnRenamed("_bucket", "RuntimeStatsIntervalId").select(*RUNTIME_DAILY.columns)
    )
