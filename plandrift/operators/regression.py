"""Plan-regression detection and flagging.

For one query, every pair of rows (older row of plan *old*, later row of plan
*new*) counts once. The old and new averages are means over those row pairs,
and a pair of plans is a regression when the new mean exceeds the old one by
more than the threshold.

Joining rows with rows would grow with the square of a query's history.
Instead a plan is summarised per bucket of intervals: rows, sum of durations,
and the few durations inside the bucket, which its width bounds. Whole buckets
pair by running totals: the new plan's rows of a bucket meet all rows of the
old plan before that bucket at once. Only inside the bucket that both share
are durations looked at one by one. Contributions of buckets add up, so no
row, group or task holds the history of a plan, and a stored summary
(``schemas.PLAN_STATE``) need only be renewed for the buckets a load touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plandrift import schemas as S
from plandrift.functions.columns import AsOf, as_of_column
from plandrift.schemas import PLAN_STATE, QUERY_KEY, REGRESSION, RUNTIME

DEFAULT_THRESHOLD = 0.25

# Walks both series of a bucket in time order. At equal intervals the new
# plan's entries come first (role 0), so only strictly older rows of the old
# plan are counted. Both series arrive sorted: sorting them together is a merge.
_FOLD = """
aggregate(
  sort_array(concat(old_series, new_series)),
  struct(0L AS seen, 0D AS seen_sum, 0L AS pairs, 0D AS old_sum, 0D AS new_sum),
  (a, e) -> IF(e.role = 1,
    struct(a.seen + 1L AS seen, a.seen_sum + e.d AS seen_sum,
           a.pairs AS pairs, a.old_sum AS old_sum, a.new_sum AS new_sum),
    struct(a.seen AS seen, a.seen_sum AS seen_sum,
           a.pairs + a.seen AS pairs, a.old_sum + a.seen_sum AS old_sum,
           a.new_sum + e.d * a.seen AS new_sum)))
"""

# What a bucket of the new plan adds: pairs with all older buckets of the old
# plan, and, where the old plan has rows in the same bucket, those inside it.
_CONTRIBUTION = f"""
transform(
  array(IF(old_series IS NULL,
    struct(0L AS seen, 0D AS seen_sum, 0L AS pairs, 0D AS old_sum, 0D AS new_sum), {_FOLD})),
  f -> struct(
    new_rows * rows_before + f.pairs AS pairs,
    new_rows * sum_before + f.old_sum AS old_sum,
    new_sum * rows_before + f.new_sum AS new_sum))
"""


def plan_states(runtime: DataFrame, intervals_per_bucket: int = S.INTERVALS_PER_BUCKET) -> DataFrame:
    """Summaries per plan and bucket; ``Series`` has one entry per row of the bucket.

    Rows of a plan differ in interval and execution type, so a series has three
    entries per interval of the bucket at most. ``RuntimeStatsIntervalId`` is the
    first id of the bucket.
    """
    interval, duration = F.col("RuntimeStatsIntervalId"), F.col("AvgDurationMs")
    first = (F.floor(interval / intervals_per_bucket) * intervals_per_bucket).cast("int")
    return (
        runtime.select(*QUERY_KEY, "PlanId", first.alias("_bucket"), interval.alias("i"), duration.alias("d"))
        .groupBy(*QUERY_KEY, "PlanId", "_bucket").agg(
            F.count(F.lit(1)).alias("StateRows"), F.sum("d").alias("DurationSum"),
            F.min("d").alias("FastestMs"), F.max("d").alias("SlowestMs"),
            F.min("i").alias("FirstInterval"), F.max("i").alias("LastInterval"),
            F.sort_array(F.collect_list(F.struct("i", "d"))).alias("Series"),
        )
        .withColumnRenamed("_bucket", "RuntimeStatsIntervalId").select(*PLAN_STATE.columns)
    )


def _in_role(series: str, role: int) -> Column:
    """The sorted series with every entry marked as old (1) or new (0)."""
    return F.expr(f"transform({series}, e -> struct(e.i AS i, {role} AS role, e.d AS d))")


def pair_averages(states: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Pair-weighted averages of every plan pair that may exceed ``threshold``."""
    plan = Window.partitionBy(*QUERY_KEY, "PlanId")
    by_time = plan.orderBy("RuntimeStatsIntervalId")
    before = by_time.rowsBetween(Window.unboundedPreceding, -1)
    steps = states.select(
        *QUERY_KEY, "PlanId", F.col("RuntimeStatsIntervalId").alias("bucket"),
        "StateRows", "DurationSum", "Series",
        F.lead("RuntimeStatsIntervalId").over(by_time).alias("next_bucket"),
        F.coalesce(F.sum("StateRows").over(before), F.lit(0)).alias("older_rows"),
        F.coalesce(F.sum("DurationSum").over(before), F.lit(0.0)).alias("older_sum"),
        F.min("FirstInterval").over(plan).alias("first"), F.max("LastInterval").over(plan).alias("last"),
        F.min("FastestMs").over(plan).alias("fastest"), F.max("SlowestMs").over(plan).alias("slowest"),
    )
    at = states.select(*QUERY_KEY, F.col("RuntimeStatsIntervalId").alias("at")).distinct()
    # The old plan's totals before each bucket of the query: those of its last step.
    inside = F.col("at") == F.col("bucket")
    old = steps.join(at, QUERY_KEY).filter(
        (F.col("at") >= F.col("bucket")) & (F.col("next_bucket").isNull() | (F.col("at") < F.col("next_bucket")))
    ).select(
        *QUERY_KEY, "at", F.col("PlanId").alias("OldPlanId"),
        (F.col("older_rows") + F.when(inside, 0).otherwise(F.col("StateRows"))).alias("rows_before"),
        (F.col("older_sum") + F.when(inside, 0.0).otherwise(F.col("DurationSum"))).alias("sum_before"),
        F.when(inside, _in_role("Series", 1)).alias("old_series"),
        F.col("first").alias("old_first"), F.col("fastest").alias("old_fastest"),
    )
    new = steps.select(
        *QUERY_KEY, F.col("bucket").alias("at"), F.col("PlanId").alias("NewPlanId"),
        F.col("StateRows").alias("new_rows"), F.col("DurationSum").alias("new_sum"),
        _in_role("Series", 0).alias("new_series"),
        F.col("last").alias("new_last"), F.col("slowest").alias("new_slowest"),
    )
    # The new mean cannot exceed the slowest new row nor the old mean undercut
    # the fastest old row; the factor leaves room for rounding in the means.
    may_exceed = (F.col("old_fastest") < 0) | (
        F.col("new_slowest") > F.col("old_fastest") * (1 + threshold) * (1 - 1e-9)
    )
    pairs = old.join(new, [*QUERY_KEY, "at"]).filter(
        (F.col("OldPlanId") != F.col("NewPlanId")) & (F.col("old_first") < F.col("new_last"))
    )
    if threshold > -1:
        pairs = pairs.filter(may_exceed)
    pair = [*QUERY_KEY, "OldPlanId", "NewPlanId"]
    # inline() computes the fold once per row, which plain projections would repeat.
    totals = pairs.select(*pair, F.inline(F.expr(_CONTRIBUTION))).groupBy(*pair).agg(
        *[F.sum(c).alias(c) for c in ("pairs", "old_sum", "new_sum")]
    )
    return totals.filter(F.col("pairs") > 0).select(
        *pair,
        F.try_divide("old_sum", "pairs").alias("OldAvgDurationMs"),
        F.try_divide("new_sum", "pairs").alias("NewAvgDurationMs"),
    )


def plan_pair_averages(
    runtime: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    intervals_per_bucket: int = S.INTERVALS_PER_BUCKET,
) -> DataFrame:
    return pair_averages(plan_states(runtime, intervals_per_bucket), threshold)


def detect_plan_regressions(
    runtime: DataFrame,
    existing: DataFrame | None,
    as_of: AsOf,
    threshold: float = DEFAULT_THRESHOLD,
    intervals_per_bucket: int = S.INTERVALS_PER_BUCKET,
) -> DataFrame:
    """New regression rows; pairs already recorded on the ``as_of`` day are left out."""
    return detect_from_states(plan_states(runtime, intervals_per_bucket), existing, as_of, threshold)


def detect_from_states(
    states: DataFrame, existing: DataFrame | None, as_of: AsOf, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """As ``detect_plan_regressions``, from summaries instead of runtime rows."""
    now = as_of_column(as_of)
    old, new = F.col("OldAvgDurationMs"), F.col("NewAvgDurationMs")
    change = F.try_divide(new - old, old)
    found = (
        pair_averages(states, threshold)
        .filter(change > threshold)
        .withColumn("DurationChangePercentage", change * 100)
    )
    if existing is not None:
        today = detected_today(existing, as_of).select(*QUERY_KEY, "OldPlanId", "NewPlanId")
        found = found.join(today, [*QUERY_KEY, "OldPlanId", "NewPlanId"], "left_anti")
    return found.withColumns({
        "DetectionDate": now,
        "IsInvestigated": F.lit(False),
        "Notes": F.lit(None).cast("string"),
    }).withColumn("RegressionId", F.xxhash64(*REGRESSION.keys)).select(*REGRESSION.columns)


def detected_today(regressions: DataFrame, as_of: AsOf) -> DataFrame:
    return regressions.filter(F.to_date("DetectionDate") >= F.to_date(as_of_column(as_of)))


def flag_regressions(runtime: DataFrame, regressions: DataFrame, as_of: AsOf) -> DataFrame:
    """Set ``IsRegression`` on rows of plans detected today; a set flag stays set."""
    flagged = (
        detected_today(regressions, as_of)
        .select(*QUERY_KEY, F.col("NewPlanId").alias("PlanId"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    return (
        runtime.join(flagged, [*QUERY_KEY, "PlanId"], "left")
        .withColumn("IsRegression", F.col("IsRegression") | F.coalesce("_hit", F.lit(False)))
        .select(*RUNTIME.columns)
    )


def mark_investigated(regressions: DataFrame, regression_id: int, note: str) -> DataFrame:
    hit = F.col("RegressionId") == regression_id
    return regressions.withColumns({
        "IsInvestigated": F.when(hit, True).otherwise(F.col("IsInvestigated")),
        "Notes": F.when(hit, note).otherwise(F.col("Notes")),
    })
