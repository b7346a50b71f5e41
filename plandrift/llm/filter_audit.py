"""Filter interaction audit (12): Lehmer-rank difference arrays over filter orders.

Five filters can be applied in 120 orders. Which of them fail a document is its mask; all
that an order does to a document follows from the mask, so documents are reduced to
counts per part and mask once. Orders are numbered by Lehmer rank, that is in
lexicographic sequence, so the orders that share their first letters form an interval of
ranks. A mask leaves at step k in exactly the orders whose first k - 1 letters it passes
and whose k-th it fails: per mask and step a few intervals. Each count is added where an
interval begins and subtracted where it ends; a prefix sum over the ranks gives every
order's figures.

A text's copies are found by its digest. Not the copies meet, but per digest the smallest
id, from partial aggregates; documents then meet that id by (digest, id), so a group of
copies of any size is spread by its ids.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plandrift.llm import common

FILTERS = "ABCDE"
SYMBOLS = "#$%&*|"  # fixed values
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "\t\n\x0b\x0c\r"
ORDERS = factorial(len(FILTERS))


def failures(text: Column) -> dict[str, Column]:
    """The conditions under which filters A to D fail a text that is not null."""
    words = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " ", -1), lambda w: w != "")
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {"A": F.size(words) < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
            "C": 100 * upper > 5 * F.length(text), "D": F.length(F.translate(text, SYMBOLS, "")) < F.length(text)}


def rank_of(order: str) -> int:
    """The Lehmer rank of an order of the filters, or the first rank of those that begin with it."""
    left, rank = list(FILTERS), 0
    for letter in order:
        place = left.index(letter)
        rank += place * factorial(len(left) - 1)
        left.remove(letter)
    return rank


def interval_ends() -> list[tuple[int, int, int, int, int]]:
    """(mask, step, rank, removed, redundant): changes of what holds from that rank on.

    ``removed``: the step's filter is the first to fail the mask; ``redundant``: it fails
    the mask after another has. Intervals that touch are joined, as their ends cancel.
    """
    ends: dict[tuple[int, int, int], list[int]] = {}
    for step in range(1, len(FILTERS) + 1):
        width = factorial(len(FILTERS) - step)
        for prefix in permutations(FILTERS, step):
            begin = rank_of("".join(prefix))
            for mask in range(1, 1 << len(FILTERS)):
                fails = [mask >> FILTERS.index(letter) & 1 for letter in prefix]
                if fails[-1]:
                    what = 1 if any(fails[:-1]) else 0
                    ends.setdefault((mask, step, begin), [0, 0])[what] += 1
                    ends.setdefault((mask, step, begin + width), [0, 0])[what] -= 1
    return [(*key, *change) for key, change in sorted(ends.items()) if any(change) and key[2] < ORDERS]


def masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and the filters that fail them.

    Bit i of the mask stands for filter ``FILTERS[i]``. A null text is empty, a null part
    the empty string. Repeated rows count each time and are no copies of one another, as
    no id is smaller; a null id is larger than any other. A document is good (toxic) if
    any row of ``labels`` for it says quality (toxic) 1; labels of null ids hold for none.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    fails = failures(value)
    bits = sum(((condition.cast("int") * (1 << i)) for i, condition in enumerate(fails.values())), F.lit(0))
    rows = common.stored(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(value, 256)).alias("digest"), bits.alias("mask")), "masks")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    # Null ids equal one another here, and are copies of any id that is not null.
    marked = rows.join(firsts.withColumnsRenamed({"digest": "d", "doc_id": "i"}),
                       (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left")
    says = lambda column: F.max((F.col(column) == 1).cast("int"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        says("quality").alias("good"), says("toxic").alias("toxic"))
    told = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(column)
    return common.stored(
        marked.withColumn("mask", F.col("mask") + F.when(F.col("first"), 0).otherwise(1 << 4))
        .join(known, "doc_id", "left").groupBy("part", "mask")
        .agg(F.count("*").alias("n"), told("good"), told("toxic")), "mask-counts")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """part, filter_order, step and the counts of every order's steps, zeros included.

    kept: documents after the step; removed: by it; redundant: failing its filter but
    removed before; unique_fails: failing its filter only; good_lost, toxic_lost: those
    removed with such a label; shapley: removed by the step's filter over all orders.
    An empty table gives no rows; for odd rows see ``masks``.
    """
    spark = docs.sparkSession
    counts = masks(docs, labels, doc_id, text, part)
    ends = spark.createDataFrame(interval_ends(), "mask int, step int, rank int, begun int, late int")
    orders = ["".join(order) for order in permutations(FILTERS)]
    # One partitioning by part serves every step: 600 places and some 3,000 interval ends a part.
    changes = counts.join(F.broadcast(ends), "mask").select(
        "part", "step", "rank", *[(F.col("begun") * F.col(c)).alias(c) for c in ("n", "good", "toxic")],
        (F.col("late") * F.col("n")).alias("redundant"))
    changes = changes.groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic", "redundant")])
    single = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)).alias(letter) for i, letter in enumerate(FILTERS)]
    places = (counts.groupBy("part").agg(F.sum("n").alias("total"), *single)
              .withColumn("filter_order", F.explode(F.array(*[
                  F.struct(F.lit(o).alias("o"), F.lit(i).alias("rank")) for i, o in enumerate(orders)])))
              .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
              .withColumns({"rank": F.col("filter_order.rank"), "filter_order": F.col("filter_order.o")})
              .withColumn("filter", F.col("filter_order").substr(F.col("step"), F.lit(1))))
    sums = Window.partitionBy("part", "step").orderBy("rank")
    totals = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0)).cast("long")
    figures = places.join(changes, ["part", "step", "rank"], "left").select(
        "part", "filter_order", "rank", "step", "filter", "total",
        totals("n", sums).alias("removed"), totals("redundant", sums).alias("redundant"),
        F.coalesce(*[F.when(F.col("filter") == letter, F.col(letter)) for letter in FILTERS]).alias("unique_fails"),
        totals("good", sums).alias("good_lost"), totals("toxic", sums).alias("toxic_lost"))
    return figures.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("removed").over(Window.partitionBy("part", "rank").orderBy("step"))).alias("kept"),
        "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {
        'A': len(ws) < 50, 'B': 100 * len(list_distinct(ws)) < 65 * len(ws),
        'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'), 'E': first < doc_id} AS f
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT c.*, filter_order, step, filter_order[step] AS letter,
             list_transform(range(1, 6), lambda i: CASE filter_order[i] WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C
                                                   WHEN 'D' THEN f.D ELSE f.E END) AS fails
      FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
g AS (SELECT part, filter_order, step::INT AS step, letter,
             sum(CASE WHEN NOT list_contains(fails[1:step], true) THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN fails[step] AND NOT list_contains(fails[1:step - 1], true) THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN fails[step] AND list_contains(fails[1:step - 1], true) THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN fails[step] AND len(list_filter(fails, lambda y: y)) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN fails[step] AND NOT list_contains(fails[1:step - 1], true) THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN fails[step] AND NOT list_contains(fails[1:step - 1], true) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM g
"""
