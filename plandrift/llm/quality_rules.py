"""Quality rules (8): cutoffs with a guaranteed bound on the false rejection of good texts.

Each rule is a rate whose large values are suspicious. Good labelled texts, copies counting
once, are split in two by a hash of the text. One half proposes cutoffs: for each stratum a
ladder of settings from lenient to strict, each a vector of cutoffs for all rules: multiples
of the rules' maxima, then quantiles. The other half tests the settings in this fixed order:
of its n texts k are rejected, and P(Binomial(n, risk) <= k), summed exactly, must not exceed
the share of the error rate that the stratum gets (Bonferroni over strata; a fixed order needs
no more correction). The strictest setting before the first failure holds. Strata with too few
texts for a test of their own are tested together as one, which gets a share of its own. With
probability 1 - ``error`` no tested stratum's setting rejects more than ``risk`` of its good
texts; for strata tested together this holds of all their texts taken together.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plandrift.llm import common

WORD = rf"[^{common.SPACE_CLASS}]+"
SYMBOLS = "#*$%&|<>"  # fixed values
RULES = ("symbol_rate", "upper_rate", "mark_rate", "dup_line_rate", "repeat_rate", "word_length")
WINDOW = 8
#: The most lenient settings reject above these multiples of the largest rate proposed.
MULTIPLES = (4.0, 2.0, 1.5, 1.25)
#: A stratum is tested by itself if it would pass with so many texts rejected.
LEEWAY = 1


def base_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, and counts for the rules.

    A null text has no words. Windows of eight words are compared by a 64-bit hash
    within their text; equal hashes of unequal windows are not to be met in practice
    (fewer than one in 10^10 documents of 20,000 words).
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    spaced = F.split(F.translate(value, "\t\n\x0b\x0c\r", "     "), " ", -1)
    frame = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), *[F.col(c) for c in keep or ()],
        F.filter(spaced, lambda x: x != "").alias("w"),
        F.filter(F.split(value, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
        _count(value, SYMBOLS).alias("n_symbols"),
        F.length(F.translate(value, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _count(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _count(value, "!?|").alias("n_marks"))
    windows = F.transform(F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice(F.col("w"), i, WINDOW)))
    frame = frame.select(
        "*", F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, windows).alias("h")).drop("lines", "w")
    again = F.coalesce(F.size("h") > F.size(F.array_distinct("h")), F.lit(False))
    frame = frame.withColumn("again", again)
    ordered = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    frame = frame.withColumn("s", F.when(F.col("again"), ordered)).drop("h", "again")
    at = lambda i: F.get(F.col("s"), i)["x"]
    same = lambda p, k: F.coalesce(p["x"] == at(k), F.lit(False))
    twice = F.filter("s", lambda p, k: same(p, k - 1) | same(p, k + 1))
    frame = frame.withColumn("p", F.sort_array(F.transform(twice, lambda p: p["i"]))).drop("s")
    covered = F.aggregate(
        "p", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + WINDOW).alias("end"),
                                (acc["n"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("n")),
        lambda acc: acc["n"])
    return frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def _count(value: Column, characters: str) -> Column:
    return (F.length(value) - F.length(F.translate(value, characters, ""))).cast("long")


def rates(features: DataFrame) -> DataFrame:
    """Adds the rules' rates; the more suspicious the larger."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return features.withColumns({
        "symbol_rate": F.col("n_symbols") / words, "upper_rate": F.col("n_upper") / chars,
        "mark_rate": F.col("n_marks") / words, "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words, "word_length": F.col("word_chars") / words})


def binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed exactly from j = 0 by the ratio of its terms.

    In logarithms relative to the first term, so that no term under- or overflows.
    """
    ratio = p / (1 - p)
    last = F.aggregate(
        F.sequence(F.lit(0), F.greatest(k, F.lit(0))),
        F.struct(F.lit(0.0).alias("term"), F.lit(float("-inf")).alias("total")),
        lambda acc, j: F.struct(
            (acc["term"] + F.log((n - j) * ratio / (j + 1))).alias("term"),
            F.when(acc["total"] > acc["term"], acc["total"] + F.log1p(F.exp(acc["term"] - acc["total"])))
            .otherwise(acc["term"] + F.log1p(F.exp(acc["total"] - acc["term"]))).alias("total")),
        lambda acc: acc["total"])
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(last + n * math.log1p(-p))))


def tested_as(sizes: DataFrame, risk: float, error: float) -> DataFrame:
    """(stratum, unit) of (stratum, n): the unit that a stratum is tested in.

    Strata that could not pass with ``LEEWAY`` rejections form one unit, to which the
    smallest of the others are added until it could pass itself. Depends on the number of
    texts only, not on their rates. One row per stratum meets in the running sum.
    """
    level = F.lit(error) / (F.count("*").over(Window.partitionBy()) + 1)
    before = Window.orderBy("n", "stratum").rowsBetween(Window.unboundedPreceding, -1)
    frame = sizes.select("stratum", "n", level.alias("level"), F.sum("n").over(before).alias("before"))
    few = lambda n: binomial_cdf(n, F.lit(LEEWAY), risk) > F.col("level")
    # All strata before one whose sum is too small are themselves too small.
    pooled = few(F.col("n")) | (F.col("before").isNotNull() & few(F.coalesce("before", F.lit(0))))
    return frame.select("stratum", F.when(pooled, "pool").otherwise(F.concat(F.lit("own "), "stratum")).alias("unit"))


def cutoffs(labelled: DataFrame, risk: float = 0.02, error: float = 0.05, steps: int = 20) -> DataFrame:
    """(stratum, the rules' cutoffs, n, k, p_value): the setting that holds per stratum.

    ``labelled``: stratum, text_key (a hash of the text) and rates of good documents; a
    text counts once per stratum. The first settings reject above ``MULTIPLES`` of each
    rule's maximum; setting s of 0 to ``steps`` after them above the quantile
    1 - 2 * s/steps * risk / number of rules, as texts seldom fail one rule only. A
    stratum without a passing setting has no row, nor one without good texts. n, k and
    p_value are those of the unit it was tested in. Quantiles are Spark's mergeable ones,
    so no group meets in one task.
    """
    texts = labelled.dropDuplicates(["stratum", "text_key", *RULES])
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("text_key")), F.lit(2))
    texts = common.stored(texts.select("stratum", *RULES, half.alias("half")), "good-texts")
    # A stratum without a text in the tested half counts too, with none.
    sizes = texts.groupBy("stratum").agg(F.sum("half").alias("n"))
    units = common.stored(tested_as(sizes, risk, error), "units")
    texts = texts.join(units, "stratum")
    probabilities = [1 - 2 * s / steps * risk / len(RULES) for s in range(steps + 1)]
    ladder = texts.where("half = 0").groupBy("unit").agg(*[
        F.percentile_approx(r, probabilities, 20_000).alias(f"c_{r}") for r in RULES])
    rungs = F.concat(
        F.array(*[F.struct(*[(F.get(f"c_{r}", F.lit(0)) * m).alias(f"c_{r}") for r in RULES]) for m in MULTIPLES]),
        F.arrays_zip(*[f"c_{r}" for r in RULES]))
    n_rungs = len(MULTIPLES) + steps + 1
    arrays = common.stored(ladder.select("unit", rungs.alias("ladder")), "ladders")
    # Every text meets the settings of its unit in one array, not in a product.
    tested = texts.where("half = 1").join(arrays, "unit")
    over = lambda c: _any([F.col(r) > c[f"c_{r}"] for r in RULES])
    rejected = tested.select("unit", F.transform("ladder", lambda c: over(c).cast("int")).alias("r"))
    counts = rejected.groupBy("unit").agg(F.count("*").cast("int").alias("n"), *[
        F.sum(F.get("r", F.lit(s))).cast("int").alias(f"k_{s}") for s in range(n_rungs)])
    n_units = units.agg(F.countDistinct("unit").alias("n")).scalar()
    k = F.array(*[F.col(f"k_{s}") for s in range(n_rungs)])
    results = counts.join(arrays, "unit").select("unit", "n", "ladder", F.transform(k, lambda x: F.struct(
        x.alias("k"), binomial_cdf(F.col("n"), x, risk).alias("p_value"))).alias("tests"),
        (F.lit(error) / n_units).alias("level"))
    passed = F.aggregate("tests", F.struct(F.lit(0).alias("m"), F.lit(True).alias("go")), lambda acc, t: F.struct(
        (acc["m"] + (acc["go"] & (t["p_value"] <= F.col("level"))).cast("int")).alias("m"),
        (acc["go"] & (t["p_value"] <= F.col("level"))).alias("go")), lambda acc: acc["m"])
    results = results.withColumn("m", passed).where("m > 0")
    chosen, test = F.get("ladder", F.col("m") - 1), F.get("tests", F.col("m") - 1)
    results = results.select("unit", *[chosen[f"c_{r}"].alias(f"c_{r}") for r in RULES],
                             "n", test["k"].alias("k"), test["p_value"].alias("p_value"))
    return units.join(results, "unit").drop("unit")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """doc_id, the counts, base_failed, rule_failed and kept per row of ``docs``.

    Strata are languages, a null one being its own (the empty name). Those with few good
    texts are tested together; one without any, and all if even together they are too few,
    reject by the base rule only. ``labels`` (doc_id, quality) may repeat ids; a document
    is good if all its labels are 1. Null texts have no words and fail
    the base rule. Repeated rows stay; an empty table gives no rows.
    """
    features, limits = fitted(docs, labels, risk, error)
    return (features.join(limits, "stratum", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    F.expr(BASE_FAILED).alias("base_failed"), F.expr(FAILED).alias("rule_failed"), F.expr(KEPT).alias("kept")))


#: The rule that every text has to pass, and whether a cutoff is exceeded.
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"
FAILED = " or ".join(f"coalesce({r} > c_{r}, false)" for r in RULES)
KEPT = f"not ({BASE_FAILED} or {FAILED})"


def fitted(docs: DataFrame, labels: DataFrame, risk: float, error: float) -> tuple[DataFrame, DataFrame]:
    """(features of all documents, cutoffs per stratum)."""
    rows = docs.select("doc_id", "text", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"),
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"))
    features = common.stored(rates(base_features(rows, keep=["stratum", "text_key"])), "features")
    good = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id"))
    labelled = features.where(f"not ({BASE_FAILED})").join(good, "doc_id", "left_semi")
    return features, common.stored(cutoffs(labelled, risk, error), "cutoffs")


def keep_by_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """The documents that the rules keep, with their columns.

    Texts are counted a second time instead of being shuffled to meet their verdicts.
    The cutoffs' table has one row per language; Spark broadcasts it as long as it is small.
    """
    _, limits = fitted(docs, labels, risk, error)
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text",
                      F.coalesce(F.col("lang"), F.lit("")).alias("stratum"))
    checked = rates(base_features(row, keep=["row", "stratum"])).join(limits, "stratum", "left")
    # A filter would be pushed below, and the nested counts be written out in it many times.
    return checked.select(F.explode(F.when(F.expr(KEPT), F.array("row"))).alias("row")).select("row.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
