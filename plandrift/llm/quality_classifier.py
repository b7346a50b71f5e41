"""Quality classifier (7): perplexity under an interpolated modified Kneser-Ney model.

The model predicts the characters of words, so that it also scores words it has never
met. It is trained on trusted text: all documents labelled good.
Counts, continuation counts, context totals and discounts are joins and aggregates on
n-grams, sharded by them. The finished tables grow with the different n-grams of
characters, far slower than the text; they are broadcast as 64-bit hashes and values,
and each task looks up the n-grams of its words there (a shuffle of all n-grams of all
documents would move a multiple of the input). A document is rejected if
its perplexity is above a quantile of its language's trusted documents, raised by a
margin.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plandrift.llm import common

#: Entries of a worker's cache of word scores; beyond it it starts anew.
CACHE = 200_000
#: More languages than this are an error: their thresholds are kept on the driver.
MOST_LANGUAGES = 1000
#: A trusted text longer than this part of the characters, where they are bounded, is left out by itself.
LONGEST_PART = 0.1
#: Symbols that are looked up, and texts whose words are scored, at once.
LOOKED_UP, TEXTS = 1 << 18, 256


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of a ``text`` column; counted within batches before the shuffle."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.column_chunks(batches, 1000):
            counts: Counter = Counter()
            for value in batch.column(0).to_pylist():
                counts.update((value or b"").split())
            yield common.record_batch(schema, [[w.decode() for w in counts], list(counts.values())])

    return (texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def tables(words: DataFrame, order: int = 5) -> tuple[list[DataFrame], float]:
    """((gram, context, gamma, p) for each length from 1 to ``order``, log10 p of a new symbol).

    Gamma is the back-off weight of the context. Words stand between ``order`` - 1 spaces and one space. Without words the model is
    the uniform one over a single symbol.
    """
    padded = F.concat(F.lit(" " * (order - 1)), F.col("word"), F.lit(" "))
    grams = words.select("n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length(padded) - (order - 1)), lambda i: F.substring(padded, i, order))).alias("gram"))
    counts = {order: common.stored(grams.groupBy("gram").agg(F.sum("n").alias("c")), f"counts{order}")}
    for k in range(order - 1, 0, -1):
        # Continuation counts: how many different symbols come before.
        counts[k] = common.stored(counts[k + 1].groupBy(F.expr(f"substring(gram, 2, {k})").alias("gram"))
                                  .agg(F.count("*").alias("c")), f"counts{k}")
    lower, found, new_symbol = None, [], 0.0
    for k in range(1, order + 1):
        n = counts[k].agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)],
                          F.count("*").alias("types")).first()
        discounts = _discounts(n["n1"], n["n2"], n["n3"], n["n4"])
        d = F.get(F.array(*[F.lit(x) for x in discounts]), F.least(F.col("c"), F.lit(3)).cast("int") - 1)
        split = counts[k].select("gram", "c", d.alias("d"), F.expr(f"substring(gram, 1, {k - 1})").alias("context"),
                                 F.expr(f"substring(gram, 2, {k - 1})").alias("suffix"))
        contexts = split.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        joined = split.join(contexts, "context")
        if lower is None:
            joined = joined.withColumn("p_lower", F.lit(1.0 / (n["types"] + 1)))
        else:
            joined = joined.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_lower")), "suffix")
        lower = common.stored(joined.select("gram", "context", "gamma", (
            (F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("p_lower")).alias("p")), f"p{k}")
        found.append(lower)
        if k == 1:
            first = lower.select("gamma").first()
            new_symbol = (_log10(first["gamma"]) if first else 0.0) + math.log10(1.0 / (n["types"] + 1))
    return found, new_symbol


def _log10(gamma: float) -> float:
    return math.log10(gamma) if gamma > 0 else -99.0


def train(words: DataFrame, order: int = 5) -> tuple[dict[str, float], dict[str, float], float]:
    """(log10 of p per n-gram, log10 of the back-off weight per context, log10 p of a new symbol).

    On the driver, for small models; ``packed`` holds larger ones.
    """
    found, new_symbol = tables(words, order)
    probability, backoff = {}, {}
    for table in found:
        probability |= {r["gram"]: math.log10(r["p"]) for r in table.collect()}
        backoff |= {r["context"]: _log10(r["gamma"]) for r in table.select("context", "gamma").distinct().collect()}
    return probability, backoff, new_symbol


def packed(words: DataFrame, order: int = 5) -> tuple[Grams, Grams, float]:
    """As ``train``, 16 bytes an n-gram."""
    found, new_symbol = tables(words, order)
    probability = Grams({k: _hashed(t.select("gram", "p"), k) for k, t in enumerate(found, 1)})
    backoff = Grams({k: _hashed(t.select("context", "gamma").distinct(), k) for k, t in enumerate(found)})
    return probability, backoff, new_symbol


def _hashed(frame: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-grams of one length and the log10 of their values."""
    schema = pa.schema([("key", pa.int64()), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = _symbols("".join(batch.column(0).to_pylist())).reshape(batch.num_rows, length)
            yield common.record_batch(schema, [gram_keys(symbols).view(np.int64), list(map(_log10, batch.column(1).to_pylist()))])

    got = frame.mapInArrow(run, "key long, value double").toArrow()
    return got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_keys(symbols: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    keys = np.full(len(symbols), 0x9E3779B97F4A7C15, np.uint64)
    for column in symbols.T:
        keys = (keys ^ column.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys


class Grams:
    """Values of n-grams, by length: sorted hashes and their values."""

    def __init__(self, parts: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.parts = {}
        for length, (keys, values) in parts.items():
            order = np.argsort(keys)
            self.parts[length] = keys[order], values[order]

    @classmethod
    def of(cls, values: dict[str, float]) -> Grams:
        lengths = {len(g) for g in values}
        some = {k: [g for g in values if len(g) == k] for k in lengths}
        return cls({k: (gram_keys(_symbols("".join(gs)).reshape(len(gs), k)), np.array([values[g] for g in gs]))
                    for k, gs in some.items()})

    def get(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which rows of code points are known, the values of these)."""
        keys, values = self.parts.get(symbols.shape[1], (np.zeros(0, np.uint64), np.zeros(0)))
        if not len(keys):
            return np.zeros(len(symbols), bool), values[:0]
        wanted = gram_keys(symbols)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        return hit, values[at[hit]]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Those of modified Kneser-Ney for counts 1, 2, and 3 or more; within (0, count) if counts are too few."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    values = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(v, 0.05), k + 0.95) for k, v in enumerate(values)]


class WordScores(dict):
    """Word to log10 probability; looked up by the longest known context."""

    def __init__(self, model: tuple, order: int):
        super().__init__()
        probability, backoff, self.new_symbol = model
        self.probability, self.backoff = (
            Grams.of(x) if isinstance(x, dict) else x for x in (probability, backoff))
        self.order = order

    def __missing__(self, word: bytes) -> float:
        self.add({word})
        return self[word]

    def add(self, words: set[bytes]) -> None:
        """Scores those of the words that are not held, all at once."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHE:
            self.clear()
            new = list(words)
        if new:
            self.update(zip(new, self._scored(new).tolist(), strict=True))

    def _scored(self, words: list[bytes]) -> np.ndarray:
        order = self.order
        padded = [" " * (order - 1) + w.decode("utf-8", "replace") + " " for w in words]
        symbols, size = _symbols("".join(padded)), np.array([len(p) for p in padded])
        n = size - (order - 1)  # the word's symbols and the space after it
        owner = np.repeat(np.arange(len(words)), n)
        ends = np.arange(len(owner)) + order + owner * (order - 1)
        out = np.zeros(len(words))
        for at in range(0, len(ends), LOOKED_UP):
            end = ends[at:at + LOOKED_UP]
            total, left = np.zeros(len(end)), np.arange(len(end))
            for k in range(order, 0, -1):
                hit, value = self.probability.get(symbols[end[left][:, None] + np.arange(-k, 0)])
                total[left[hit]] += value
                left = left[~hit]
                if k > 1:
                    hit, value = self.backoff.get(symbols[end[left][:, None] + np.arange(-k, -1)])
                    total[left[hit]] += value
            total[left] += self.new_symbol
            out += np.bincount(owner[at:at + LOOKED_UP], total, len(words))
        return out


#: The model that this worker used last.
_scores: dict[str, WordScores] = {}


def perplexity_column(spark: SparkSession, model, order: int = 5):
    """A function of the text column: log10 of the perplexity per symbol, null without words."""
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("double")
    def log_perplexity(texts: pd.Series) -> pd.Series:
        scores = _scores.get(name)
        if scores is None:
            _scores.clear()
            scores = _scores[name] = WordScores(shared.value, order)
        out = []
        for at in range(0, len(texts), TEXTS):
            some = [(value or b"").split() for value in texts.iloc[at:at + TEXTS]]
            scores.add({w for words in some for w in words})
            for words in some:
                n = sum(map(len, map(bytes.decode, words))) + len(words) if words else 0
                out.append(-sum(map(scores.__getitem__, words)) / n if n else None)
        return pd.Series(out, dtype="float64")

    return lambda text: log_perplexity(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def classifier(docs: DataFrame, labels: DataFrame, trusted_docs: int | None = None, trusted_chars: int | None = None,
               quantile: float = 0.99, margin: float = 0.05, order: int = 5):
    """(perplexity column function, scores of all documents, thresholds by language).

    Trusted are documents all of whose labels are quality 1. The model is trained on all of
    them, a repeated id counting with one of its texts, and thresholds are quantiles over
    all of them of log10 perplexity, plus ``margin``. Where ``trusted_docs`` or
    ``trusted_chars`` are given, the model is trained on at most so many of them with so
    many characters, the lowest by a hash of the id, texts longer than ``LONGEST_PART`` of
    these characters being left out (an error if all are); thresholds are then of those
    beyond ``trusted_docs``, if there are any.
    """
    spark = docs.sparkSession
    good = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
            .where("quality = 1 and doc_id is not null").select("doc_id"))
    order_by = F.xxhash64(F.lit("trusted"), F.col("doc_id"))
    ids = good if trusted_docs is None else common.stored(good.orderBy(order_by, "doc_id").limit(trusted_docs), "trusted-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows that repeat an id count once; only their texts travel. The ids are broadcast, or all texts would.
    rows = common.stored(texts.groupBy("doc_id").agg(F.count("*").alias("n")).join(ids, "doc_id"), "trusted-rows")
    of = lambda which: texts.join(F.broadcast(rows.where(which).select("doc_id")), "doc_id", "left_semi")
    used = of("n = 1").unionByName(of("n > 1").groupBy("doc_id").agg(F.min("text").alias("text")))
    if trusted_chars is not None:
        sample = common.stored(used, "trusted")
        # The window sees lengths only.
        so_far = F.sum("n").over(Window.orderBy(order_by, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
        # Long texts leave before the sum, or they would take all texts after them along.
        within = (sample.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
                  .where(F.col("n") <= LONGEST_PART * trusted_chars).withColumn("so_far", so_far).where(F.col("so_far") <= trusted_chars))
        if within.isEmpty() and not sample.isEmpty():
            raise ValueError(f"every trusted text is longer than {LONGEST_PART * trusted_chars:.0f} characters")
        used = sample.join(within.select("doc_id"), "doc_id")
    column = perplexity_column(spark, packed(word_counts(used), order), order)
    scored = common.stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", column(F.col("text")).alias("score")), "scores")
    at = lambda which: F.percentile_approx(F.when(which, F.col("score")), quantile, 10_000)
    beyond = F.lit(False)
    if trusted_docs is not None:
        good, beyond = good.join(ids.withColumn("sampled", F.lit(True)), "doc_id", "left"), F.col("sampled").isNull()
    limits = (scored.join(good, "doc_id").groupBy(F.coalesce("lang", F.lit("")).alias("lang"))
              .agg(F.coalesce(at(beyond), at(F.lit(True))).alias("limit")).where("limit is not null"))
    limits = limits.limit(MOST_LANGUAGES + 1).collect()
    if len(limits) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return column, scored, {r["lang"]: r["limit"] + margin for r in limits}


def _limit(thresholds: dict[str, float]):
    pairs = [F.lit(x) for pair in thresholds.items() for x in pair]
    return F.create_map(*pairs)[F.coalesce(F.col("lang"), F.lit(""))] if pairs else F.lit(None).cast("double")


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, lang, log10_perplexity, threshold and kept per row.

    A text without words (null, empty) has no perplexity and is rejected. A language
    without trusted documents has no threshold and keeps its texts. Repeated rows and
    null ids stay; an empty table gives no rows; other columns are not looked at.
    """
    _, scored, thresholds = classifier(docs, labels, **options)
    scored = scored.withColumnRenamed("score", "log10_perplexity").withColumn("threshold", _limit(thresholds))
    return scored.withColumn("kept", F.col("log10_perplexity").isNotNull() & F.coalesce(
        F.col("log10_perplexity") <= F.col("threshold"), F.lit(True)))


def keep_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, with their columns.

    Texts are scored a second time instead of being shuffled to meet their verdicts.
    """
    column, _, thresholds = classifier(docs, labels, **options)
    row = docs.select(F.struct(*docs.columns).alias("row"), "lang", column(F.col("text")).alias("score"))
    kept = F.col("score").isNotNull() & F.coalesce(F.col("score") <= _limit(thresholds), F.lit(True))
    return row.where(kept).select("row.*")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
