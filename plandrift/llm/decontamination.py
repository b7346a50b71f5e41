"""Benchmark decontamination (13): one Aho-Corasick automaton, texts scanned once.

Test questions and answers are normalised to words, and every window of ``width`` words
becomes a pattern over word numbers; an item of fewer words is one pattern. A number is
written in two or three digits, each place having digits of its own, so that states have
few branches and patterns meet texts at words only. A text is normalised the same way,
its words become numbers, and the automaton reports each pattern with the place where it
ends. Words that no item has break every match, so they share one sign. Positions in
the original text are worked out for texts with matches only.

The items have a block for every ``block_words`` words; items are dealt to blocks by
hash, long ones in overlapping pieces. Each block is one automaton, so what is broadcast
and held by a task has that bound. Usual benchmarks are one block; with more, the texts
go through one block after the other and carry their matches along.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from plandrift.llm import common

WIDTH = 10
#: About two kilobytes of automaton for each word.
BLOCK_WORDS = 100_000
#: Digits of word numbers by place, from here on; other words are written as UNKNOWN.
DIGITS, FIRST_DIGIT, UNKNOWN = 64, 0x100, "\x00"
#: Words that an item is cut to before its pieces are dealt to blocks.
PIECE = 10_000
#: Letters A-Z, digits and all that is not ASCII make words; lower case after folding.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ROWS_AT_ONCE = 256


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Matcher:
    """Windows of items by Aho-Corasick over word numbers."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        """``items``: (id, words joined by spaces)."""
        lines = [(name, [w for w in text.encode().split(b" ") if w]) for name, text in items]
        words = sorted({w for _, line in lines for w in line})
        n_digits = 1
        while DIGITS ** n_digits < len(words):
            n_digits += 1
        self.numbers = {w: "".join(chr(FIRST_DIGIT + DIGITS * k + number // DIGITS ** (n_digits - 1 - k) % DIGITS)
                                   for k in range(n_digits)) for number, w in enumerate(words)}
        self.ids = sorted({name for name, _ in lines})
        place = {name: i for i, name in enumerate(self.ids)}
        self.automaton = ahocorasick.Automaton()
        for name, line in lines:
            signs = [self.numbers[w] for w in line]
            for start in range(max(1, len(line) - width + 1) if line else 0):
                pattern = signs[start:start + width]
                key = "".join(pattern)
                _, places = self.automaton.get(key, (0, ()))
                if place[name] not in places:
                    self.automaton.add_word(key, (len(pattern), (*places, place[name])))
        self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(stretches of matched words as (first, end), in order and apart; items that match)."""
        if not self.ids or not words:
            return [], set()
        get = self.numbers.get
        signs = [get(w, UNKNOWN) for w in words]
        stretches: list[tuple[int, int]] = []
        found: set[int] = set()
        ends: list[int] | None = None
        for last, (length, places) in self.automaton.iter("".join(signs)):
            if ends is None:
                ends = list(accumulate(map(len, signs)))
            found.update(places)
            end = bisect_right(ends, last) + 1
            start = end - length
            # Ends come in order; a longer pattern may reach back over several stretches.
            while stretches and stretches[-1][1] >= start:
                start = min(start, stretches.pop()[0])
            stretches.append((start, end))
        return stretches, {self.ids[i] for i in found}


def _joined(old: list[dict], new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted([*((x["first"], x["end"]) for x in old), *new]):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_pieces(benchmark: DataFrame, width: int, item_id: str, text: str) -> DataFrame:
    """(item_id, words): items' normalised words, cut so that no window is lost."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lowered = F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)), F.lit(PIECE))
    return (benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words.alias("w"))
            .where(F.size("w") > 0).withColumn("start", F.explode(starts))
            .select("item_id", "start", F.slice("w", F.col("start") + 1, PIECE + width - 1).alias("w")))


FOUND = [StructField("n_words", LongType()), StructField("items", ArrayType(StringType())), StructField("stretches", ArrayType(
    StructType([StructField("first", LongType()), StructField("end", LongType())])))]
SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def matched(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS,
            text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all by default), n_words, stretches of hit words, items.

    ``keep`` must hold no column named n_words, stretches, items or __text. A null text
    has no words and no matches; a null item id counts as the empty string, an item
    without words never occurs, rows with one id are one item. Repeated rows stay; an
    empty table gives no rows, an empty benchmark no matches.
    """
    spark = docs.sparkSession
    pieces = common.stored(item_pieces(benchmark, width, item_id, item_text), "items")
    n_words = pieces.agg(F.coalesce(F.sum(F.size("w")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = max(1, -(-n_words // block_words))
    block = F.pmod(F.xxhash64("item_id", "start"), F.lit(n_blocks))
    names = list(keep) if keep is not None else docs.columns
    frame = docs.select(*names, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    schema = StructType([*frame.schema, *FOUND])
    for k in range(n_blocks):
        rows = pieces.where(block == k).select("item_id", F.array_join("w", " ").alias("w")).collect()
        items = spark.sparkContext.broadcast([(r["item_id"], r["w"]) for r in rows])
        if k:
            frame = common.stored(frame, "matched")
        frame = frame.mapInArrow(_scanner(items, width, uuid.uuid4().hex), schema)
    return frame.drop("__text")


_matchers: dict[str, Matcher] = {}


def _scanner(items, width: int, key: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _matchers:  # a worker keeps one automaton from task to task
            _matchers.clear()
            _matchers[key] = Matcher(items.value, width)
        for part in common.column_chunks(batches, ROWS_AT_ONCE):
            yield _scanned(part, _matchers[key])

    return scan


def _scanned(batch: pa.RecordBatch, matcher: Matcher) -> pa.RecordBatch:
    names = batch.schema.names
    again = "stretches" in names
    counts, stretches, items = [], [], []
    for i, text in enumerate(batch.column(names.index("__text")).to_pylist()):
        words = words_of(text)
        spans, found = matcher.find(words)
        if again:
            spans = _joined(batch.column(names.index("stretches"))[i].as_py(), spans)
            found |= set(batch.column(names.index("items"))[i].as_py())
        counts.append(len(words))
        stretches.append([{"first": a, "end": b} for a, b in spans])
        items.append(sorted(found))
    own = [(n, c) for n, c in zip(names, batch.columns) if n not in ("n_words", "stretches", "items")]
    return pa.RecordBatch.from_arrays(
        [*(c for _, c in own), pa.array(counts, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(stretches, SPANS)],
        names=[*(n for n, _ in own), "n_words", "items", "stretches"])


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       **settings) -> DataFrame:
    """doc_id, start, end, passage: stretches of the original text that hold test items.

    Code points, end exclusive, from the first to the last matched word; one row per
    stretch, in texts with matches only. ``settings`` and odd rows: see ``matched``.
    """
    renamed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    hits = matched(renamed, benchmark, text="text", **settings).where(F.size("stretches") > 0)
    schema = StructType([*hits.select("doc_id").schema, StructField("start", LongType()), StructField("end", LongType()),
                         StructField("passage", StringType())])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bounds = [m.span() for m in _WORD.finditer(row["text"])]
                spans = [(bounds[s["first"]][0], bounds[s["end"] - 1][1]) for s in row["stretches"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_id"]] * len(spans), batch.schema.field("doc_id").type),
                     pa.array([a for a, _ in spans], pa.int64()), pa.array([b for _, b in spans], pa.int64()),
                     pa.array([row["text"][a:b] for a, b in spans], pa.string())], names=["doc_id", "start", "end", "passage"])

    return hits.mapInArrow(locate, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The documents without any matched window, with their columns whatever their names."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    found = matched(rows, benchmark, text="text", keep=["row"], **settings)
    return found.where(F.size("stretches") == 0).select("row.*")


def digests(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of ``docs``."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = matched(named, benchmark, text="text", keep=["doc_id"], **settings)
    n_hit = F.aggregate("stretches", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("stretches") > 0).alias("contaminated"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH low AS (SELECT *, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS phrase
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT k FROM p),
x AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)),
h AS (SELECT r, item_id, i, k FROM x JOIN p USING (k, phrase)),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM h) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
      FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""
