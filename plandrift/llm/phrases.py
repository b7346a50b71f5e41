"""Phrase collocations (11): SON partitioning, then exact counts of the candidates.

A shard is every ``shards``-th partition of the input. A phrase that occurs ``support``
times occurs at least ceil(support / shards) times in one shard, however its occurrences
are spread. So each shard is mined completely at that lowered support, in units of (hash
range of phrases); the locally frequent phrases of all shards are united, and a second
pass over the texts counts every candidate exactly.

A task counts its own phrases first, with exact ids for its words, and sends each
distinct one once. The union of candidates travels back as a bitmap of fixed size. What
only shares a candidate's bit is counted, too, and falls under the support like any other
rare phrase: bits and hashes decide what is counted, never a count. As the bitmap fills
up at very large inputs, more phrases are counted in the shuffle; results stay the same.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plandrift.llm import common

ENDS = b".,;:!?\n\x0b\x0c\r"  # fixed values: characters that end a piece
BREAK = b"\xff"  # never part of UTF-8
_FOLD = bytes(0xFF if b in ENDS else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))
#: Ids of words take 21 bits, so that three fit into a key of 64.
ID_BITS = 21
#: Tokens that a task counts at once, and that it takes from a text at once.
MOST_TOKENS, SLICE = 800_000, 200_000
#: Candidates travel as a bitmap of 2^28 bits (32 MB), whatever their number.
BITMAP_BITS = 28
RANGE_BYTES = 8_000_000
ROWS_AT_ONCE = 256
#: Sum of the hashes of a phrase's words, by place.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def tokens_of(text: bytes) -> list[bytes]:
    """Words, with BREAK where a piece ends."""
    return text.translate(_FOLD).replace(BREAK, b" \xff ").split()


class _Ids(dict):
    """Words of one language to ids that no other language uses."""

    def __init__(self, words: list[bytes], hashes: list[int], lang: str):
        super().__init__({BREAK: 0})
        self.words, self.hashes, self.seed = words, hashes, xxhash.xxh64_intdigest(lang.encode())

    def __missing__(self, word: bytes) -> int:
        known = self[word] = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return known


class PhraseCounter:
    """Counts phrases of one to three words of texts; bounded by MOST_TOKENS."""

    def __init__(self):
        self.n_words: Counter[str] = Counter()
        self._clear()

    def _clear(self) -> None:
        self.words: list[bytes] = [b""]
        self.hashes: list[int] = [0]
        self.langs: dict[str, _Ids] = {}
        self.arrays: list[np.ndarray] = []
        self.seen: list[int] = []
        self.size = 0

    def slices(self, lang: str, text: bytes) -> Iterator[bool]:
        """Takes a text slice by slice; yields whether the counts must be flushed now."""
        words = tokens_of(text)
        self.n_words[lang] += len(words) - words.count(BREAK)
        for start in range(0, len(words), SLICE):
            part = words[max(0, start - 2):start + SLICE]
            if self.size and (self.size + len(part) > MOST_TOKENS or len(self.words) + len(part) >= 1 << ID_BITS):
                yield True
            ids = self.langs.get(lang)
            if ids is None:
                ids = self.langs[lang] = _Ids(self.words, self.hashes, lang)
            # Two words of the slice before stand in front; phrases that end there are counted there.
            lead = min(start, 2)
            self.seen.extend(self.size + 1 + i for i in range(lead))
            self.arrays.append(np.fromiter(map(ids.__getitem__, [BREAK, *part]), np.int64, len(part) + 1))
            self.size += len(part) + 1

    def flush(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, counts, hash values) of distinct phrases; a key holds the ids of its words."""
        if not self.arrays:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64)
        ids = np.concatenate([np.zeros(2, np.int64), *self.arrays])
        ends = ids > 0
        ends[2 + np.array(self.seen, dtype=np.int64)] = False
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        two = ends[2:] & (b > 0)
        three = two & (a > 0)
        keys = np.concatenate([c[ends[2:]], (b[two] << ID_BITS) | c[two],
                               (a[three] << 2 * ID_BITS) | (b[three] << ID_BITS) | c[three]])
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(first, append=len(keys))
        keys = keys[first]
        hashes = np.array(self.hashes, dtype=np.uint64)
        low = (1 << ID_BITS) - 1
        values = np.zeros(len(keys), dtype=np.uint64)
        for place in range(3):
            values += (hashes * _PLACES[place])[(keys >> (place * ID_BITS)) & low]
            values ^= values >> np.uint64(29)
            values *= np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(32)
        return keys, counts, values


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[PhraseCounter]:
    """The counter, each time that it is to be flushed; it is emptied afterwards."""
    counter = PhraseCounter()
    for batch in common.column_chunks(batches, ROWS_AT_ONCE):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for _ in counter.slices(lang, text):
                yield counter
                counter._clear()
    yield counter


def _ranges(n_bytes: int) -> int:
    """Binary logarithm of the number of hash ranges, each for so many bytes of text."""
    return min(20, max(6, math.ceil(math.log2(max(1, n_bytes / RANGE_BYTES)))))


def locally_frequent(texts: DataFrame, support: int, shards: int, range_bits: int) -> bytes:
    """Bitmap of all phrases that are frequent in one shard at least; see the module."""
    local = math.ceil(support / shards)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for counter in _counted(batches):
            _, counts, values = counter.flush()
            values >>= np.uint64(32 - range_bits)
            order = np.argsort(values)
            values, counts = values[order], np.minimum(counts[order], support).astype(np.uint8)
            cuts = np.searchsorted(values >> np.uint64(32), np.arange((1 << range_bits) + 1, dtype=np.uint64))
            rows = [(r, shard, values[x:y].astype(np.uint32).tobytes(), counts[x:y].tobytes())
                    for r, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(("range", "shard", "v", "n"), row)) for row in rows],
                                                 schema=MINED)

    width = BITMAP_BITS - range_bits

    def unite(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << width, dtype=bool)
        of = np.array(table.column("shard"))
        for shard in np.unique(of):
            mine = table.filter(pa.array(of == shard))
            values = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in mine.column("v")])
            counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in mine.column("n")])
            order = np.argsort(values, kind="stable")
            values, counts = values[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            total = np.add.reduceat(counts, first, dtype=np.int64)
            bits[values[first][total >= local] >> np.uint32(32 - width)] = True
        return pa.table({"range": table.column("range")[:1], "bits": [np.packbits(bits).tobytes()]},
                        schema=pa.schema([("range", pa.int32()), ("bits", pa.binary())]))

    mined = texts.mapInArrow(mine, "range int, shard int, v binary, n binary")
    segments = mined.groupBy("range").applyInArrow(unite, "range int, bits binary").collect()
    whole = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    size = (1 << width) // 8
    for row in segments:
        whole[row["range"] * size:(row["range"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return whole.tobytes()


MINED = pa.schema([("range", pa.int32()), ("shard", pa.int32()), ("v", pa.binary()), ("n", pa.binary())])
COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("n", pa.int64())])


def phrase_counts(docs: DataFrame, support: int = 10, shards: int = 3,
                  text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, n) of phrases of k = 1 to 3 words with n >= support, (lang, n) words).

    A null text is empty, a null language ``und``; repeated rows count each time. An
    empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    range_bits = _ranges(n_bytes)
    bitmap = spark.sparkContext.broadcast(locally_frequent(texts, support, shards, range_bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        counter = None
        for counter in _counted(batches):
            keys, counts, values = counter.flush()
            at = values >> np.uint64(64 - BITMAP_BITS)
            chosen = np.flatnonzero((bits[at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8)) & 0x80)
            keys, counts = keys[chosen], counts[chosen]
            words = counter.words
            low = (1 << ID_BITS) - 1
            owner = np.zeros(len(words), dtype=np.int32)
            names = list(counter.langs)
            for i, ids in enumerate(counter.langs.values()):
                owner[np.fromiter(ids.values(), np.int64, len(ids))] = i
            last = keys & low
            middle, first = (keys >> ID_BITS) & low, keys >> 2 * ID_BITS
            k = 1 + (middle > 0) + (first > 0)
            phrases = [b" ".join((words[x], words[y], words[z])) if x else b" ".join((words[y], words[z])) if y else words[z]
                       for x, y, z in zip(first.tolist(), middle.tolist(), last.tolist())]
            yield pa.record_batch([
                pa.DictionaryArray.from_arrays(pa.array(owner[last]), pa.array(names, pa.string())).cast(pa.string()),
                pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(k.astype(np.int32)),
                pa.array(counts.astype(np.int64))], schema=COUNTED)
        totals = [(name, None, 0, n) for name, n in counter.n_words.items()] if counter else []
        yield common.record_batch(COUNTED, zip(*totals) if totals else [[], [], [], []])

    emitted = texts.mapInArrow(count, "lang string, phrase string, k int, n long")
    counts = common.stored(emitted.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))
                           .where((F.col("k") == 0) | (F.col("n") >= support)), "phrases")
    return counts.where("k > 0"), counts.where("k = 0").select("lang", "n")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a^2 / (left * right)) in exact decimals."""
    wide = lambda c: c.cast("decimal(15,0)")
    square = (F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a))).cast("decimal(38,0)")
    return F.call_function("div", square, wide(left) * wide(right)).cast("long")


def collocations(docs: DataFrame, support: int = 10, share: int = 50, top: int | None = 2000, shards: int = 3,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of two or three words, best first.

    a, l, r: occurrences of the phrase, of its part before the lowest-scoring cut and of
    the rest; n: words of the language; score: floor(1000000 a^2 / (l r)). A phrase
    inside a longer candidate that makes up ``share`` percent of its occurrences is
    left out. ``top`` phrases per language, all of them if it is None. Ties in score
    and occurrences go by the phrase's bytes, so ranks never tie. Odd rows: see
    ``phrase_counts``.
    """
    counts, words = phrase_counts(docs, support, shards, text, lang)
    part = lambda *places: F.array_join(F.array(*[F.col("w")[p] for p in places]), " ")
    slot = lambda name, value: F.struct(F.lit(name).alias("slot"), value.alias("part"))
    phrases = counts.where("k > 1").withColumn("w", F.split("phrase", " "))
    # Parts are at least as frequent as the phrase, so each one has its row in ``counts``.
    parts = phrases.select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(
        F.when(F.col("k") == 2, F.array(slot("l1", part(0)), slot("r1", part(1))))
        .otherwise(F.array(slot("l1", part(0)), slot("r1", part(1, 2)), slot("l2", part(0, 1)), slot("r2", part(2))))
    ).alias("s")).select("lang", "phrase", "a", "s.slot", "s.part")
    met = parts.join(counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"])
    longer = (phrases.where("k = 3")
              .select("lang", F.col("n").alias("longer"), F.explode(F.array(part(0, 1), part(1, 2))).alias("phrase")))
    rows = met.unionByName(longer, allowMissingColumns=True).groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.max("longer").alias("longer"),
        *[F.max(F.when(F.col("slot") == name, F.col("f"))).alias(name) for name in ("l1", "r1", "l2", "r2")])
    rows = rows.where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).withColumns({
        "s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    best = F.when(second, F.struct(F.col("l2").alias("l"), F.col("r2").alias("r"), F.col("s2").alias("score"))
                  ).otherwise(F.struct(F.col("l1").alias("l"), F.col("r1").alias("r"), F.col("s1").alias("score")))
    rows = rows.select("lang", "phrase", "a", best.alias("best")).select("lang", "phrase", "a", "best.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # The best of each part of a language first, so that few rows of it meet in one task.
        rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(8)))
        rows = (rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
                .where(F.col("rank") <= top).drop("rank", "part"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        rows = rows.where(F.col("rank") <= top)
    return rows.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                           "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, lang, p, i, w FROM (
    SELECT doc_id, lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
      SELECT doc_id, lang, generate_subscripts(ps, 1) AS p,
             list_filter(string_split_regex(unnest(ps), '[\x20\x09]'), lambda x: x <> '') AS ws
      FROM (SELECT doc_id, coalesce(lang, 'und') AS lang, string_split_regex(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]') AS ps
            FROM (SELECT row_number() OVER () AS doc_id, lang, text FROM documents)) ) ) ),
near AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3
         FROM words WINDOW o AS (PARTITION BY doc_id, p ORDER BY i)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM (
        SELECT lang, 1 AS k, w AS phrase FROM near
        UNION ALL SELECT lang, 2, w || ' ' || w2 FROM near WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM near WHERE w3 IS NOT NULL)
      GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS s FROM f WHERE k > 1),
cuts AS (SELECT lang, phrase, a, 1 AS cut, s[1] AS p, array_to_string(s[2:], ' ') AS q FROM c
         UNION ALL SELECT lang, phrase, a, 2, array_to_string(s[1:2], ' '), s[3] FROM c WHERE k = 3),
scored AS (SELECT cuts.*, x.n AS l, y.n AS r, 1000000 * a * a // (x.n * y.n) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (
             SELECT lang, array_to_string(s[1:2], ' ') AS phrase, a FROM c WHERE k = 3
             UNION ALL SELECT lang, array_to_string(s[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g USING (lang, phrase) WHERE coalesce(100 * g.a < 50 * b.a, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n, score::BIGINT AS score
FROM kept JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) USING (lang) QUALIFY rank <= 2000
"""
