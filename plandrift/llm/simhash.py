"""SimHash near-dedup (9): BK-trees over shards of fingerprints.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's
word shingles. Two fingerprints within ``radius`` bits agree on all but ``radius`` of
the blocks they are cut into, so they meet in a shard that is keyed by some of the
blocks. Each shard's distinct fingerprints form a BK-tree (children keyed by the
distance to their parent); every fingerprint of the shard follows only the edges that
can lead to one within the radius. Shards beyond a size are cut into blocks, each pair
of blocks having its own tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import common


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> bytes:
    """The 8 bytes, highest first; zero without words."""
    words = common.words_of(text)
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends][:n]
    stops = [e - 1 for e in ends[min(shingle, len(words)) - 1:]]
    digest = xxhash.xxh64_digest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):  # bounded memory for very long texts
        hashes = b"".join([digest(joined[s:e], seed) for s, e in
                           zip(starts[at:at + (1 << 15)], stops[at:at + (1 << 15)])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        votes += bits.sum(0, dtype=np.int32)
    return np.packbits(2 * votes > n).tobytes()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, code) per row, code being the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("code", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = b"".join([fingerprint(t) for t in batch.column(1).to_pylist()])
            yield common.record_batch(schema, [batch.column(0), np.frombuffer(codes, ">i8").astype(np.int64)])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, code long")


class BKTrees:
    """The BK-trees of several shards at once, one level after the other.

    ``codes`` are distinct within a shard; rows of a shard lie together. A shard's first
    row is its root; of the rows that come to a node at a distance not seen there, the
    first becomes the child.
    """

    def __init__(self, codes: np.ndarray, shard: np.ndarray):
        n = len(codes)
        self.codes = codes
        first = np.ones(n, bool)
        first[1:] = shard[1:] != shard[:-1]
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1]
        at, alive = self.root.copy(), np.flatnonzero(~first)
        keys, nodes = [], []
        while alive.size:
            link = at[alive] * 65 + np.bitwise_count(codes[alive] ^ codes[at[alive]])
            order = np.argsort(link, kind="stable")
            link, alive = link[order], alive[order]
            lead = np.ones(len(link), bool)
            lead[1:] = link[1:] != link[:-1]
            keys.append(link[lead])
            nodes.append(alive[lead])
            at[alive] = alive[lead][np.cumsum(lead) - 1]
            alive = alive[~lead]
        keys = np.concatenate([*keys, np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]  # parent * 65 + distance: a node's children lie together
        self.nodes = np.concatenate([*nodes, np.zeros(0, np.int64)])[order]

    def pairs(self, radius: int, step: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (a, b), a > b, of one shard within the radius, each pair once."""
        for start in range(0, len(self.codes), step):
            query = np.arange(start, min(start + step, len(self.codes)))
            node = self.root[query]
            while query.size:
                d = np.bitwise_count(self.codes[query] ^ self.codes[node]).astype(np.int64)
                hit = (d <= radius) & (node < query)
                yield query[hit], node[hit]
                low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
                high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
                n = high - low
                query = np.repeat(query, n)
                node = self.nodes[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _shard_keys(radius: int) -> list[list[tuple[int, int]]]:
    """Block choices: of radius + 2 blocks any two stay equal within the radius."""
    n = radius + 2
    borders = [round(64 * k / n) for k in range(n + 1)]
    blocks = [(borders[k], borders[k + 1] - borders[k]) for k in range(n)]
    return [list(c) for c in combinations(blocks, 2)]


def links(codes: DataFrame, radius: int = 3, most: int = 8192) -> DataFrame:
    """Pairs (a, b) of the distinct ``code`` values that connect all within the radius.

    Of a shard's pairs only a spanning forest comes back, at most one row per
    fingerprint and unit. A unit (a shard, or two blocks of a larger one) holds about
    2 * ``most`` fingerprints.
    """
    code = F.col("code")
    shards = F.array(*[
        F.struct(F.lit(k).alias("choice"), F.concat_ws(":", *[
            F.shiftrightunsigned(code, 64 - at - size).bitwiseAND(F.lit((1 << size) - 1)) for at, size in choice
        ]).alias("key")) for k, choice in enumerate(_shard_keys(radius))])
    keyed = codes.select("code", F.explode(shards).alias("s")).select("code", F.xxhash64("s.choice", "s.key").alias("shard"))
    sizes = keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64("code"), parts).cast("int")
    units = (keyed.join(sizes, "shard").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("code", F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("unit")))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(unit: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
            trees = BKTrees(code.astype(np.uint64), unit)
            label = np.arange(len(code))
            for a, b in trees.pairs(radius):
                if a.size:
                    a, b = label[a], label[b]
                    differ = a != b
                    if differ.any():
                        label = common.labels_by_minimum(len(code), a[differ], b[differ])[label]
            low = code[label]
            own = np.flatnonzero(label != np.arange(len(code)))
            return common.record_batch(schema, [code[own], low[own]])

        held_unit, held_code = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:  # sorted by unit; the last unit may go on
            held_unit = np.concatenate([held_unit, batch.column(1).to_numpy()])
            held_code = np.concatenate([held_code, batch.column(0).to_numpy()])
            if len(held_unit) >= 1 << 16 and (end := np.searchsorted(held_unit, held_unit[-1])):
                yield found(held_unit[:end], held_code[:end])
                held_unit, held_code = held_unit[end:], held_code[end:]
        if len(held_unit):
            yield found(held_unit, held_code)

    return (units.repartition("unit").sortWithinPartitions("unit", "code")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row.

    Texts without words (null, empty) have fingerprint zero and link as any other.
    Equal fingerprints link. ``component_id`` is the smallest id reachable; ids that are
    null never become it unless a component has no other. Repeated rows stay, other
    columns are not looked at, an empty table gives no rows.
    """
    codes = common.stored(fingerprints(docs, doc_id, text), "fingerprints")
    low = common.stored(codes.groupBy("code").agg(F.min("doc_id").alias("low")), "codes")
    parts = common.connected_components(links(low.select("code"), radius))
    named = low.join(parts.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "low", F.coalesce("component", "code").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select("code", "component_id")
    return codes.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """The row of the smallest ``doc_id`` of each component, with all its columns.

    Of rows that repeat this id one stays. Rows without an id can't be told apart and
    all stay.
    """
    return _lowest_of_each(docs, near_duplicates(docs.where("doc_id is not null"), radius))


def _lowest_of_each(docs: DataFrame, parts: DataFrame) -> DataFrame:
    kept = parts.groupBy("component_id").agg(F.count("*").alias("_")).select(F.col("component_id").alias("doc_id"))
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))


def shingle_hashes(text: bytes | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted; one of all words where they are fewer."""
    words = common.words_of(text)
    n = max(1, len(words) - shingle + 1) if words else 0
    hashes = b"".join([xxhash.xxh64_digest(b" ".join(words[k:k + shingle]), seed) for k in range(n)])
    return np.unique(np.frombuffer(hashes, ">u8").astype(np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repetitions; 1 if both are empty."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / union if (union := len(a) + len(b) - both) else 1.0


_MIX = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each band a hash of ``rows`` minima; sets share a band's key with probability J^rows.

    Multiplication by an odd number permutes the hashes; each minimum is one of such an order.
    """
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 12):  # bounded memory for very long texts
        block = hashes[at:at + (1 << 12), None] * _MIX[None, :bands * rows]
        np.minimum(least, block.min(0), out=least)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in least.reshape(bands, rows).T:
        keys = (keys ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def parity_sketch(hashes: np.ndarray) -> list[int]:
    """16 longs, each bit being the parity of the number of hashes that fall on it.

    Two sets differ in at least as many members as their sketches differ in bits.
    """
    odd = np.bincount((hashes >> np.uint64(54)).astype(np.int64), minlength=1024) % 2
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def _possible(size: np.ndarray, sketch: np.ndarray, near_size: np.ndarray, near_sketch: np.ndarray, least: float) -> np.ndarray:
    """Whether sets (row) and near sets (column) may have that Jaccard similarity.

    A bound, not an estimate: with S members together and a difference of D or more, the
    similarity is (S - D) / (S + D) at most.
    """
    bits = np.bitwise_count(sketch[:, None, :] ^ near_sketch[None]).sum(2, dtype=np.int64)
    difference = np.maximum(bits, np.abs(size[:, None] - near_size[None]))
    both = size[:, None] + near_size[None]
    return both - difference >= least * (both + difference) - 1e-6


def _classes(texts: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, digest, code, bands, size, sketch) per row, the last five of the set of shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("digest", pa.int64()),
                        ("code", pa.int64()), ("bands", pa.list_(pa.int64())), ("size", pa.int64()),
                        ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.column_chunks(batches, 200):
            digests, codes, keys, sizes, sketches = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_hashes(text, shingle)
                digests.append(xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63))
                codes.append(fingerprint(text))
                keys.append(band_keys(hashes, bands, rows))
                sizes.append(len(hashes))
                sketches.append(parity_sketch(hashes))
            yield common.record_batch(schema, [
                batch.column(0), batch.column(1), digests, np.frombuffer(b"".join(codes), ">i8").astype(np.int64), keys,
                sizes, sketches])

    return (texts.select("doc_id", "node", F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, digest long, code long, bands array<long>, size long, sketch array<long>"))


def _near_codes(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b) of nodes that connect fingerprints within the radius, found by the BK-trees."""
    first = common.stored(nodes.groupBy("code").agg(F.min("node").alias("first")), "codes")
    same = nodes.select("node", "code").join(first, "code").select(F.col("first").alias("a"), F.col("node").alias("b"))
    side = lambda k: first.select(F.col("code").alias(k), F.col("first").alias(f"of_{k}"))
    near = links(first.select("code"), radius).join(side("a"), "a").join(side("b"), "b")
    return same.unionByName(near.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _part(spread: int) -> Column:
    """The part of its bucket that a member falls into; a bucket of at most ``spread`` members has each in its own."""
    return F.when(F.col("n") <= spread, F.col("node")).otherwise(F.pmod(F.xxhash64("node", "bucket"), F.lit(spread)))


def _asked(members: DataFrame, spread: int, least: float, most: int = 8192) -> DataFrame:
    """(a, b): every member of a bucket with the bucket's representatives of other components,
    but for those that can't be similar by their sizes and sketches.

    A bucket has one representative in each of ``spread`` parts that its members fall into.
    A unit has up to about ``most`` members and as many representatives of a bucket.
    """
    columns = ["node", "component", "size", "sketch"]
    chosen = (members.groupBy("bucket", _part(spread).alias("part")).agg(F.min(F.struct(*columns, "n")).alias("r"))
              .select("bucket", "r.*"))
    n = F.col("n")
    chunks, near_chunks = (F.ceil(k / F.lit(most)).cast("int") for k in (n, F.least(n, F.lit(spread))))
    numbers = lambda k: F.explode(F.sequence(F.lit(0), k - 1))
    own = lambda k: F.pmod(F.xxhash64(F.lit("chunk"), "node"), k).cast("int")
    units = (members.select("bucket", *columns, (n <= spread).alias("every"), F.lit(False).alias("near"), own(chunks).alias("x"), numbers(near_chunks).alias("y"))
             .unionByName(chosen.select("bucket", *columns, (n <= spread).alias("every"), F.lit(True).alias("near"), own(near_chunks).alias("y"), numbers(chunks).alias("x")))
             .select(F.xxhash64("bucket", "x", "y").alias("unit"), "near", "every", *columns))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, component, size = (rows.column(k).to_numpy() for k in ("node", "component", "size"))
        sketch = np.array(rows.column("sketch").combine_chunks().flatten()).view(np.uint64).reshape(-1, 16)
        near, every = (rows.column(k).to_numpy() for k in ("near", "every"))
        here, there = np.flatnonzero(~near), np.flatnonzero(near)
        step = max(1, (1 << 16) // max(1, len(there)))  # 8 MB of sketches at once
        for at in range(0, len(here), step):
            some = here[at:at + step]
            hit = component[some, None] != component[None, there]
            hit &= ~every[some, None] | (node[some, None] < node[None, there])  # where all are chosen: once
            hit &= _possible(size[some], sketch[some], size[there], sketch[there], least)
            i, j = np.nonzero(hit)
            if i.size:
                x, y = node[some[i]], node[there[j]]
                yield common.record_batch(out, [np.minimum(x, y), np.maximum(x, y)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # sorted by unit; the last unit may go on
            unit = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
            for start, end in zip(cuts, cuts[1:]):
                if held and held[0].column(0)[0].as_py() != unit[start]:
                    yield from met(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from met(pa.Table.from_batches(held))

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts (node, text) have at least that Jaccard similarity."""
    spark = pairs.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    # A map of the leading bits, bounded in size: most texts without a pair are left out before the shuffle.
    leading = ends.select(F.shiftrightunsigned("node", 44).cast("int").alias("k")).distinct().toPandas()["k"].to_numpy()
    present = np.zeros(1 << 20, bool)
    present[leading] = True
    shared = spark.sparkContext.broadcast(np.packbits(present).tobytes())
    schema = pa.schema([("node", pa.int64()), ("hashes", pa.binary())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        for batch in common.column_chunks(batches, 200):
            node = batch.column(0).to_numpy()
            some = np.flatnonzero(present[(node.view(np.uint64) >> np.uint64(44)).astype(np.int64)])
            if some.size:
                taken = batch.column(1).take(pa.array(some)).to_pylist()
                yield common.record_batch(schema, [node[some], [shingle_hashes(t, shingle).tobytes() for t in taken]])

    sets = common.stored(texts.select("node", F.col("text").cast("binary").alias("text"))
                         .mapInArrow(hashed, "node long, hashes binary")
                         .groupBy("node").agg(F.first("hashes").alias("hashes")), "shingles")
    result = common.stored(_similar(_compared(pairs, sets), least), "similar")
    shared.unpersist()
    return result


def _compared(pairs: DataFrame, sets: DataFrame, most_bytes: int = 32 << 20, most_pairs: int = 20_000) -> DataFrame:
    """(unit, a, b, hashes): the sets that a unit compares (a, no b), and its pairs (a, b).

    Nodes fall into blocks, and a unit has the pairs between two of them, so a set moves
    to a unit once, however many pairs it is in, and to no more units than there are
    blocks. A unit holds about that many bytes of sets and pairs, if spread evenly.
    """
    total = sets.agg(F.sum(F.length("hashes").cast("long"))).first()[0] or 0
    blocks = max(1, -(-2 * total // most_bytes), math.isqrt(2 * pairs.count() // most_pairs))
    block = lambda k: F.pmod(F.xxhash64(F.lit("block"), F.col(k)), F.lit(blocks))
    paired = pairs.withColumn("unit", F.least(block("a"), block("b")) * blocks + F.greatest(block("a"), block("b")))
    needed = paired.select("unit", F.explode(F.array("a", "b")).alias("node")).distinct()
    moved = needed.join(sets, "node").select("unit", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "hashes")
    return moved.unionByName(paired.select("unit", "a", "b", F.lit(None).cast("binary").alias("hashes")))


def _similar(compared: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``_compared`` with at least that Jaccard similarity."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, at = {}, None  # those of the current unit; they come before its pairs
        for batch in common.column_chunks(batches, 1000):
            keep = []
            for unit, a, b, hashes in zip(*[c.to_pylist() for c in batch.columns]):
                if unit != at:
                    sets, at = {}, unit
                if b is None:
                    sets[a] = np.frombuffer(hashes, np.uint64)
                elif jaccard(sets[a], sets[b]) >= least:
                    keep.append((a, b))
            if keep:
                yield common.record_batch(out, list(zip(*keep)))

    return (compared.repartition("unit").sortWithinPartitions("unit", F.col("b").asc_nulls_first())
            .mapInArrow(similar, "a long, b long"))


def _copy_components(texts: DataFrame, radius: int, shingle: int, least: float, bands: int, rows: int
                     ) -> tuple[DataFrame, DataFrame]:
    """((text_hash, digest) of all texts, (digest, low, component) of all sets of shingles)."""
    known = common.stored(_classes(texts, shingle, bands, rows).groupBy("text_hash").agg(
        F.min("doc_id").alias("low"), *[F.first(c).alias(c) for c in ("digest", "code", "bands", "size", "sketch")]), "classes")
    nodes = common.stored(known.groupBy("digest").agg(
        F.min("text_hash").alias("node"), F.min("low").alias("low"), F.min("code").alias("code"),
        *[F.first(c).alias(c) for c in ("bands", "size", "sketch")]), "nodes")
    keyed = nodes.select("node", "size", "sketch", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = common.stored(keyed.join(shared, "bucket"), "buckets")
    members = buckets.withColumn("component", F.col("node"))
    pairs = _near_codes(nodes, radius).where("a <> b").select(*_ordered("a", "b"))
    spread, edges = 1, None
    while True:
        pairs = common.stored(_asked(members, spread, least).unionByName(pairs).distinct(), "candidates")
        new = _verified(pairs, texts, shingle, least)
        edges = new if edges is None else edges.unionByName(new)
        parts = common.connected_components(edges)
        members = common.stored(buckets.join(parts, "node", "left").select(
            "bucket", "node", "n", "size", "sketch", F.coalesce("component", "node").alias("component")), "members")
        # Open: more than one component, and members that have not met each other.
        state = members.groupBy("bucket", _part(spread).alias("part")).agg(
            F.min("component").alias("x"), F.max("component").alias("y"), F.max("n").alias("n"))
        left = common.stored(state.groupBy("bucket").agg(
            F.min("x").alias("x"), F.max("y").alias("y"), F.max("n").alias("n"), F.count("*").alias("k"))
            .where("x <> y and k < n - 1").select("bucket"), "open")
        if left.isEmpty():
            break
        members = common.stored(members.join(left, "bucket"), "members")
        pairs, spread = pairs.limit(0), spread * 16
    named = nodes.join(parts, "node", "left").select("digest", "low", F.coalesce("component", "node").alias("component"))
    return known.select("text_hash", "digest"), common.stored(named, "named")


def _texts(docs: DataFrame) -> DataFrame:
    # By text, not by id: ids may repeat. Null counts as empty.
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("node"), "text")


def near_copies(docs: DataFrame, radius: int = 3, shingle: int = 5, least: float = 0.8, bands: int = 16,
                rows: int = 5) -> DataFrame:
    """(doc_id, component_id) per row with an id: components of texts whose sets of word
    shingles have a Jaccard similarity of ``least``, computed exactly.

    Candidates come from the BK-trees (fingerprints within ``radius`` bits) and, as most
    near copies lie beyond, from ``bands`` of ``rows`` minima of the sets: of pairs at
    0.8 all but 0.2 % share a band. Texts with equal sets are one from the start, and
    are told apart by 64-bit hashes. The members of a band's bucket are compared with
    one representative; only buckets that hold several components then go on, with sixteen
    times as many representatives, until all members of different components have met
    or the bucket is one component; once there are as many representatives as members,
    each member is one. Pairs whose sizes or sketches rule the similarity out are
    left out before their sets are fetched. A pair
    whose only bands became one component by other links is connected all the same.
    Texts without words link to each other.
    """
    texts = _texts(docs)
    known, named = _copy_components(texts, radius, shingle, least, bands, rows)
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = known.join(named.join(lowest, "component").select("digest", "component_id"), "digest")
    return texts.select("doc_id", F.col("node").alias("text_hash")).join(ids, "text_hash").select("doc_id", "component_id")


def drop_near_copies(docs: DataFrame, radius: int = 3, shingle: int = 5, least: float = 0.8, bands: int = 16,
                     rows: int = 5) -> DataFrame:
    """As ``drop_near_duplicates``, for the components of ``near_copies``."""
    _, named = _copy_components(_texts(docs), radius, shingle, least, bands, rows)
    return _lowest_of_each(docs, named.groupBy("component").agg(F.min("low").alias("component_id")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "documents"))
