"""Embedding near-dedup (6): spherical-cap filters of a structured product code.

A rotated unit vector is cut into blocks; each block has a code of random directions,
and a filter direction is one code word per block. A vector's caps are all directions
whose inner product with it exceeds a threshold; they are listed by going through the
first block's words in descending order and stopping where the rest can't reach it.
Vectors that share a cap are compared in double precision. A pair counts in the first
cap that it shares, so counts need no list of pairs.

Equal vectors form a class that is compared once. Large caps are cut into blocks, each
pair of blocks being a unit of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import common


class ProductCode:
    """``words`` random directions in each of two blocks of a rotated space."""

    def __init__(self, dimensions: int, words: int = 256, threshold: float = 0.415, least: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.words, self.least = words, least
        self.rotation = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0]
        half = dimensions // 2
        self.blocks = [slice(0, half), slice(half, dimensions)]
        self.codes = []
        for block in self.blocks:
            code = rng.standard_normal((words, block.stop - block.start))
            norms = np.linalg.norm(code, axis=1, keepdims=True)
            self.codes.append(code / np.where(norms > 0, norms, 1) / np.sqrt(2))
        # The threshold is given for 64 dimensions; inner products shrink with the root of them.
        self.threshold = threshold * np.sqrt(64 / dimensions)

    def caps(self, unit: np.ndarray) -> list[np.ndarray]:
        """Of each row the sorted numbers of its caps; the ``least`` nearest always count."""
        turned = unit @ self.rotation
        first, second = (turned[:, b] @ c.T for b, c in zip(self.blocks, self.codes, strict=True))
        out = []
        for a, b in zip(first, second, strict=True):
            order_a, order_b = np.argsort(-a), np.argsort(-b)
            sorted_b = b[order_b]
            nearest = np.add.outer(a[order_a[:self.least]], sorted_b[:self.least]).ravel()
            t = min(self.threshold, np.sort(nearest)[-min(self.least, nearest.size)])
            listed = []
            for i in order_a:
                if a[i] + sorted_b[0] < t:
                    break
                n = np.searchsorted(-sorted_b, a[i] - t, "right")
                listed.append(i * self.words + order_b[:n])
            out.append(np.sort(np.concatenate(listed)).astype(np.int32))
        return out


@lru_cache(maxsize=4)
def product_code(dimensions: int, words: int, threshold: float, least: int) -> ProductCode:
    return ProductCode(dimensions, words, threshold, least)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def linked(classes: DataFrame, similarity: float = 0.95, words: int = 256, threshold: float = 0.415,
           least: int = 8, most: int = 1024) -> DataFrame:
    """(a, b, n) per class and unit: links of class ``a`` found there, weighted by the
    linked classes' sizes, and a class ``b`` of its component in the unit.

    ``classes``: id, size, vector (valid, all of one length per comparison: vectors of
    different lengths never meet, as the length is part of the cap).
    """
    schema = pa.schema([("id", pa.int64()), ("size", pa.int64()), ("vector", pa.list_(pa.float32())),
                        ("length", pa.int32()), ("caps", pa.list_(pa.int32()))])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.column_chunks([batch], 2000):
                lengths = np.asarray(rows.column("length"))
                for length in np.unique(lengths):
                    some = rows.filter(pa.array(lengths == length))
                    v = _vectors(some.column("vector"))
                    # Scaled first, so that squares neither over- nor underflow.
                    v = v / np.abs(v).max(1, keepdims=True)
                    caps = product_code(int(length), words, threshold, least).caps(v / np.linalg.norm(v, axis=1, keepdims=True))
                    yield pa.record_batch([some.column("id"), some.column("size"), some.column("vector"),
                                           some.column("length"), pa.array(caps, pa.list_(pa.int32()))], schema=schema)

    capped = common.stored(classes.mapInArrow(
        listed, "id long, size long, vector array<float>, length int, caps array<int>"), "caps")
    rows = capped.select("id", F.explode("caps").alias("cap"), "length")
    sizes = rows.groupBy("length", "cap").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    units = (capped.withColumn("cap", F.explode("caps")).join(sizes, ["length", "cap"])
             .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("id", "size", "vector", "caps", "cap", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"), (F.col("own") == F.least("own", "other")).alias("is_low"), "length"))
    out_schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def compared(key, table):  # a unit: at most about 2 * most vectors
        cap, low, high = (key[k].as_py() for k in (1, 2, 3))
        ids, size = np.asarray(table["id"]), np.asarray(table["size"])
        v = _vectors(table["vector"].combine_chunks())
        v = v / np.abs(v).max(1, keepdims=True)
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        part = np.asarray(table["is_low"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        near = v @ v.T >= similarity
        np.fill_diagonal(near, False)
        if low != high:  # two blocks: pairs within one belong to that block's own unit
            near &= part[:, None] != part[None, :]
        a, b = np.nonzero(near)
        if not a.size:
            return out_schema.empty_table()
        # Earlier caps of the pair: where there is one, the pair is counted there.
        caps = table["caps"].combine_chunks()
        owner = np.repeat(np.arange(len(ids)), np.diff(np.asarray(caps.offsets)))
        number = np.asarray(caps.flatten())
        earlier = number < cap
        names, index = np.unique(number[earlier], return_inverse=True)
        has = np.zeros((len(ids), len(names)), np.float32)
        has[owner[earlier], index] = 1
        count = (near & ~(has @ has.T > 0)) @ size
        label = common.labels_by_minimum(len(ids), a, b)
        told = (count > 0) | (label != np.arange(len(ids)))
        return pa.Table.from_batches([common.record_batch(out_schema, [ids[told], ids[label[told]], count[told]])])

    return units.groupBy("length", "cap", "low", "high").applyInArrow(compared, "a long, b long, n long")


def near_vectors(vectors: DataFrame, similarity: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding",
                 **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row.

    Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing. Equal vectors link; ``n_links`` counts rows. Null ids stay and may not be
    the component's name unless it has no other. Labels are not looked at. Repeated rows
    are equal vectors; an empty table gives no rows.
    """
    value = F.col(vector).cast("array<float>")
    # A component beyond single precision would not survive the cast; such tables keep doubles apart.
    valid = (F.size(value) > 0) & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(value, lambda x: x != 0)
    rows = common.stored(vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(F.coalesce(valid, F.lit(False)), value).alias("vector")), "vectors")
    key = F.xxhash64("vector")
    classes = common.stored(rows.where("vector is not null").groupBy("vector").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("size"))
        .select(F.monotonically_increasing_id().alias("id"), "low", "size", "vector",
                F.size("vector").alias("length")), "classes")
    links = common.stored(linked(classes.select("id", "size", "vector", "length"), similarity, **options), "links")
    parts = common.connected_components(links.select("a", "b"))
    counts = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    named = classes.join(parts.withColumnRenamed("node", "id"), "id", "left").join(counts, "id", "left").select(
        "vector", "low", F.coalesce("component", "id").alias("component"),
        (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select(key.alias("key"), "vector", "n_links", "component_id")
    joined = rows.withColumn("key", F.when(F.col("vector").isNotNull(), key)).alias("r").join(
        named.alias("c"), (F.col("r.key") == F.col("c.key")) & (F.col("r.vector") == F.col("c.vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(common.read(spark, sf_dir, "embeddings"))
