"""Helpers that the operators share: written tables, words, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters that are none of space, \t, \n, \v, \f, \r.
SPACE_CLASS = r"\x20\x09-\x0D"

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; an own one only for local sessions without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="plandrift-llm-"))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs no more than the step in progress.
    The folder belongs to the run and may be deleted when its results are written.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text after lower-casing A-Z; bytes methods know ASCII only."""
    return text.lower().split() if text else []


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
                           schema=schema)


def labels_by_minimum(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges (a, b): the smallest node of each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        new = new[label]
        if (new == label).all():
            return label
        label = new


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs to (node, component), component being the smallest node reachable.

    Each round points every node to its smallest neighbour, follows the pointers to
    their ends by doubling, and contracts the graph to those ends. Every tree has two
    nodes at least, so rounds grow with the logarithm of the nodes, and doublings with
    that of the longest chain. Hot nodes are met by aggregates with partial results.
    Each round ends in a written table. Null ends and loops are ignored; no edges give
    no rows.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    named = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("up")), "up")
        while True:
            over = up.select(F.col("node").alias("up"), F.col("up").alias("over"))
            up2 = stored(up.join(over, "up").select("node", F.col("over").alias("up"),
                                                    (F.col("over") != F.col("up")).alias("moved")), "up")
            up = up2.select("node", "up")
            if up2.where("moved").isEmpty():
                break
        if named is None:
            named = up.select("node", F.col("up").alias("component"))
        else:
            step = up.select(F.col("node").alias("component"), F.col("up").alias("higher"))
            named = stored(named.join(step, "component", "left")
                           .select("node", F.coalesce("higher", "component").alias("component")), "named")
        ends = up.select(F.col("node").alias("a"), F.col("up").alias("a2"))
        other = up.select(F.col("node").alias("b"), F.col("up").alias("b2"))
        edges = stored(edges.join(ends, "a").join(other, "b").where("a2 <> b2")
                       .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                       .distinct(), "edges")
    if named is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named


def column_chunks(batches: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[pa.RecordBatch]:
    """Cuts larger batches, so that what a task holds at once has a bound."""
    for batch in batches:
        for start in range(0, batch.num_rows, most_rows):
            yield batch.slice(start, most_rows)
