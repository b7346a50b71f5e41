"""Packing (10): fixed-length training sequences with balanced attention cost.

Documents become token ids plus an end id. The cost of a piece is estimated as a linear
plus a quadratic part of its length (attention stays within a document). In groups of
bounded size, pieces go in descending order to the sequence of lowest cost that has
room. A group's capacity equals its tokens: whole sequences, then powers of two for the
rest, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import byte_bpe, common

#: Entries of a worker's cache of pretokens; beyond it it starts anew.
CACHE = 600_000


class PretokenIds(dict):
    """Pretoken to its ids by the library, as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = byte_bpe.tokenizer(path)

    def __missing__(self, pretoken: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = self.tokenizer.encode(pretoken, add_special_tokens=False).ids
        packed = self[pretoken] = np.asarray(ids, "<u4").tobytes()
        return packed


@lru_cache(maxsize=2)
def pretoken_ids(path: str) -> PretokenIds:
    return PretokenIds(path)


def encode(text: str, path: str) -> bytes:
    """The ids of a text as the library gives them; pretokens are encoded independently."""
    return b"".join(map(pretoken_ids(path).__getitem__, byte_bpe.parts(text, path)))


class CheapestWithRoom:
    """Sequences by free room, the cheapest of each in front; ties: the lower sequence.

    A binary tree over the rooms 1 to ``capacity`` holds at each node the least cost below
    it, so the cheapest sequence with a given room takes one walk, whatever their number.
    """

    NONE = (float("inf"), -1)

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity)]
        self.least = [self.NONE] * (2 * capacity)

    def add(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self.heaps[room - 1], (cost, sequence))
        self._renew(room)

    def take(self, room: int) -> tuple[float, int, int] | None:
        """(cost, sequence, its room) of the cheapest with ``room`` at least, which leaves."""
        best, low, high = self.NONE, room - 1 + self.capacity, 2 * self.capacity
        where = 0
        while low < high:
            if low & 1:
                if self.least[low] < best:
                    best, where = self.least[low], low
                low += 1
            if high & 1:
                high -= 1
                if self.least[high] < best:
                    best, where = self.least[high], high
            low, high = low >> 1, high >> 1
        if not where:
            return None
        while where < self.capacity:
            where = 2 * where + (self.least[2 * where + 1] == best)
        found = where - self.capacity + 1
        heapq.heappop(self.heaps[found - 1])
        self._renew(found)
        return *best, found

    def _renew(self, room: int) -> None:
        heap, node = self.heaps[room - 1], room - 1 + self.capacity
        self.least[node] = heap[0] if heap else self.NONE
        while node > 1:
            node >>= 1
            self.least[node] = min(self.least[2 * node], self.least[2 * node + 1])


def pack(lengths: list[int], capacity: int = 1024, linear: float = 1.0,
         quadratic: float = 1 / 4608) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths.

    ``capacity`` is a power of two. Stretches of a whole sequence fill one each. What is
    left of each document goes, longest first, to the cheapest of all sequences with room
    for it; if none has, the cheapest is filled up and the rest goes on. The default costs
    fit a model of width 768 (6 times the width equals the length at which both parts
    weigh the same). Ties: lower document, lower sequence.
    """
    cost = lambda n: linear * n + quadratic * n * n
    pieces, rest, n_sequences = [], [], 0
    for doc, length in enumerate(lengths):
        whole = length // capacity
        for k in range(whole):
            pieces.append((doc, k * capacity, capacity, n_sequences, 0))
            n_sequences += 1
        if length % capacity:
            rest.append((-(length % capacity), doc, whole * capacity))
    total = -sum(r[0] for r in rest)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << b for b in reversed(range(capacity.bit_length())) if (total % capacity) >> b & 1]
    free = CheapestWithRoom(capacity)
    for s, size in enumerate(sizes):
        # A short sequence costs what a whole one would that has no more room than it.
        free.add(size, cost(capacity - size), s)
    rest.sort()
    for negative, doc, start in rest:
        left = -negative
        while left:
            spent, s, room = free.take(left) or free.take(1)
            n = min(left, room)
            pieces.append((doc, start, n, n_sequences + s, sizes[s] - room))
            start, left = start + n, left - n
            if n < room:
                free.add(room - n, spent + cost(n), s)
    return pieces


FIELDS = [("doc_id", "long", pa.int64()), ("start", "long", pa.int64()), ("length", "long", pa.int64()),
          ("ids_crc32", "long", pa.int64()), ("doc_tokens", "long", pa.int64()),
          ("sequence_id", "long", pa.int64()), ("offset", "long", pa.int64()), ("ids", "binary", pa.binary())]


def packed(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = 1024, end_id: int = 0,
           group_tokens: int = 4_000_000, with_ids: bool = True, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per piece; ``ids`` (with ``with_ids``) holds its little-endian 32-bit ids.

    A null text is empty and consists of the end id. Repeated rows are packed each, a
    null id stays null, an empty table gives no rows, other columns are not looked at.
    Each task packs its rows in groups of about ``group_tokens`` tokens, so no shuffle
    takes place and memory is bounded by a group and one document. Sequence ids are
    unique: the task's partition, then a running number; a repeated task repeats them.
    """
    fields = FIELDS if with_ids else FIELDS[:-1]
    schema = pa.schema([(name, kind) for name, _, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, end = public_tokenizers.path(vocabulary), np.asarray([end_id], "<u4").tobytes()
        next_id = TaskContext.get().partitionId() << 40

        def flush(group: list[tuple[int | None, bytes]], next_id: int) -> tuple[list[pa.RecordBatch], int]:
            lengths = [len(ids) // 4 for _, ids in group]
            pieces = pack(lengths, capacity)
            out = []
            for at in range(0, len(pieces), 10_000):
                some = pieces[at:at + 10_000]
                cut = [group[d][1][4 * s:4 * (s + n)] for d, s, n, _, _ in some]
                columns = [[group[p[0]][0] for p in some], [p[1] for p in some], [p[2] for p in some],
                           list(map(zlib.crc32, cut)), [lengths[p[0]] for p in some],
                           [next_id + p[3] for p in some], [p[4] for p in some], cut]
                out.append(common.record_batch(schema, columns[:len(fields)]))
            return out, next_id + 1 + max((p[3] for p in pieces), default=-1)

        group, held = [], 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(value or "", path) + end
                group.append((key, ids))
                held += len(ids) // 4
                if held >= group_tokens:
                    out, next_id = flush(group, next_id)
                    yield from out
                    group, held = [], 0
        yield from flush(group, next_id)[0]

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind, _ in fields))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(common.read(spark, sf_dir, "documents"), with_ids=False)
