"""SentencePiece encoding and decoding (2) by a weighted finite-state transducer.

The transducer is a composition: the normaliser (dummy prefix, spaces to the space
symbol), the pieces (a trie with one accepting state per piece, weighted by the negated
score), byte fallback for characters without a piece, and the merge constraint. The
merge constraint weighs a transition from one piece to the next 0 if the two are what
their joint text merges to, and infinity otherwise: a sequence is the encoding of its
text exactly if all its neighbours are. So the tropical-semiring shortest path of the
composition with an input is the library's encoding.

A composition is expanded lazily, and no piece crosses a cut (before a space symbol that
follows another character, around characters that only occur alone), so the lattice of a
text is a chain of lattices whose shortest paths are kept in a bounded cache.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import common
from plandrift.llm.merges import CACHE, END, Merges

SPACE = "▁"  # fixed value: the space symbol
NORMAL, UNKNOWN, BYTE = 1, 2, 6  # fixed values: kinds of pieces in the file format


class PieceTransducer:
    """Compiled from a model file of the merge kind with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only the identity normaliser with escaped spaces is compiled")
        self.dummy_prefix = spec.add_dummy_prefix
        pieces, self.bytes_ids = {}, {}
        self.weights = np.zeros(len(model.pieces))
        self.surface: list[bytes] = []
        for k, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                value = int(piece.piece[1:-1], 16)
                self.bytes_ids[value] = k
                self.surface.append(bytes([value]))
            else:
                self.surface.append(piece.piece.replace(SPACE, " ").encode() if piece.type == NORMAL else b"")
            if piece.type == NORMAL:
                pieces[k] = piece.piece
                self.weights[k] = -piece.score
        if len(self.bytes_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.byte_pieces = np.isin(np.arange(len(model.pieces)), list(self.bytes_ids.values()))
        longer = [p for p in pieces.values() if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("a piece crosses the start of a word")
        inner = set("".join(longer))
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inner)
        single = f"[{alone}]|" if alone else ""
        self.cuts = re.compile(f"{single}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")
        ids = {p: k for k, p in pieces.items()}
        weights = self.weights.tolist()

        def rank(a: int, b: int) -> float:
            joined = ids.get(pieces[a] + pieces[b])
            return math.inf if joined is None else weights[joined]

        # Characters that occur only within pieces get ids beyond those of the model.
        for c in sorted(inner - set(ids)):
            pieces[len(self.weights) + len(pieces)] = c
        # Runs of the space symbol all have one rank, so their pairs are merged directly.
        self.merges = Merges(pieces, rank, {p: k for k, p in pieces.items() if len(p) == 1},
                             frozenset(k for k, p in pieces.items() if not p.strip(SPACE)))
        self.paths = _Paths(self)

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def shortest_path(self, segment: str) -> list[int]:
        """Ids along the least path of the composition with a segment.

        A state is a position. The merge constraint leaves one transition of finite
        weight into each, as each prefix has one encoding; the path is read backwards.
        """
        n, trie, allowed, most = len(segment), self.merges.trie, self.merges.allowed, len(self.weights)
        last, back = [-1] * (n + 1), [-1] * (n + 1)
        fallback: dict[int, list[int]] = {}
        for start in range(n):
            node, left = trie, last[start]
            for end in range(start + 1, n + 1):
                node = node.get(segment[end - 1])
                if node is None:
                    break
                piece = node.get(END)
                if piece is not None and back[end] < 0 and (left < 0 or allowed(left, piece)):
                    last[end], back[end] = piece, start
            if back[start + 1] < 0:
                # No piece for the character: its bytes, to which nothing merges.
                last[start + 1], back[start + 1] = -1, start
                fallback[start + 1] = [self.bytes_ids[b] for b in segment[start].encode()]
            elif last[start + 1] >= most:
                fallback[start + 1] = [self.bytes_ids[b] for b in segment[start].encode()]
        ids: list[int] = []
        at = n
        while at:
            ids[:0] = fallback.get(at) or [last[at]]
            at = back[at]
        return ids

    def weight(self, ids: list[int]) -> float:
        return float(self.weights[ids].sum())

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for segment in self.cuts.findall(self.normalise(text)):
            out += self.shortest_path(segment)
        return out

    def decode(self, ids: list[int]) -> str:
        """The inverse transducer; bytes that are no UTF-8 become U+FFFD."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


class _Paths(dict):
    def __init__(self, transducer: PieceTransducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, segment: str) -> bytes:
        """Ids as little-endian 32-bit bytes."""
        if len(self) >= CACHE:
            self.clear()
        found = self[segment] = np.asarray(self.transducer.shortest_path(segment), "<u4").tobytes()
        return found


@lru_cache(maxsize=2)
def transducer(path: str) -> PieceTransducer:
    return PieceTransducer(path)


FIELDS = [("doc_id", "long", pa.int64()), ("n_pieces", "long", pa.int64()), ("n_byte_pieces", "long", pa.int64()),
          ("path_weight", "double", pa.float64()), ("ids_crc32", "long", pa.int64()),
          ("round_trip", "boolean", pa.bool_()), ("ids", "binary", pa.binary())]


def encoded(docs: DataFrame, model: str = "piece_bpe_32k.model", with_ids: bool = True, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Per row: pieces, byte pieces, weight of the shortest path, CRC-32 of the ids
    (little-endian 32 bits), whether decoding gives the text back, and the ids.

    A null text counts as empty: no pieces. A literal space symbol decodes to a space,
    so such texts do not come back. Repeated rows and null ids stay, an empty table
    gives no rows. No shuffle; a task holds one batch and bounded caches.
    """
    fields = FIELDS if with_ids else FIELDS[:-1]
    schema = pa.schema([(name, kind) for name, _, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(public_tokenizers.path(model))
        for batch in batches:
            columns = [batch.column(0), *[[] for _ in fields[1:]]]
            for value in batch.column(1).to_pylist():
                value = value or ""
                ids = b"".join(map(t.paths.__getitem__, t.cuts.findall(t.normalise(value))))
                numbers = np.frombuffer(ids, "<u4")
                row = [len(numbers), int(t.byte_pieces[numbers].sum()), float(t.weights[numbers].sum()),
                       zlib.crc32(ids), t.decode(numbers.tolist()) == value, ids]
                for column, x in zip(columns[1:], row, strict=False):
                    column.append(x)
            yield common.record_batch(schema, columns)

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in fields))


def decoded(encodings: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(public_tokenizers.path(model))
        for batch in batches:
            yield common.record_batch(schema, [batch.column(0), [
                None if x is None else t.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column(1).to_pylist()]])

    return encodings.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(common.read(spark, sf_dir, "documents"), with_ids=False)
