"""Token counts (3): exact counts at every prefix of a text, by dynamic programming.

A sequence of tokens is the encoding of its text exactly if every adjacent pair is the
encoding of the pair's text. So the encoding of a prefix ends in the one token that the
encoding of what lies before it can be followed by, and counts follow from left to
right: count[i] = count[i - length of the last token] + 1. Pretokens are independent;
the table of each distinct one is kept in a bounded cache. Budgets and truncation are
answered from the tables; no text is encoded a second time.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import byte_bpe, common
from plandrift.llm.merges import CACHE, END, Merges


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies (fixed values):
    printable Latin-1 for itself, the rest from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


#: Pretokens of more code points are long: their tables are not cached by text, and cuts
#: inside them move no border, so counts there are looked up.
LONG = 64


class PrefixTables:
    """Counts of all prefixes of pretokens under the merges of a vocabulary file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        unmap = lambda s: bytes(letters[c] for c in s)
        added = byte_bpe.added_strings(path)[1]
        ids = {unmap(t): k for t, k in model["vocab"].items() if t not in added}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        ranks = {(ids[unmap(a)], ids[unmap(b)]): k for k, (a, b) in enumerate(pairs)}
        self.merges = Merges({k: t for t, k in ids.items()}, lambda a, b: ranks.get((a, b), math.inf),
                             {b: ids[bytes([b])] for b in range(256)})
        self._tables: dict[str, list[int]] = {}
        self._long: dict[str, list[int]] = {}
        self._totals = _Totals(self)

    def table(self, pretoken: str) -> list[int]:
        """table[i]: tokens of the first i code points' bytes."""
        long = len(pretoken) > LONG
        tables = self._long if long else self._tables
        known = tables.get(pretoken)
        if known is None:
            if len(tables) >= (4 if long else CACHE // 16):
                tables.clear()
            known = tables[pretoken] = self._count(pretoken)
        return known

    def _count(self, pretoken: str) -> list[int]:
        text = pretoken.encode()
        n, trie, allowed = len(text), self.merges.trie, self.merges.allowed
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            node, left, next_count = trie, last[start], count[start] + 1
            for end in range(start + 1, n + 1):
                node = node.get(text[end - 1])
                if node is None:
                    break
                token = node.get(END)
                if token is not None and not count[end] and (left < 0 or allowed(left, token)):
                    last[end], count[end] = token, next_count
        if len(text) == len(pretoken):
            return count
        return [0, *(count[e] for e in accumulate(len(c.encode()) for c in pretoken))]

    def of(self, text: str) -> PrefixCounts:
        return PrefixCounts(self, text)


class _Totals(dict):
    """Pretoken to its number of tokens."""

    def __init__(self, tables: PrefixTables):
        super().__init__({t: 1 for t in byte_bpe.added_strings(tables.path)[1]})
        self.tables = tables

    def __missing__(self, pretoken: str) -> int:
        total = self.tables.table(pretoken)[-1]
        if len(pretoken) > LONG:
            return total
        if len(self) >= CACHE:
            self.clear()
            self.update({t: 1 for t in byte_bpe.added_strings(self.tables.path)[1]})
        self[pretoken] = total
        return total


class PrefixCounts:
    """The counts of one text at all its prefixes."""

    def __init__(self, tables: PrefixTables, text: str):
        self.tables, self.text = tables, text
        self.parts = byte_bpe.parts(text, tables.path)
        self.counts = list(map(tables._totals.__getitem__, self.parts))
        self.total = sum(self.counts)
        self._before: list[int] | None = None
        self._starts: list[int] | None = None

    def _index(self) -> None:
        if self._before is None:
            self._before = [0, *accumulate(self.counts)]
            self._starts = [0, *accumulate(map(len, self.parts))]

    def at(self, n_chars: int) -> int:
        """Exact number of tokens of the first ``n_chars`` code points.

        A cut can move borders in the pretoken it meets and the one before; those are
        split again, and their counts read from the tables. Added strings of a text
        may be cut, too; a cut one is ordinary text that joins what lies before it.
        From the second code point of a long pretoken on, which is a run of one class
        of characters (behind a space, maybe), a cut moves no border.
        """
        self._index()
        if n_chars >= len(self.text):
            return self.total
        if n_chars <= 0:
            return 0
        k = bisect_right(self._starts, n_chars - 1) - 1
        inside = n_chars - self._starts[k]
        if len(self.parts[k]) > LONG and inside > 1:
            return self._before[k] + self.tables.table(self.parts[k])[inside]
        first = max(0, k - 1)
        added = byte_bpe.added_strings(self.tables.path)[1]
        if self.parts[k] in added:
            first = max(0, k - 2)
        tail = self.text[self._starts[first]:n_chars]
        return self._before[first] + sum(self.tables.table(p)[-1] if p not in added else 1
                                         for p in byte_bpe.parts(tail, self.tables.path))

    def fit(self, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens."""
        if self.total <= limit:
            return len(self.text)
        if limit <= 0:
            return 0
        self._index()
        # Whole pretokens before the last three are certain in any prefix that goes on.
        k = min(bisect_right(self._before, limit) + 2, len(self.parts))
        n_chars = min(self._starts[k], len(self.text) - 1)
        while n_chars > 0:
            k = bisect_right(self._starts, n_chars - 1) - 1
            inside, before = n_chars - self._starts[k], self._before[k]
            if len(self.parts[k]) > LONG and inside > 1:
                table = self.tables.table(self.parts[k])
                while inside > 1 and before + table[inside] > limit:
                    inside -= 1
                n_chars = self._starts[k] + inside
                if inside > 1:
                    return n_chars
            if self.at(n_chars) <= limit:
                return n_chars
            n_chars -= 1
        return 0


@lru_cache(maxsize=2)
def prefix_tables(path: str) -> PrefixTables:
    return PrefixTables(path)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                    ("over_limit", pa.bool_()), ("fit_chars", pa.int64())])


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 512,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: bytes, tokens, whether over the limit, and the longest prefix within it.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows, a
    null id stays null, other columns are not looked at, an empty table gives no rows.
    No shuffle; a task holds one batch of texts and bounded caches.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = prefix_tables(public_tokenizers.path(vocabulary))
        for batch in batches:
            n_bytes, n_tokens, fits = [], [], []
            for value in batch.column(1).to_pylist():
                counts = tables.of(value or "")
                n_bytes.append(len(counts.text.encode()))
                n_tokens.append(counts.total)
                fits.append(counts.fit(limit))
            yield common.record_batch(SCHEMA, [batch.column(0), n_bytes, n_tokens,
                                               [n > limit for n in n_tokens], fits])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.read(spark, sf_dir, "documents"))
