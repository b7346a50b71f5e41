"""Which tokens may follow each other in the output of a merging tokenizer.

A token sequence is the encoding of its text exactly if no merge crosses a border of two
neighbours. Symbols beside a border of ``left`` and ``right`` are the right spine of
left's merge tree and the left spine of right's; a merge of two of them with rank m
happens if neither has been merged into its parent before: m is below the rank of the
left parent and not above that of the right one (of equal merges the left comes first).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

#: Entries of a worker's caches; beyond it they start anew.
CACHE = 500_000
END = -1  # key of a trie node that holds its token


class Merges:
    """``tokens``: id to text or bytes; ``rank(a, b)``: rank of merging two ids, inf if none.

    ``direct``: ids whose pairs are decided by merging, as ranks alone don't.
    """

    def __init__(self, tokens: dict[int, Sequence], rank, base: dict, direct: frozenset[int] = frozenset()):
        self.tokens, self.rank, self.base, self.direct = tokens, rank, base, direct
        self.right: dict[int, tuple[tuple[int, float], ...]] = {}
        self.left: dict[int, tuple[tuple[int, float], ...]] = {}
        splits: dict[int, tuple[int, int, float]] = {}
        ids = {t: k for k, t in tokens.items()}
        self.ids = ids
        self.trie: dict = {}
        for k, token in sorted(tokens.items(), key=lambda x: len(x[1])):
            out, last = self.merged(token)
            if out != [k]:
                continue  # never the encoding of its own text, so never used
            if last is not None:
                splits[k] = last
            node = self.trie
            for c in token:
                node = node.setdefault(c, {})
            node[END] = k
            for spine, side in ((self.right, 1), (self.left, 0)):
                chain, at, parent = [], k, math.inf
                while True:
                    chain.append((at, parent))
                    if at not in splits:
                        break
                    at, parent = splits[at][side], splits[at][2]
                spine[k] = tuple(chain)
        self._known: dict[int, bool] = {}

    def merged(self, text: Sequence) -> tuple[list[int], tuple[int, int, float] | None]:
        """The encoding of a short text, and its last merge (left, right, rank)."""
        out, last = [self.base[c] for c in text], None
        while len(out) > 1:
            rank, k = min((self.rank(a, b), k) for k, (a, b) in enumerate(zip(out, out[1:], strict=False)))
            if rank == math.inf:
                break
            last = (out[k], out[k + 1], rank)
            out[k:k + 2] = [self.ids[self.tokens[out[k]] + self.tokens[out[k + 1]]]]
        return out, last

    def allowed(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``."""
        key = left << 20 | right
        known = self._known.get(key)
        if known is None:
            if len(self._known) >= CACHE:
                self._known.clear()
            if left in self.direct:
                known = self.merged(self.tokens[left] + self.tokens[right])[0] == [left, right]
            else:
                rank, known = self.rank, True
                for x, x_parent in self.right[left]:
                    for y, y_parent in self.left[right]:
                        m = rank(x, y)
                        if m < x_parent and m <= y_parent and m != math.inf:
                            known = False
            self._known[key] = known
        return known
