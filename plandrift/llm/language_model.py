"""LM scoring (1): a gated recurrent network with a class-factored output.

Words in the network's vocabulary belong to classes of neighbouring frequencies; the
probability of a word is that of its class times its share in it, both by softmax. All
other words, known or not, form one more class, within which a word's share follows its
count in the whole training text, plus one. So the model is a distribution over all
words, and its counts grow with the corpus.

Weights are learned by truncated backpropagation in numpy: every task goes through its
part of the training documents from common weights, and the results are averaged by
tokens, round after round. Scoring carries the state across windows, so a document's
score is that of all of it, however long it is.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import common

#: The end of a document among the tokens; no word holds a space.
END = b" "
#: Distinct words that a task counts before it hands them on.
COUNTED = 300_000
#: Bytes of text that are split into words at once.
PIECE = 2 << 20
#: Tokens that a task learns from or scores at once, beside those of its last document.
HELD = 500_000
#: Tokens that wait to be scored, so that texts of similar length go together.
WAITING = 1_500_000
#: Tokens whose outputs are scored in one go, such that the arrays stay in a core's cache.
SCORED = 4096
#: Multiplications in one matrix product. Beyond about this size the library behind numpy
#: starts threads, which only wait for each other where tasks use all cores already.
PRODUCT = 200_000
#: The bias of places that no word has: their probability is zero.
PADDING = -1e30


def product(a: np.ndarray, b: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """a @ b in blocks of rows of ``a``; for tall ``a`` and small ``b``."""
    rows = max(1, PRODUCT // max(1, b.shape[-2] * b.shape[-1]))
    if a.shape[-2] <= rows:
        return np.matmul(a, b, out=out)
    out = np.empty((*a.shape[:-1], b.shape[-1]), np.result_type(a, b)) if out is None else out
    for at in range(0, a.shape[-2], rows):
        np.matmul(a[..., at:at + rows, :], b, out=out[..., at:at + rows, :])
    return out


def across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in blocks of columns of ``b``; for small ``a`` and wide ``b``."""
    columns = max(1, PRODUCT // a.size)
    out = np.empty((len(a), b.shape[1]), np.result_type(a, b))
    for at in range(0, b.shape[1], columns):
        np.matmul(a, b[:, at:at + columns], out=out[:, at:at + columns])
    return out


def add_outer(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Adds a.T @ b to ``total`` in blocks of rows of both."""
    rows = max(1, PRODUCT // max(1, a.shape[-1] * b.shape[-1]))
    for at in range(0, a.shape[-2], rows):
        total += np.swapaxes(a[..., at:at + rows, :], -1, -2) @ b[..., at:at + rows, :]


def adagrad(weights: np.ndarray, squares: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    np.clip(gradient, -1, 1, out=gradient)
    step = gradient * gradient
    squares += step
    np.sqrt(squares, out=step)
    step += np.float32(1e-6)
    np.divide(gradient, step, out=step)
    step *= np.float32(rate)
    weights -= step


class Steps:
    """Arrays for some steps of some lanes, made once; a step's rows are units, its columns lanes.

    With ``kept`` all steps keep what the way back needs, else they share it.
    """

    def __init__(self, steps: int, lanes: int, size: int, kept: bool):
        deep, empty = steps if kept else 1, lambda *shape: np.empty(shape, np.float32)
        self.shape, s = (steps, lanes), size
        self.parts = empty(steps, 4 if kept else 3, s, lanes)
        self.x = self.parts[:, :3].reshape(steps, 3 * s, lanes)  # the same memory: needed on the way there, or back
        self.hu, self.n, self.states = empty(deep, 3 * s, lanes), empty(deep, s, lanes), empty(steps + 1, s, lanes)
        self.before, self.some = empty(s, lanes), empty(s, lanes)
        self.views = []
        for t in range(steps):
            x, hu, n = self.x[t], self.hu[t if kept else 0], self.n[t if kept else 0]
            self.views.append((self.states[t], x[:2 * s], x[2 * s:], hu, hu[:2 * s], hu[:s], hu[s:2 * s], hu[2 * s:], n, self.states[t + 1]))
        if kept:
            self.factors, self.dh = empty(steps, 4, s, lanes), empty(steps, s, lanes)
            self.back = [(self.dh[t], self.factors[t], self.parts[t], self.parts[t].reshape(4 * s, lanes)) for t in range(steps)]


class Network:
    """Gated recurrent units; input weights are looked up by word, biases included.

    Inputs: the vocabulary, one id for all other words, one for the start. ``bounds``
    are the borders of the classes in the vocabulary, which is sorted by count.
    """

    def __init__(self, bounds: np.ndarray, size: int = 16, seed: int = 5, flat: np.ndarray | None = None):
        self.bounds, self.size, words = bounds, size, int(bounds[-1])
        self.classes = len(bounds) - 1  # the class of all other words comes after them
        self.other, self.start = words, words + 1
        sizes = np.diff(bounds)
        self.class_of = np.append(np.repeat(np.arange(self.classes), sizes), self.classes).astype(np.int16)
        self.place = np.append(np.arange(words) - np.repeat(bounds[:-1], sizes), 0)
        # Neighbouring classes of similar sizes are computed together, padded to the largest of them.
        self.groups: list[tuple[int, int]] = []
        for k in range(self.classes):
            a = self.groups[-1][0] if self.groups else k
            if a < k and max(sizes[a:k + 1]) <= 1.4 * min(sizes[a:k + 1]):
                self.groups[-1] = (a, k + 1)
            else:
                self.groups.append((k, k + 1))
        self.wide = np.concatenate([np.full(b - a, max(sizes[a:b])) for a, b in self.groups])
        self.first = np.concatenate([[0], np.cumsum(self.wide)])
        self.height, self.at = int(self.first[-1]), np.repeat(self.first[:-1], sizes) + self.place[:-1]
        self.shapes = {"x": (words + 2, 3 * size), "u": (size, 3 * size), "c": (size + 1, self.classes + 1), "w": (words, size + 1)}
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = np.concatenate([rng.normal(0, 0.1, math.prod(s)) for s in self.shapes.values()]).astype(np.float32)
        self.flat = np.array(flat, np.float32)
        for name, part in self.views(self.flat).items():
            setattr(self, name, part)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of an array laid out like the weights."""
        out, at = {}, 0
        for name, shape in self.shapes.items():
            out[name] = flat[at:at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
        return out

    def padded(self, rows: np.ndarray, fill: float) -> np.ndarray:
        """The words' rows by class, each with as many as the largest of its group; rows of no word hold ``fill`` last."""
        out = np.zeros((self.height, rows.shape[1]), np.float32)
        out[:, -1] = fill
        out[self.at] = rows
        return out

    def spans(self, counts: list[int]) -> list[tuple[int, int, int]]:
        """Classes (first, end) of one group each to be computed together, and the most targets of one of them."""
        out, todo = [], self.groups[::-1]
        while todo:
            a, b = todo.pop()
            some = counts[a:b]
            most, n = max(some), sum(some)
            if b - a > 1 and (b - a) * most > 3 * n + 64:  # one class has most of the targets
                todo += [((a + b) // 2, b), (a, (a + b) // 2)]
            elif n:
                out.append((a, b, most))
        return out

    def forward(self, ids: np.ndarray, work: Steps) -> tuple[np.ndarray, list[bool]]:
        """Fills the states after each step from states[0]; (where a state is kept, by step and lane, whether not all are)."""
        s, half = self.size, np.float32(0.5)
        keep = ids != self.start
        some = (~keep.all(1)).tolist()
        keep = keep.astype(np.float32)
        work.x[:len(ids)] = self.x[ids].transpose(0, 2, 1)
        work.x[:len(ids), :2 * s] *= half  # a sigmoid is 0.5 + 0.5 tanh(0.5 x)
        u = np.ascontiguousarray(self.u.T)
        u[:2 * s] *= half
        add, multiply, tanh, spare = np.add, np.multiply, np.tanh, work.some
        for t, (h, x_gates, x_n, hu, gates, r, z, a, n, after) in enumerate(work.views[:len(ids)]):
            if some[t]:
                h = multiply(h, keep[t], out=work.before)  # the state before is still to be scored
            np.matmul(u, h, out=hu)
            add(gates, x_gates, out=gates)
            tanh(gates, out=gates)
            multiply(gates, half, out=gates)
            add(gates, half, out=gates)
            multiply(r, a, out=spare)
            add(spare, x_n, out=spare)
            tanh(spare, out=n)
            np.subtract(h, n, out=spare)
            multiply(spare, z, out=spare)
            add(n, spare, out=after)
        return keep, some

    def backward(self, keep: np.ndarray, some: list[bool], dh_out: np.ndarray, work: Steps) -> tuple[np.ndarray, np.ndarray]:
        """From the gradients by the states those by the inputs (step, unit, lane) and by u; states become those before."""
        s, steps = self.size, len(keep)
        before, n = work.states[:steps], work.n[:steps]
        before *= keep[:, None]
        r, z, a = (work.hu[:steps, k * s:(k + 1) * s] for k in range(3))
        factors, parts, dh = work.factors[:steps], work.parts[:steps], work.dh[:steps]
        by_n = (1 - z) * (1 - n * n)
        np.multiply(by_n, r, out=factors[:, 2])
        np.multiply(factors[:, 2] * a, 1 - r, out=factors[:, 0])
        np.multiply((before - n) * z, 1 - z, out=factors[:, 1])
        factors[:, 3] = z
        u = np.concatenate([self.u, np.eye(s, dtype=np.float32)], 1)
        carried = np.zeros_like(work.some)
        for t in reversed(range(steps)):
            own, factor, part, flat = work.back[t]
            np.add(carried, dh_out[t], out=own)
            np.multiply(factor, own, out=part)
            np.matmul(u, flat, out=carried)
            if some[t]:
                carried *= keep[t]
        dx = parts[:, :3].reshape(steps, 3 * s, -1)
        du = np.matmul(before, dx.transpose(0, 2, 1)).sum(0)
        np.multiply(dh, by_n, out=parts[:, 2])
        return parts[:, :3].reshape(steps, 3 * s, -1), du

    def step(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The states (rows) after one step that continues the texts, or begins them from ``h`` = 0."""
        work = Steps(1, len(ids), self.size, False)
        work.states[0] = h.T
        self.forward(ids[None], work)
        return (work.states[1].T,)

    def output(self, h: np.ndarray, target: np.ndarray, words: np.ndarray | None = None,
               grads: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of the targets (the class only, for other words) after
        the states, rows of ``h``; ``words``: the padded weights. With ``grads`` (of c, and
        of those) also the gradient by the states, a column for each, and those of the
        output weights are added."""
        words = self.padded(self.w, PADDING) if words is None else words
        s, numbers, kind = self.size + 1, np.arange(len(h)), self.class_of[target]
        rows = np.ones((len(h), s), np.float32)
        rows[:, :-1] = h
        e = across(self.c.T, np.ascontiguousarray(rows.T))
        e -= e.max(0)
        at = kind * np.int64(len(h)) + numbers
        out = e.ravel()[at]
        np.exp(e, out=e)
        total = e.sum(0)
        out -= np.log(total)
        dh = None
        if grads is not None:
            e /= total
            e.ravel()[at] -= 1
            add_outer(grads[0], rows, e.T)
            dh = across(self.c, e)
        # Now the words within their classes: targets by class, each class with as many slots as its span's largest.
        order = np.argsort(kind, kind="stable")
        kind = kind[order].astype(np.int64)
        ends = np.searchsorted(kind, np.arange(self.classes + 1))
        n = int(ends[-1])
        if not n:
            return out, dh if dh is None else dh[:-1]
        order, kind, counts = order[:n], kind[:n], (ends[1:] - ends[:-1]).tolist()
        slots, cells, spans, slot, cell = [0] * self.classes, [0] * self.classes, self.spans(counts), 0, 0
        first, wide = self.first.tolist(), self.wide.tolist()
        for a, b, most in spans:
            for k in range(a, b):
                slots[k], cells[k] = slot, cell
                slot, cell = slot + most, cell + most * wide[a]
        rank = numbers[:n] - ends[kind]
        own = np.array(slots)[kind] + rank
        at = np.array(cells)[kind] + rank * self.wide[kind] + self.place[target[order]]
        hs, e, total = np.zeros((slot, s), np.float32), np.empty(cell, np.float32), np.empty(slot, np.float32)
        hs[own] = rows[order]
        parts = []
        for a, b, most in spans:
            those, shape = slice(slots[a], slots[a] + (b - a) * most), (b - a, most)
            parts.append((those, shape, hs[those].reshape(*shape, s), words[first[a]:first[b]].reshape(b - a, wide[a], s),
                          e[cells[a]:cells[a] + (b - a) * most * wide[a]].reshape(*shape, wide[a])))
        # Logits are moved by their maxima only where their exponentials would leave the range of single precision.
        for moved in (False, True):
            for _, _, h3, w, e3 in parts:
                product(h3, w.transpose(0, 2, 1), e3)
                if moved:
                    e3 -= e3.max(2, keepdims=True)
            if not (moved or e.max() < 60):
                continue
            picked = e[at]
            np.exp(e, out=e)
            for those, shape, _, _, e3 in parts:
                e3.sum(2, out=total[those].reshape(shape))
            if total.min() > 1e-30:
                break
        out[order] += picked - np.log(total[own])
        if grads is None:
            return out, None
        # The gradient by the logits is e, with this change, over the total; the smaller factors are divided.
        e[at] -= total[own]
        np.divide(1, total, out=total)
        hs *= total[:, None]
        by_slot, by_row = np.empty_like(hs), np.zeros_like(rows)
        for (a, b, _), (those, shape, h3, w, e3) in zip(spans, parts, strict=True):
            add_outer(grads[1][first[a]:first[b]].reshape(w.shape), e3, h3)
            product(e3, w, by_slot[those].reshape(*shape, s))
        by_slot *= total[:, None]
        by_row[order] = by_slot[own]
        dh += by_row.T
        return out, dh[:-1]

    def lanes(self, docs: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, targets and document numbers (-1: none) by step and lane.

        Documents, longest first, go one after the other into the lane that is shortest;
        lanes are sorted by length, so those in use at any step come first. A document
        much longer than the others leaves fewer lanes, so that the arrays hold no more
        than about three times the tokens; it alone decides the number of steps then.
        """
        sizes = [len(d) for d in docs]
        n = min(most, len(docs), -(-2 * sum(sizes) // max(1, *sizes)))
        heap = [(0, k) for k in range(n)]
        held: list[list[int]] = [[] for _ in range(n)]
        for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
            length, k = heapq.heappop(heap)
            held[k].append(d)
            heapq.heappush(heap, (length + len(docs[d]), k))
        held.sort(key=lambda ds: -sum(len(docs[d]) for d in ds))
        steps = sum(len(docs[d]) for d in held[0])
        inputs = np.full((steps, n), self.start, np.int32)
        targets, owner = np.zeros((steps, n), np.int32), np.full((steps, n), -1, np.int32)
        for k, ds in enumerate(held):
            at = 0
            for d in ds:
                ids = docs[d]
                targets[at:at + len(ids), k] = ids
                inputs[at + 1:at + len(ids), k] = ids[:-1]
                owner[at:at + len(ids), k] = d
                at += len(ids)
        return inputs, targets, owner

    def score(self, docs: list[np.ndarray], most: int = 512, window: int | None = None) -> np.ndarray:
        """Natural log probability of each document's ids, the share within the other words left out."""
        result, words = np.zeros(len(docs)), self.padded(self.w, PADDING)
        some: list[int] = []
        tokens, order = 0, sorted(range(len(docs)), key=lambda d: -len(docs[d]))
        for d in order:
            some.append(d)
            tokens += len(docs[d])
            if tokens >= HELD or d == order[-1]:
                result[some] = self.score_lanes([docs[k] for k in some], words, most, window)
                some, tokens = [], 0
        return result

    def score_lanes(self, docs: list[np.ndarray], words: np.ndarray, most: int, window: int | None) -> np.ndarray:
        result, work = np.zeros(len(docs)), None
        inputs, targets, owner = self.lanes(docs, most)
        window = window or -(-SCORED // inputs.shape[1])
        h = np.zeros((self.size, inputs.shape[1]), np.float32)
        in_use = (owner >= 0).sum(1).tolist()  # the lanes in use come first
        for at in range(0, len(inputs), window):
            part = slice(at, min(at + window, len(inputs))), slice(0, in_use[at])
            steps = part[0].stop - at
            if work is None or work.shape[1] != in_use[at]:
                work = Steps(steps, in_use[at], self.size, False)
            work.states[0] = h[:, :in_use[at]]
            self.forward(inputs[part], work)
            h = work.states[steps]
            whose = owner[part].ravel()
            real, states = whose >= 0, work.states[1:steps + 1].transpose(0, 2, 1).reshape(len(whose), -1)
            target = targets[part].ravel()
            if not real.all():
                states, target, whose = states[real], target[real], whose[real]
            result += np.bincount(whose, self.output(states, target, words)[0], len(docs))
        return result

    def learn(self, docs: list[np.ndarray], squares: np.ndarray, rate: float = 0.05, most: int = 32, window: int = 32) -> int:
        """One pass by truncated backpropagation (Adagrad); returns the tokens learned from."""
        if not docs:
            return 0
        inputs, targets, owner = self.lanes(docs, most)
        s, lanes, work = self.size, inputs.shape[1], None
        scale, squared = np.float32(1 / lanes), self.views(squares)
        words, word_squares = self.padded(self.w, PADDING), self.padded(squared["w"], 1)
        grads = np.zeros_like(self.c), np.zeros_like(words)
        small = np.min_scalar_type(self.start)  # two bytes are sorted by digits
        h = np.zeros((s, lanes), np.float32)
        in_use = (owner >= 0).sum(1).tolist()
        for at in range(0, len(inputs), window):
            part = slice(at, min(at + window, len(inputs))), slice(0, in_use[at])
            steps, n = part[0].stop - at, in_use[at]
            if work is None or work.shape[1] != n:
                work = Steps(steps, n, s, True)
            ids, target = inputs[part], targets[part].ravel()
            work.states[0] = h[:, :n]
            keep, some = self.forward(ids, work)
            h = work.states[steps].copy()
            states, real = work.states[1:steps + 1].transpose(0, 2, 1).reshape(steps * n, s), owner[part].ravel() >= 0
            grads[0][:], grads[1][:] = 0, 0
            if real.all():
                dh = self.output(states, target, words, grads)[1]
            else:
                dh = np.zeros((s, steps * n), np.float32)
                dh[:, real] = self.output(states[real], target[real], words, grads)[1]
            dx, du = self.backward(keep, some, dh.reshape(s, steps, n).transpose(1, 0, 2), work)
            ids = ids.ravel().astype(small)
            order = np.argsort(ids, kind="stable")
            starts = np.flatnonzero(np.diff(ids[order], prepend=self.start + 1))
            touched = ids[order[starts]]
            dx = np.add.reduceat(dx.transpose(0, 2, 1).reshape(steps * n, 3 * s)[order], starts)
            # Rows of other words have no gradient, so nothing of them changes.
            x, x_squares = self.x[touched], squared["x"][touched]
            adagrad(x, x_squares, dx * scale, rate)
            self.x[touched], squared["x"][touched] = x, x_squares
            for weights, own, gradient in ((self.u, squared["u"], du), (self.c, squared["c"], grads[0]),
                                           (words, word_squares, grads[1])):
                gradient *= scale
                adagrad(weights, own, gradient, rate)
        self.w[:], squared["w"][:] = words[self.at], word_squares[self.at]
        return int((owner >= 0).sum())


def unigram(network: Network, counts: np.ndarray, rest: int) -> Network:
    """Biases such that the untrained network starts from the words' frequencies."""
    s, logs = network.size, np.log(counts + 1.0)
    network.w[:, s] = logs
    network.c[s] = np.log([*np.add.reduceat(counts + 1.0, network.bounds[:-1]), float(rest)])
    return network


def class_bounds(counts: list[int], classes: int = 32) -> np.ndarray:
    """Borders of classes of about equal shares of the square roots of the counts."""
    mass = np.cumsum(np.sqrt(np.maximum(counts, 1)))
    cut = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes) + 1
    return np.unique(np.concatenate([[0], cut[cut < len(counts)], [len(counts)]]))


def pieces(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words, number of words of each text) for runs of texts of about PIECE bytes.

    The words are those of ``common.words_of``, one after the other; null has none.
    """
    run = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0)), dtype=np.int64) // PIECE
    ends = [*(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)] if len(texts) else []
    for low, high in zip([0, *ends], ends):
        some = texts.slice(low, high - low).fill_null(b"").view(pa.string())
        some = pc.ascii_trim_whitespace(pc.ascii_lower(some))
        lists = pc.ascii_split_whitespace(some)
        words, numbers = lists.flatten(), np.diff(np.asarray(lists.offsets))
        empty = np.asarray(pc.binary_length(some)) == 0
        if empty.any():  # these come out as one empty word, or as none
            words, numbers = words.filter(pc.greater(pc.binary_length(words), 0)), np.where(empty, 0, numbers)
        yield words.view(pa.binary()), numbers


def with_end(ids: np.ndarray, numbers: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with that of the end after each text's, and where each text begins in them."""
    ends = np.cumsum(numbers + 1, dtype=np.int64) - 1
    out, word = np.full(len(ids) + len(numbers), end, np.int32), np.ones(len(ids) + len(numbers), bool)
    word[ends] = False
    out[word] = ids
    return out, ends - numbers


def token_table(docs: DataFrame) -> DataFrame:
    """(token, c) over the ``text`` column, the end of each document included."""
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, n = [schema.empty_table()], 0

        def merged() -> pa.Table:
            return pa.concat_tables(told).group_by("token", use_threads=False).aggregate([("c", "sum")]).rename_columns(schema.names)

        for batch in batches:
            for words, numbers in pieces(batch.column(0)):
                values, counts = words.value_counts().flatten()
                told += [pa.table([values, counts], schema), pa.table([[END], [len(numbers)]], schema)]
                n += len(values) + 1
                if n >= 2 * COUNTED:
                    told = [merged()]
                    if len(told[0]) >= COUNTED:
                        yield from told[0].to_batches(50_000)
                        told = [schema.empty_table()]
                    n = len(told[0])
        yield from merged().to_batches(50_000)

    return (docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "token binary, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


_held: dict[str, object] = {}


def _once(name: str, make):
    """What a worker makes of a broadcast, kept as long as it is the last one asked for."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def fit(docs: DataFrame, network: Network, index: list[bytes], share: float, rounds: int) -> tuple[np.ndarray, int]:
    """(weights, tokens learned from): a hashed share of the (doc_id, text) rows, a part in each round."""
    bounds, size, tokens_learned = network.bounds, network.size, 0
    spark = docs.sparkSession
    schema = pa.schema([("n", pa.int64()), ("weights", pa.binary())])
    sums = "n long, weights binary"

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, out = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                weights = np.frombuffer(row["weights"], np.float64)
                n, out = n + row["n"], weights.copy() if out is None else out + weights
        if n:
            yield common.record_batch(schema, [[n], [out.tobytes()]])

    for k in range(rounds):
        shared, name = spark.sparkContext.broadcast((bounds, index[:network.other], network.flat)), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            bounds, index, flat = shared.value
            known, end = _once(name, lambda: (pa.array(index, pa.binary()), index.index(END)))
            own = Network(bounds, size, flat=flat)
            squares, learned, held, tokens = np.full_like(own.flat, 1e-2), 0, [], 0
            for batch in batches:
                for words, numbers in pieces(batch.column(0)):
                    ids, starts = with_end(np.asarray(pc.index_in(words, known).fill_null(own.other)), numbers, end)
                    for ids in np.split(ids, starts[1:]):
                        held.append(ids)
                        tokens += len(ids)
                        if tokens >= HELD:
                            learned += own.learn(held, squares)
                            held, tokens = [], 0
            learned += own.learn(held, squares)
            if learned:
                yield common.record_batch(schema, [[learned], [(own.flat.astype(np.float64) * learned).tobytes()]])

        # By id and text: a large group of copies enters with its share, not as a whole or not at all.
        bucket = F.pmod(F.xxhash64(F.lit("share"), F.col("doc_id"), F.col("text")), F.lit(1_000_000)) / 1_000_000
        part = docs.where((bucket >= share * k / rounds) & (bucket < share * (k + 1) / rounds))
        trained = part.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, sums)
        # Two levels, so that no task sums more than the root of the number of tasks.
        groups = max(1, math.isqrt(trained.rdd.getNumPartitions()))
        # A shuffle between them: coalesce() would put both levels into one task.
        parts = trained.repartition(groups, F.spark_partition_id()).mapInArrow(total, sums)
        result = parts.repartition(1).mapInArrow(total, sums).first()
        if result is not None:
            network = Network(bounds, size, flat=np.frombuffer(result["weights"], np.float64) / result["n"])
            tokens_learned += result["n"]
        shared.unpersist()
    return network.flat, tokens_learned


def lm_scores(docs: DataFrame, vocabulary: int = 2048, counted: int = 65_536, share: float = 1.0, rounds: int = 2,
              size: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Training documents are those with crc32 of the id, as text, mod 7 other than 2; rows
    without id are among them. Counts come from all of them, and so do the network's
    weights, each text being learned in one of the ``rounds``; a smaller ``share`` takes
    a hashed part of them for the weights. The ``counted`` most frequent tokens are broadcast with
    their counts, ``vocabulary`` of them known to the network; occurrences of all others
    meet their counts in a join. A null text counts as empty and consists of its end.
    Repeated rows stay; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    training = texts.where(~F.col("held_out"))
    table = common.stored(token_table(training), "tokens")
    sums = table.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = sums["n"] or 0, sums["v"]
    # Only candidates go on to the driver: tokens above an approximate, mergeable quantile.
    rank = max(0.0, 1 - counted / max(1, v_all) - 3e-4)
    likely = table.where(F.col("c") >= table.agg(F.percentile_approx("c", rank, 10_000)).scalar())
    top = [(bytes(r["token"]), r["c"]) for r in likely.orderBy(F.desc("c"), "token").limit(counted).collect()]
    # The end is always in the network's vocabulary, right after the most frequent words.
    known = [t for t, _ in top[:vocabulary] if t != END]
    counts = dict(top)
    if END not in counts:  # beyond the most frequent, or no training text
        row = table.where(F.col("token") == F.lit(END)).first()
        counts[END] = row["c"] if row else 0
    known = sorted([*known, END], key=lambda t: (-counts[t], t))
    index = known + [t for t, _ in top[vocabulary:] if t != END]
    c = np.array([counts[t] for t in index])
    bounds = class_bounds(c[:len(known)].tolist())
    rest = n_all - int(c[:len(known)].sum()) + v_all - int((c[:len(known)] > 0).sum()) + 1
    flat, _ = fit(training, unigram(Network(bounds, size), c[:len(known)], rest), index, share, rounds)
    shared, name = spark.sparkContext.broadcast((bounds, index, c, flat)), uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("logs", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.binary()))])
    log_rest = math.log10(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, index, c, flat = shared.value
        known, end, network = _once(name, lambda: (pa.array(index, pa.binary()), index.index(END), Network(bounds, size, flat=flat)))
        log_c = np.append(np.log10(c + 1.0), 0.0)  # the last is that of tokens not counted here
        seen = np.append(c > 0, False)
        for batch in batches:
            docs, columns, tokens, first, row = [], [], 0, 0, 0
            for words, numbers in pieces(batch.column(2)):
                found = pc.index_in(words, known)
                ids, starts = with_end(np.asarray(found.fill_null(-1)), numbers, end)
                other = (ids < 0) | (ids >= network.other)
                logs = log_c[ids]
                # Their share among the other words; that of the uncounted is added by the join.
                extra = np.add.reduceat(np.where(other, logs - log_rest, 0.0), starts)
                ends = np.cumsum(np.add.reduceat((ids < 0).astype(np.int32), starts), dtype=np.int32)
                rare = pa.ListArray.from_arrays(np.append(np.int32(0), ends), words.filter(found.is_null()))
                columns.append((numbers + 1, np.add.reduceat(seen[ids].astype(np.int64), starts), np.add.reduceat(logs, starts), extra, rare))
                ids[other] = network.other
                docs += np.split(ids, starts[1:])
                tokens, row = tokens + len(ids), row + len(numbers)
                if tokens >= WAITING or row == batch.num_rows:
                    n_tokens, n_known, logs, extra = (np.concatenate(x) for x in list(zip(*columns))[:4])
                    score = network.score(docs) / math.log(10) + extra
                    some, rare = batch.slice(first, len(docs)), pa.concat_arrays([x[4] for x in columns])
                    yield common.record_batch(schema, [some.column(0), some.column(1), n_tokens, n_known, logs, score, rare])
                    docs, columns, tokens, first = [], [], 0, row

    chosen = texts.select("doc_id", "held_out", F.col("text").cast("binary").alias("text"))
    scored = common.stored(chosen.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<binary>")
        .withColumn("row", F.monotonically_increasing_id()), "scored")
    occurrences = scored.select("row", F.explode("rare").alias("token"))
    found = (occurrences.join(table, "token").groupBy("row")
             .agg(F.sum(F.log10(F.col("c") + F.lit(1.0))).alias("more"), F.count("*").alias("found")))
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("rare").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * math.log10(n_all + v_all + 1)).alias("base_score"),
        (F.col("score") + more).alias("score"))


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(common.read(spark, sf_dir, "documents"))
