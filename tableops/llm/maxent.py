"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

A text's tokens are its words and one end token. The ``CLASSES * SLOTS`` most frequent training tokens are dealt to
``CLASSES`` classes; all others form one more, the tail, with the class of the unseen tokens, those without a count, as
a part of fixed share, so that it is likelier where rare tokens are. The
probability of a token is that of its class given the context times that of the token given class and context. The
first factor is a softmax over classes with features for the last word, the last two words together and the word
before the last (a skip feature); the second a softmax over the class's slots with the last word and the skip word,
each with the class. The tail is a tree of hashed classes: the leading bits of a token's hash name its cell, of which
there are at least as many as training tokens, and are cut into levels of at most ``LEVEL_BITS``. On each level a
softmax over the children of a node starts from their exact shares of the counts and has the last word and the skip
word, each with the node, as features. Tokens that meet in a cell have their smoothed share of its counts, so the
probabilities of all tokens add up to 1. Features are hashed into tables that grow with the root of the number of
training tokens.

Training counts the tokens of all training documents exactly. The weights start as the unigram model. Every training
document belongs, by the hash of its id and text, to one of ``ROUNDS`` rounds and to one shard of the round; shards hold
about ``SHARD`` tokens for every table row factor, however the input is split. In a round each shard makes gradient
updates from the common weights, in the order of the hashes and in batches that no split of the input moves. Only the
rows of the tables that a shard touched leave its task; a row's changes are averaged by the number of tokens that had
it as a feature in each shard, so a rare feature keeps what its few shards learned. The scores do not depend on the
partitioning.

Scoring is one pass in numpy batches with the weights, the masses of the cells (four bytes a cell) and the counts of
the ``HEAD`` most frequent tokens broadcast; the counts of the rarer tokens are joined. All that the driver holds or
broadcasts is bounded: the tables stop growing at ``MOST_GROWTH`` (270 MB), the cells at ``2 ** CELL_BITS`` (64 MB);
beyond that number of tokens those of a cell share its probability by their counts.

Nulls and ties: a null text is empty and consists of the end token; a null id counts as the empty string when the
training part is chosen; repeated rows count repeatedly; without training tokens every token has the same
probability. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import Index, mixed, word_blocks
from .common import Stage, partitions, text_of

CLASSES, SLOTS = 32, 32
#: Rows of the hashed feature tables: last word, last two words, skip word; and with the class, last and skip word
#: up to 2 ** 26 training tokens, then these times a power of two; a table of the tail, two features, has TAIL_ROWS
CLASS_ROWS, SLOT_ROWS, TAIL_ROWS = (1 << 13, 1 << 14, 1 << 13), (1 << 13, 1 << 13), 1 << 14
#: The tail's tree has at most 2 ** LEVEL_BITS children a node.
LEVEL_BITS = 5
#: Tokens whose counts are broadcast (16 MB); the counts of the others are joined.
HEAD = 1 << 20
ROUNDS, STEP, TAIL_STEP, BATCH = 2, 0.2, 0.4, 4096
#: Training tokens of a shard, times the factor of the tables
SHARD = 1 << 21
MOST_GROWTH, CELL_BITS = 16, 24
#: Shards are dealt to so many times more tasks, that few meet in one; from MOST_TASKS on a task works through several.
SPREAD, MOST_TASKS = 4, 1 << 14
#: Weights travel in blocks of this many table rows, masses in blocks of this many cells.
ROWS_BLOCK, CELLS_BLOCK = 512, 1 << 14
#: Tokens of a shard are learned in runs of this many, whatever batches they come in.
RUN = 16 * BATCH
#: Tokens scored at once
SCORED = 1 << 13

_U = np.uint64
END = mixed(np.array([0x5EED], _U))[0]
_OTHER = CLASSES
_LN10 = math.log(10)


def _with_ends(words: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, the token before it, the one before that, text index); in front of a text stand end tokens."""
    tokens = np.full(len(words) + len(per_text), END, _U)
    text = np.repeat(np.arange(len(per_text)), per_text + 1)
    last = np.cumsum(per_text + 1) - 1
    inside = np.ones(len(tokens), bool)
    inside[last] = False
    tokens[inside] = words
    before = np.concatenate(([END], tokens[:-1]))
    skip = np.concatenate(([END], before[:-1]))
    first = np.concatenate(([0], last[:-1] + 1)).astype(np.int64)
    second = first[per_text > 0] + 1
    skip[first] = END
    skip[second] = END
    return tokens, before, skip, text


def _features(before: np.ndarray, skip: np.ndarray, grow: int = 1) -> tuple[np.ndarray, ...]:
    """Rows of the class table."""
    a, b, c = (rows * grow for rows in CLASS_ROWS)
    one = mixed(before + _U(11)) & _U(a - 1)
    two = (mixed(before * _U(0x9E3779B97F4A7C15) + skip + _U(12)) & _U(b - 1)) + _U(a)
    gap = (mixed(skip + _U(13)) & _U(c - 1)) + _U(a + b)
    return one.astype(np.int64), two.astype(np.int64), gap.astype(np.int64)


def _slot_features(before: np.ndarray, skip: np.ndarray, kind: np.ndarray, grow: int = 1) -> tuple[np.ndarray, ...]:
    a, b = (rows * grow for rows in SLOT_ROWS)
    spread = kind.astype(_U) * _U(0xC2B2AE3D27D4EB4F)
    return (mixed(before + spread) & _U(a - 1)).astype(np.int64), ((mixed(skip + spread + _U(14)) & _U(b - 1)) + _U(a)).astype(np.int64)


def _tail_features(before: np.ndarray, skip: np.ndarray, node: np.ndarray, grow: int) -> tuple[np.ndarray, ...]:
    last = _U(TAIL_ROWS * grow - 1)
    spread = (node.astype(_U) + _U(1)) * _U(0xC2B2AE3D27D4EB4F)
    return (mixed(before + spread + _U(15)) & last).astype(np.int64), (mixed(skip + spread + _U(16)) & last).astype(np.int64)


def growth(n: int) -> int:
    """The factor of the feature tables for ``n`` training tokens: a power of two that follows the root of ``n``."""
    return min(1 << max(0, math.ceil(math.log2(max(n, 1)) / 2) - 13), MOST_GROWTH)


def tail_bits(v: int) -> int:
    """Bits of the cells for ``v`` training tokens: at least one cell a token, up to ``CELL_BITS``; none when all tokens
    have slots."""
    return min(max(int(v - 1).bit_length(), 1), CELL_BITS) if v > CLASSES * SLOTS else 0


def cells_of(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens >> _U(64 - bits)).astype(np.int64)


class Model:
    """Weights as one flat array of float32: class table, class biases, slot table, slot biases, tables of the tail.

    ``masses``: smoothed counts of the tail's cells, 2 ** bits of them or none; ``grow``: factor of the table rows.
    """

    def __init__(self, words: np.ndarray, flat: np.ndarray, masses: np.ndarray | None = None, grow: int = 1):
        self.words, self.index, self.flat, self.grow = words, Index(words), flat, grow
        self.masses = np.zeros(0, np.float32) if masses is None else masses
        self.bits = len(self.masses).bit_length() - 1 if len(self.masses) else 0
        self.room = [np.empty(0, np.float32)] * 2
        self.parts, at = [], 0
        for shape in self.shapes(self.bits, grow):
            size = math.prod(shape)
            self.parts.append(flat[at : at + size].reshape(shape))
            at += size
        mass = self.masses.sum(dtype=np.float64)
        #: log10 of the shares of the unseen and of the counted tokens among those without slots
        self.unseen, self.counted = (math.log10(0.5 / (mass + 0.5)), math.log10(max(mass, 0.5) / (mass + 0.5))) if self.bits else (0.0, 0.0)
        #: per level of the tail: (bits below it, log shares of each node's children)
        self.levels, below = [], self.bits
        for b in self.level_bits(self.bits):
            below -= b
            sums = self.masses.reshape(-1, 1 << below).sum(1, dtype=np.float64) if below else self.masses
            sums = np.maximum(sums, 1e-20).reshape(-1, 1 << b)
            self.levels.append((below, (np.log(sums) - np.log(sums.sum(1, keepdims=True, dtype=np.float64))).astype(np.float32)))

    @staticmethod
    def level_bits(bits: int) -> list[int]:
        n = -(-bits // LEVEL_BITS)
        return [bits // n + (k < bits % n) for k in range(n)]

    @classmethod
    def shapes(cls, bits: int, grow: int) -> list[tuple[int, ...]]:
        fixed = [(sum(CLASS_ROWS) * grow, CLASSES + 1), (CLASSES + 1,), (sum(SLOT_ROWS) * grow, SLOTS), (CLASSES, SLOTS)]
        return fixed + [(TAIL_ROWS * grow, 1 << b) for b in cls.level_bits(bits)]

    @classmethod
    def start(cls, words: np.ndarray, counts: np.ndarray, other: float, masses: np.ndarray | None = None, grow: int = 1) -> Model:
        """The unigram model: biases are log shares; a slot without a word has none. ``other``: of unseen tokens."""
        bits = 0 if masses is None else max(len(masses).bit_length() - 1, 0)
        flat = np.zeros(sum(math.prod(s) for s in cls.shapes(bits, grow)), np.float32)
        model = cls(words, flat, masses, grow)
        share = np.full((CLASSES, SLOTS), 0.0)
        k = np.arange(len(words))
        share[k % CLASSES, k // CLASSES] = counts + 0.5
        rest = other + model.masses.sum(dtype=np.float64)
        with np.errstate(divide="ignore"):
            model.parts[3][:] = np.maximum(np.log(share) - np.log(np.maximum(share.sum(1, keepdims=True), 1e-9)), -60)
            model.parts[1][:] = np.maximum(np.log(np.append(share.sum(1), rest)), -60)
        model.parts[1][:] -= np.log(np.exp(model.parts[1].astype(np.float64)).sum())
        return model

    def targets(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, slot) of tokens; slot -1 in the class of the others."""
        at = self.index.find(tokens)
        return np.where(at >= 0, at % CLASSES, _OTHER), np.where(at >= 0, at // CLASSES, -1)

    def _space(self, k: int, rows: int, width: int) -> np.ndarray:
        """Room ``k`` for a batch; what was in it before is overwritten."""
        if len(self.room[k]) < rows * width:
            self.room[k] = np.empty(rows * width, np.float32)
        return self.room[k][: rows * width].reshape(rows, width)

    def _sums(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
        """(exp of ``z``, its row sums, what was taken off each row before): nothing unless a sum leaves its range."""
        ones = np.ones(z.shape[1], np.float32)
        e = self._space(1, *z.shape)
        with np.errstate(over="ignore"):
            np.exp(z, out=e)
            s = e @ ones
        if len(s) and s.min() > 1e-30 and s.max() < 1e30:
            return e, s, 0.0
        top = z.max(axis=1)
        np.exp(z - top[:, None], out=e)
        return e, e @ ones, top

    def _logits(self, table: int, features: tuple, start: np.ndarray) -> np.ndarray:
        w = self.parts[table]
        z, more = (self._space(k, len(features[0]), w.shape[1]) for k in (0, 1))
        np.take(w, features[0], axis=0, out=z, mode="clip")  # the rows are in range; "raise" would copy once more
        for f in features[1:]:
            z += np.take(w, f, axis=0, out=more, mode="clip")
        z += start
        return z

    def _chosen(self, table: int, features: tuple, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probabilities of the targets."""
        z = self._logits(table, features, start)
        _, s, top = self._sums(z)
        return z[np.arange(len(z)), target].astype(np.float64) - top - np.log(s)

    def _errors(self, table: int, features: tuple, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Probabilities less one for the target: the gradient of the logits."""
        e, s, _ = self._sums(self._logits(table, features, start))
        e *= (1 / s)[:, None]
        e[np.arange(len(e)), target] -= 1
        return e

    def tail_steps(self, tokens: np.ndarray, before: np.ndarray, skip: np.ndarray) -> Iterator[tuple]:
        """Per level of the tail: (its table, its features, log shares of the node, the child on the way to each token)."""
        cells = cells_of(tokens, self.bits)
        for level, (below, logs) in enumerate(self.levels):
            path = cells >> below
            node, child = path // logs.shape[1], path % logs.shape[1]
            yield 4 + level, _tail_features(before, skip, node, self.grow), np.take(logs, node, axis=0), child

    def log10(self, tokens: np.ndarray, before: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of class and slot probability, whether the token is one without a slot, taken for unseen)."""
        out, _, other = self.chains(tokens, before, skip)
        return out, other

    def chains(self, tokens: np.ndarray, before: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 probability if a token without a slot is unseen, the same if it has a count, up to the smoothed
        count itself, whether it has no slot)."""
        out = np.empty(len(tokens))
        kind, slot = self.targets(tokens)
        seen = np.zeros(len(tokens))
        for k in range(0, len(tokens), SCORED):
            part = slice(k, k + SCORED)
            out[part] = self._chosen(0, _features(before[part], skip[part], self.grow), self.parts[1], kind[part])
            own = np.flatnonzero(slot[part] >= 0) + k
            if len(own):
                features = _slot_features(before[own], skip[own], kind[own], self.grow)
                out[own] += self._chosen(2, features, np.take(self.parts[3], kind[own], axis=0), slot[own])
            rest = np.flatnonzero(slot[part] < 0) + k
            if len(rest) and self.bits:
                log = out[rest] + self.counted * _LN10 - np.log(np.maximum(self.masses[cells_of(tokens[rest], self.bits)], 0.5))
                for table, features, shares, child in self.tail_steps(tokens[rest], before[rest], skip[rest]):
                    log += np.maximum(self._chosen(table, features, shares, child), -69)
                seen[rest] = log / _LN10
                out[rest] += self.unseen * _LN10
        out /= _LN10
        return out, seen, slot < 0

    def learn(
        self, tokens: np.ndarray, before: np.ndarray, skip: np.ndarray, squares: list[np.ndarray], uses: list[np.ndarray] | None = None
    ) -> None:
        """Gradient updates on batches of tokens, with step sizes by each row's squared gradients so far.

        With a tail, every token is one with a count. ``uses`` gains the tokens that had each row as a feature.
        """
        kind, slot = self.targets(tokens)

        def step(table: int, features: tuple, start: np.ndarray, target: np.ndarray) -> None:
            g = self._errors(table, features, start, target)
            for f in features:
                self._update(table, f, g, squares, uses)

        for k in range(0, len(tokens), BATCH):
            part = slice(k, k + BATCH)
            step(0, _features(before[part], skip[part], self.grow), self.parts[1], kind[part])
            own = np.flatnonzero(slot[part] >= 0) + k
            if len(own):
                features = _slot_features(before[own], skip[own], kind[own], self.grow)
                step(2, features, np.take(self.parts[3], kind[own], axis=0), slot[own])
            rest = np.flatnonzero(slot[part] < 0) + k
            if len(rest) and self.bits:
                for table, features, shares, child in self.tail_steps(tokens[rest], before[rest], skip[rest]):
                    step(table, features, shares, child)

    def _update(self, table: int, rows: np.ndarray, g: np.ndarray, squares: list[np.ndarray], uses: list[np.ndarray] | None) -> None:
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        if len(self.parts[table]) > 1 << 16:  # then by the higher bits
            order = order[np.argsort((rows[order] >> 16).astype(np.uint16), kind="stable")]
        ordered = rows[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        sizes = np.diff(np.append(first, len(ordered)))
        total = _group_sums(g, order, first, sizes)
        rows = ordered[first]
        if uses is not None:
            uses[table][rows] += sizes
        square = squares[table][rows] + np.einsum("ij,ij->i", total, total)
        squares[table][rows] = square
        total *= ((STEP if table < 4 else TAIL_STEP) / np.sqrt(square + 1))[:, None]
        changed = np.take(self.parts[table], rows, axis=0)
        changed -= total
        _put_rows(self.parts[table], rows, changed)


def _group_sums(g: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``g`` by groups of ``order``: most groups have one row, which is only copied."""
    total = np.take(g, order[first], axis=0)
    many = np.flatnonzero(sizes > 1)
    if len(many):
        rest = np.ones(len(order), bool)
        rest[first] = False
        more, ends = np.take(g, order[rest], axis=0), np.cumsum(sizes[many] - 1)
        if more.shape[1] % 2 == 0:  # two columns as one complex number: half as many sums
            more = more.view(np.complex64)
        sums = np.add.reduceat(more, np.append(0, ends[:-1]), axis=0).view(np.float32)
        sums += np.take(total, many, axis=0)
        _put_rows(total, many, sums)
    return total


def _put_rows(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``table[rows] = values`` of contiguous arrays, each row moved as one item: three times as fast."""
    item = np.dtype((np.void, table.itemsize * table.shape[1]))
    np.put(table.view(item).reshape(-1), rows, values.view(item).reshape(-1))


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [_with_ends(words, per_text)[0] for _, _, words, per_text in word_blocks(batch.column("text"))]
        h, n = np.unique(np.concatenate([np.zeros(0, _U), *got]), return_counts=True)
        for k in range(0, len(h), 1 << 16):
            part = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(n[part], pa.int64())], ["h", "c"])


#: Changed rows of one block of a table: their places in the block, their uses, their changes
_CHANGES = "part int, block int, shard long, rows binary, uses binary, w binary"


class _Run:
    """Tokens with their contexts, put together from arrays of any length and given out in runs of ``RUN``."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *arrays: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        self.held.append(arrays)
        self.size += len(arrays[0])
        if self.size >= RUN:
            joined = self.rest()
            whole = len(joined[0]) // RUN * RUN
            for k in range(0, whole, RUN):
                yield tuple(x[k : k + RUN] for x in joined)
            self.held, self.size = [tuple(x[whole:] for x in joined)], len(joined[0]) - whole

    def rest(self) -> tuple[np.ndarray, ...]:
        return tuple(map(np.concatenate, zip(*self.held)))


class _Shard:
    """The updates of one shard, from the common weights."""

    def __init__(self, number: int, words: np.ndarray, flat: np.ndarray, masses: np.ndarray, grow: int):
        self.number, self.start = number, Model(words, flat, masses, grow)
        self.model = Model(words, flat.copy(), masses, grow)
        self.squares = [np.zeros(len(p), np.float32) for p in self.model.parts]
        self.uses = [np.zeros(len(p), np.int32) for p in self.model.parts]
        self.run = _Run()

    def learn(self, column: pa.Array) -> None:
        for _, _, words, per_text in word_blocks(column):
            for run in self.run.add(*_with_ends(words, per_text)[:3]):
                self.model.learn(*run, self.squares, self.uses)

    def changes(self) -> Iterator[pa.RecordBatch]:
        """The change of the touched rows, in half precision."""
        if self.run.size:
            self.model.learn(*self.run.rest(), self.squares, self.uses)
        types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for part, uses in enumerate(self.uses):
            for block in range(0, len(uses), ROWS_BLOCK):
                rows = np.flatnonzero(uses[block : block + ROWS_BLOCK])
                if len(rows):
                    w = (self.model.parts[part][block + rows] - self.start.parts[part][block + rows]).astype(np.float16)
                    values = (part, block, self.number, rows.astype(np.int16).tobytes(), uses[block + rows].tobytes(), w.tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], _names(_CHANGES))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _train(state: Broadcast):
    """The changes of all shards of a partition, whose rows come sorted by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(numbers)]):
                if a == b:
                    continue
                if shard is None or shard.number != numbers[a]:
                    if shard is not None:
                        yield from shard.changes()
                    shard = _Shard(int(numbers[a]), *state.value)
                shard.learn(batch.column("text").slice(a, b - a))
        if shard is not None:
            yield from shard.changes()

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Averages each row's changes over its shards by their uses; blocks come sorted, their shards in order."""
    key, total, uses = None, None, None

    def done() -> pa.RecordBatch:
        rows = np.flatnonzero(uses)
        w = (total[rows] / uses[rows, None]).astype(np.float32)
        values = (*key, rows.astype(np.int16).tobytes(), w.tobytes())
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], _names(_AVERAGES))

    for batch in batches:
        for part, block, rows, n, w in zip(*[batch.column(c).to_pylist() for c in ("part", "block", "rows", "uses", "w")]):
            rows, n = np.frombuffer(rows, np.int16), np.frombuffer(n, np.int32)
            w = np.frombuffer(w, np.float16).reshape(len(rows), -1).astype(np.float64)
            if (part, block) != key:
                if key is not None:
                    yield done()
                key, total, uses = (part, block), np.zeros((ROWS_BLOCK, w.shape[1])), np.zeros(ROWS_BLOCK)
            total[rows] += w * n[:, None]
            uses[rows] += n
    if key is not None:
        yield done()


_AVERAGES = "part int, block int, rows binary, w binary"


def _cell_masses(bits: int):
    """Smoothed counts a cell, by blocks of cells; rows come sorted by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["block", "m"])

        for batch in batches:
            cells = cells_of(batch.column("h").to_numpy().view(_U), bits)
            blocks, counts = cells // CELLS_BLOCK, batch.column("c").to_numpy() + 0.5
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
                if a == b:
                    continue
                if blocks[a] != block:
                    if block is not None:
                        yield done()
                    block, total = int(blocks[a]), np.zeros(CELLS_BLOCK)
                total += np.bincount(cells[a:b] - block * CELLS_BLOCK, counts[a:b], CELLS_BLOCK)
        if block is not None:
            yield done()

    return run


_SCORED = "id {kind}, k long, n_tokens long, n_known long, base double, model double, h long, tf long, seen double, unseen double"


def _score(state: Broadcast, known: float):
    """Per text one row with what the broadcast counts give; for its rarer tokens rows ``k, h, tf, seen, unseen``.

    ``known``: log10 of the counts' total; ``seen``, ``unseen``: the model's part if the token has a count or not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat, masses, grow, head, counts = state.value
        model, index = Model(words, flat, masses, grow), Index(head)
        logs = np.log10(counts + 0.5)
        for batch in batches:
            for a, b, words_, per_text in word_blocks(batch.column("text")):
                tokens, before, skip, text = _with_ends(words_, per_text)
                size = b - a
                at = index.find(tokens)
                in_head = at >= 0
                log_count = np.where(in_head, logs[at] if len(logs) else 0.0, 0.0)
                chain, tail, other = model.chains(tokens, before, skip)
                add = lambda x: np.bincount(text, x, size)  # noqa: B023, E731
                base = add(log_count - known)
                score = add(np.where(in_head, np.where(other, tail + log_count, chain), 0.0))
                own = [batch.column(c).slice(a, size) for c in ("id", "k")]
                yield _scored(
                    own[0], own[1], np.bincount(text, minlength=size), add(in_head).astype(np.int64), base, score,
                    None, None, None, None,
                )
                rare = np.flatnonzero(~in_head)
                pairs, tf, seen, unseen = _distinct_pairs(text[rare], tokens[rare], tail[rare], chain[rare])
                keys = own[1].to_numpy(zero_copy_only=False)[pairs[0]]
                yield _scored(
                    None, pa.array(keys, pa.int64()), None, None, None, None, pairs[1].view(np.int64), tf, seen, unseen, own[0].type
                )

    return run


def _distinct_pairs(text: np.ndarray, tokens: np.ndarray, *sums: np.ndarray) -> tuple:
    """Distinct (text, token), how often each occurs, and ``sums`` added up."""
    order = np.lexsort((tokens, text))
    text, tokens = text[order], tokens[order]
    if not len(text):
        return (text, tokens), np.zeros(0, np.int64), *sums
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (tokens[1:] != tokens[:-1]))))
    added = [np.add.reduceat(x[order], first) for x in sums]
    return (text[first], tokens[first]), np.diff(np.append(first, len(text))), *added


def _scored(id_, k, n_tokens, n_known, base, model, h, tf, seen, unseen, id_type=None) -> pa.RecordBatch:
    n = len(k)
    names = ["id", "k", "n_tokens", "n_known", "base", "model", "h", "tf", "seen", "unseen"]
    types = [id_type, *[pa.int64()] * 3, *[pa.float64()] * 2, *[pa.int64()] * 2, *[pa.float64()] * 2]
    columns = zip((id_, k, n_tokens, n_known, base, model, h, tf, seen, unseen), types)
    arrays = [pa.nulls(n, t) if x is None else x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 1


class LanguageModel:
    """Counts and weights learned from the rows of ``docs`` that are not held out."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", test: Column | None = None):
        spark = docs.sparkSession
        self.id_col, self.text_col = id_col, text_col
        self.test = held_out(F.col(id_col)) if test is None else test
        self.stage = Stage(spark, "maxent")
        training = docs.where(~self.test).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        counted = training.select("text").mapInArrow(_token_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
        self.counts = self.stage.write(counted, "counts")
        self.n, self.v = self.counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.total = self.n + 0.5 * (self.v + 1)

        top = self.counts.orderBy(F.desc("c"), "h").limit(CLASSES * SLOTS).toArrow()
        words, c = top.column("h").to_numpy().view(_U), top.column("c").to_numpy()
        self.word_counts, self.grow, self.masses = c, growth(self.n), self.tail_masses(words, c)
        model = Model.start(words, c, 0.5, self.masses, self.grow)
        shards = max(1, math.ceil(self.n / ROUNDS / (SHARD * self.grow)))
        place = F.xxhash64("id", "text")
        placed = training.select(place.alias("o"), F.pmod(F.shiftrightunsigned(place, 8), F.lit(shards)).alias("shard"), "text")
        for r in range(ROUNDS):
            state = spark.sparkContext.broadcast((words, model.flat, self.masses, self.grow))
            part = placed.where(F.pmod("o", F.lit(ROUNDS)) == r).repartition(min(SPREAD * shards, MOST_TASKS), "shard")
            changes = part.sortWithinPartitions("shard", "o").select("shard", "text").mapInArrow(_train(state), _CHANGES)
            changes = changes.repartition(partitions(spark), "part", "block").sortWithinPartitions("part", "block", "shard")
            for row in changes.mapInArrow(_average, _AVERAGES).collect():  # together the size of the weights
                rows = row["block"] + np.frombuffer(row["rows"], np.int16).astype(np.int64)
                model.parts[row["part"]][rows] += np.frombuffer(row["w"], np.float32).reshape(len(rows), -1)
            state.destroy()
        self.words, self.flat = words, model.flat

    def tail_masses(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Smoothed counts of the tail's cells: those of all tokens in a cell without the ones that have slots."""
        bits = tail_bits(self.v)
        out = np.zeros(1 << bits if bits else 0)
        if bits:
            block = F.floor(F.shiftrightunsigned("h", 64 - bits) / CELLS_BLOCK)
            blocks = self.counts.withColumn("block", block).repartition(partitions(self.counts.sparkSession), "block").sortWithinPartitions("block")
            for row in blocks.select("h", "c").mapInArrow(_cell_masses(bits), "block long, m binary").collect():  # 8 bytes a cell
                at = row["block"] * CELLS_BLOCK
                out[at : at + CELLS_BLOCK] = np.frombuffer(row["m"])[: len(out) - at]
            np.subtract.at(out, cells_of(words, bits), counts + 0.5)
        return out.astype(np.float32)

    def head(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens with slots and the most frequent: all with a count above a bound that leaves at most ``HEAD``."""
        step = F.floor(F.log2(F.col("c").cast("double")) * 8)
        sizes = sorted(self.counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
        bound, n = math.inf, 0
        for s, size in sizes:
            if n + size > HEAD:
                break
            bound, n = s, n + size
        table = self.counts.where(step >= bound).toArrow() if n else self.counts.limit(0).toArrow()
        h, c = table.column("h").to_numpy().view(_U), table.column("c").to_numpy()
        more = ~np.isin(self.words, h)
        return np.append(h, self.words[more]), np.append(c, self.word_counts[more])

    def score(self, docs: DataFrame) -> DataFrame:
        """One row per row: id, ``held_out, n_tokens, n_known, train_tokens, base_score, score``."""
        spark = docs.sparkSession
        head, head_counts = self.head()
        state = spark.sparkContext.broadcast((self.words, self.flat, self.masses, self.grow, head, head_counts))
        rows = docs.select(F.col(self.id_col).alias("id"), F.monotonically_increasing_id().alias("k"), text_of(self.text_col).alias("text"))
        schema = _SCORED.format(kind=dict(rows.dtypes)["id"])
        scored = self.stage.write(rows.mapInArrow(_score(state, math.log10(self.total)), schema), "scored")
        # a token that is not in the head has no slot: it is one of the tail if it has a count, otherwise unseen
        rare = scored.where("h IS NOT NULL").select("k", "h", "tf", "seen", "unseen").join(self.counts, "h", "left")
        rare = rare.groupBy("k").agg(
            F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(F.lit(0))).alias("rare_known"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("seen") + F.col("tf") * F.log10(F.col("c") + 0.5)).otherwise(F.col("unseen"))).alias("rare_model"),
        )
        per_text = scored.where("h IS NULL").drop("h", "tf", "seen", "unseen").join(rare, "k", "left")
        return per_text.select(
            F.col("id").alias(self.id_col),
            held_out(F.col("id")).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(self.n).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
            (F.col("model") + F.coalesce("rare_model", F.lit(0.0))).alias("score"),
        )
