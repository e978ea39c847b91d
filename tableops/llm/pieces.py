"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, checked against the library.

Encoding keeps, for every text, an agenda of its adjacent symbol pairs ordered by the score of the piece they would
merge into (leftmost first among equal scores), pops the best pair, merges it and puts the pairs that the new
symbol forms with its neighbours on the agenda, until no pair is left. Symbols that no piece covers fall back to
byte pieces.

Two facts make that fast in numpy without changing any result. No merge crosses a pair of characters that occurs
side by side in no piece, so a text falls apart at such pairs into chunks (mostly words) with agendas of their
own; and equal chunks have equal pieces. So the distinct chunks of a block of texts are merged side by side, one
pop of every agenda per step; chunks too long for that get a heap. The ids and the decoded text of every document
are compared with the library's inside the same Arrow batch, and a difference fails the job.

A null or empty text has the end id only and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Texts are encoded in blocks of about this many characters; a longer text is a block of its own.
BLOCK_CHARS = 3 << 20
#: Chunks up to this many symbols are merged side by side; longer ones by a heap.
SIDE_BY_SIDE = 48

_NONE = np.iinfo(np.int32).max
_PAD = -1
_SPACE = "▁"


class _PairTable:
    """(left, right) -> merged symbol, an open-addressing hash table probed for whole arrays at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(12, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, _PAD, np.int32)
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        left = np.arange(len(keys))
        merged = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] == -1
            _, first = np.unique(np.where(free, slot[left], -1 - left), return_index=True)
            put = left[first[free[first]]]
            self.keys[slot[put]] = keys[put]
            self.merged[slot[put]] = merged[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.merged[slot], _PAD)
        more = np.flatnonzero((there != keys) & (there != -1) & (keys != -2))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[more]]
            hit = there == keys[more]
            out[more[hit]] = self.merged[slot[more[hit]]]
            more = more[~hit & (there != -1)]
        return out


class Vocabulary:
    """Pieces, scores and merge pairs of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.symbols = {pieces[i]: i for i in plain}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.end = sp.eos_id()
        chars = sorted({c for i in plain for c in pieces[i]} - set(self.symbols))
        self.symbols |= {c: size + k for k, c in enumerate(chars)}  # characters of pieces that are none themselves
        self.n_pieces = size

        # the lower, the earlier; equal scores share a rank
        scores = np.array([sp.get_score(i) for i in range(size)])
        rank = np.searchsorted(np.unique(-scores[plain]), -scores).astype(np.int32)
        self.rank = np.append(rank, np.int32(_NONE))  # [-1]: no merge

        pairs, beside = {}, set()
        for i in plain:
            p = pieces[i]
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = i
                beside.add((p[k - 1], p[k]))
        self.pairs, self.pair_table = pairs, _PairTable(pairs)

        self.char_symbol = np.full(0x110000, _PAD, np.int32)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = i
        joined = sorted({c for ab in beside for c in ab})
        self.char_joins = np.zeros(0x110000, np.int16)
        for k, c in enumerate(joined, 1):
            self.char_joins[ord(c)] = k
        self.beside = np.zeros((len(joined) + 1, len(joined) + 1), bool)
        for a, b in beside:
            self.beside[self.char_joins[ord(a)], self.char_joins[ord(b)]] = True
        for table in (self.char_symbol, self.char_joins):
            table[ord(" ")] = table[ord(_SPACE)]

        #: Bytes that a piece decodes to, and its id in decimals
        self.piece_bytes = [p.replace(_SPACE, " ").encode() for p in pieces]
        for i in range(size):
            if sp.is_control(i):
                self.piece_bytes[i] = b""
        for b, i in enumerate(self.byte_ids.tolist()):
            self.piece_bytes[i] = bytes([b])
        self.decimals = [str(i).encode() for i in range(size)]

    # -- encoding ---------------------------------------------------------------------------------------------

    def _ids(self, symbol: int, code: int) -> list[int]:
        """Ids of a symbol that cannot be merged further."""
        if 0 <= symbol < self.n_pieces:
            return [symbol]
        return self.byte_ids[list(chr(code).encode())].tolist()

    def merge_by_heap(self, symbols: list[int], codes: list[int]) -> list[int]:
        """One agenda as a heap of (rank, position); entries whose symbols have changed since are skipped."""
        n = len(symbols)
        s, before, after = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (m := self.pairs.get((s[i], s[j]))) is not None:
                heapq.heappush(heap, (int(self.rank[m]), i, s[i], s[j], m))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = -1 if gone[i] else after[i]
            if j < 0 or s[i] != a or s[j] != b:
                continue
            s[i], gone[j], after[i] = m, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for i in range(n) if not gone[i] for x in self._ids(s[i], codes[i])]

    def merge_side_by_side(self, s: np.ndarray) -> np.ndarray:
        """Rows of symbols padded with -1 (unknown characters: below -1), each merged to its end."""
        out = np.full_like(s, _PAD)
        where = np.arange(len(s))
        merged = self.pair_table.find(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(len(s), -1)
        rank = self.rank[merged]
        columns = np.arange(s.shape[1])
        while len(s):
            j = rank.argmin(axis=1)
            rows = np.arange(len(s))
            go = rank[rows, j] != _NONE
            if not go.all():
                out[where[~go], : s.shape[1]] = s[~go]
                s, merged, rank, where, j = s[go], merged[go], rank[go], where[go], j[go]
                rows = rows[: len(s)]
                if not len(s):
                    break
            width = s.shape[1]
            made = merged[rows, j]
            take = np.minimum(columns[:width] + (columns[:width] > j[:, None]), width - 1)
            s = np.take_along_axis(s, take, 1)
            s[:, -1] = _PAD
            s[rows, j] = made
            pull = np.minimum(columns[: width - 1] + (columns[: width - 1] >= j[:, None]), width - 2)
            merged = np.take_along_axis(merged, pull, 1)
            merged[:, -1] = _PAD
            right = np.flatnonzero(j < width - 1)
            merged[right, j[right]] = self.pair_table.find(made[right], s[right, j[right] + 1])
            left = np.flatnonzero(j > 0)
            merged[left, j[left] - 1] = self.pair_table.find(s[left, j[left] - 1], made[left])
            rank = self.rank[merged]
            if width > 2 and (s[:, -2:] == _PAD).all():
                s, merged, rank = s[:, :-1], merged[:, :-1], rank[:, :-1]
        return out

    def _encode_chunks(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks, one after another, and how many each has."""
        symbols = self.char_symbol[codes]
        # an unknown character keeps its code below -1, so that it can be spelled in bytes afterwards
        symbols = np.where((symbols < 0) | (symbols >= self.n_pieces) & ~self._joins(codes), -2 - codes.astype(np.int32), symbols)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (chunk, place in it, id)
        for low, high in ((1, 1), (2, 4), (5, 8), (9, 12), (13, 20), (21, SIDE_BY_SIDE)):
            at = np.flatnonzero((sizes >= low) & (sizes <= high))
            for k in range(0, len(at), 1 << 16):
                own = at[k : k + (1 << 16)]
                place = np.arange(high)
                inside = place < sizes[own][:, None]
                grid = np.where(inside, symbols[np.minimum(starts[own][:, None] + place, len(symbols) - 1)], _PAD)
                done = self.merge_side_by_side(grid) if high > 1 else grid
                row, column = np.nonzero(done != _PAD)
                ids = done[row, column]
                if (odd := (ids < 0) | (ids >= self.n_pieces)).any():
                    row, column, ids = self._spell(row, column, ids, odd)
                parts.append((own[row], column, ids))
        for u in np.flatnonzero(sizes > SIDE_BY_SIDE):
            here = slice(int(starts[u]), int(starts[u] + sizes[u]))
            ids = np.array(self.merge_by_heap(symbols[here].tolist(), codes[here].tolist()), np.int32)
            parts.append((np.full(len(ids), u), np.arange(len(ids)), ids))
        chunk = np.concatenate([p[0] for p in parts])
        order = np.argsort(chunk, kind="stable")  # places within a chunk are in order already
        return np.concatenate([p[2] for p in parts])[order], np.bincount(chunk, minlength=len(starts))

    def _joins(self, codes: np.ndarray) -> np.ndarray:
        return self.char_joins[codes] > 0

    def _spell(self, row, column, ids, odd):
        """Replace symbols without a piece by the ids of their bytes."""
        lengths = np.ones(len(ids), np.int64)
        spelled = {}
        for k in np.flatnonzero(odd):
            s = int(ids[k])
            code = -2 - s if s < 0 else ord(self._extra(s))
            spelled[k] = self.byte_ids[list(chr(code).encode())]
            lengths[k] = len(spelled[k])
        out = np.repeat(ids, lengths)
        ends = np.cumsum(lengths)
        for k, b in spelled.items():
            out[ends[k] - lengths[k] : ends[k]] = b
        return np.repeat(row, lengths), np.repeat(column, lengths), out

    def _extra(self, symbol: int) -> str:
        return next(c for c, i in self.symbols.items() if i == symbol)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids per text, without an end id."""
        full = [" " + t for t in texts if t]
        if not full:
            return [np.zeros(0, np.int32)] * len(texts)
        codes = np.frombuffer("".join(full).encode("utf-32-le"), np.uint32)
        text_ends = np.cumsum([len(t) for t in full])
        joins = self.char_joins[codes]
        edge = np.ones(len(codes), bool)
        edge[1:] = ~self.beside[joins[:-1], joins[1:]]
        edge[text_ends[:-1]] = True
        starts = np.flatnonzero(edge)
        sizes = np.diff(np.append(starts, len(codes)))
        unique, first, which = np.unique(_chunk_hashes(codes, starts, sizes), return_index=True, return_inverse=True)
        ids, counts = self._encode_chunks(codes, starts[first], sizes[first])
        # the ids of all chunks in order of the text
        begin = np.cumsum(counts) - counts
        lengths = counts[which]
        ends = np.cumsum(lengths)
        flat = ids[np.arange(ends[-1]) + np.repeat(begin[which] - (ends - lengths), lengths)]
        cut = ends[np.searchsorted(starts, text_ends) - 1]
        found = iter(np.split(flat, cut[:-1]))
        return [next(found) if t else np.zeros(0, np.int32) for t in texts]

    # -- decoding ---------------------------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """Pieces put together; the space in front that encoding adds goes, broken bytes become U+FFFD."""
        raw = b"".join(map(self.piece_bytes.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_POWERS = np.ones(1, np.uint64)


def _chunk_hashes(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 bits per chunk: a polynomial of its characters, mixed with its size."""
    global _POWERS
    if len(_POWERS) < (most := int(sizes.max())):
        _POWERS = np.cumprod(np.append(np.uint64(1), np.full(2 * most, 0xD6E8FEB86659FD93, np.uint64)))
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    h = np.add.reduceat(mixed * _POWERS[place], starts) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xC4CEB9FE1A85EC53)


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """Loaded once in a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[slice]:
    begin = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(t)
    yield slice(begin, len(texts))


def _checked(v: Vocabulary, text: str, ids: list[int], decoded: str) -> None:
    """Fails unless the library gives the same ids and the same decoded text."""
    if v.library.encode(text, add_eos=True) != ids or v.library.decode(ids) != decoded:
        raise ValueError(f"ids or decoded text differ from the library's: {text[:200]!r}")


def _digests(path: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, ids_sha, text_sha = [], [], []
            for part in blocks(texts):
                block = texts[part]
                for k, ids in enumerate(v.encode(block)):
                    own = [*ids.tolist(), v.end]
                    decoded = v.decode(own)
                    if check:
                        _checked(v, block[k], own, decoded)
                    counts.append(len(own))
                    ids_sha.append(hashlib.sha256(b" ".join(map(v.decimals.__getitem__, own))).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _tokens(path: str, text: str, out: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            others = [c for c in batch.schema.names if c != text]
            for part in blocks(texts):
                ids = [np.append(x, np.int32(v.end)) for x in v.encode(texts[part])]
                for t, own in zip(texts[part], ids if check else ()):
                    _checked(v, t, own.tolist(), v.decode(own.tolist()))
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in others], pa.ListArray.from_arrays(pa.array(offsets), values)], [*others, out]
                )

    return run


def encode_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` per row; ``model`` is a path every machine has."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(_digests(model, check), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def encode(docs: DataFrame, model: str, text_col: str = "text", out: str = "ids", check: bool = True) -> DataFrame:
    """``docs`` with the ids of the text, end id included, as a column ``out`` (replacing one of that name)."""
    text = fresh(docs.columns, "_text")
    rows = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    if out in docs.columns:
        rows, docs = rows.drop(out), docs.drop(out)
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + f", `{out}` array<int>"
    return rows.mapInArrow(_tokens(model, text, out, check), schema)
