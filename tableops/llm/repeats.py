"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts anywhere else are removed.

A suffix array over all positions of a large corpus cannot be exchanged, so it is made sparse without losing a
repeat. Every string of ``LENGTH`` bytes has an anchor: the leftmost of its ``GRAM``-byte grams with the smallest
hash. Equal strings have equal anchors at equal places, so repeats are found among occurrences of one anchor. The
context of an occurrence is all strings of ``LENGTH`` bytes whose anchor it is, run together.

1. Occurrences are counted per (anchor, context hash). A context that occurs twice repeats as a whole.
2. For anchors with several different contexts the contexts are brought together. The enhanced suffix array of
   the suffixes that start at the anchor is stack-scanned for its common-prefix interval tree. Each interval's
   members are sorted by what stands to their left and scanned the same way: intervals whose left extensions
   differ, together long enough, are the maximal repeat groups, with all members, not just neighbours.
3. Anchors with more than ``GROUP`` contexts would make one large task. Their strings are compared by 128-bit
   digest instead, in an aggregate that has no large groups.
4. What was found goes back to the occurrences and is removed from the texts.

Only fixed-size bitmaps of anchor hashes are broadcast; a false hit costs work, not correctness. Nulls and ties: a
null text is empty; repeated rows are occurrences of each other, so all their strings repeat; texts shorter than
``LENGTH`` bytes are left whole; matches never cross rows. Bytes are judged on the input, overlaps included.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import BLOCK_BYTES, Powers, bytes_of, fixed_bitmap, in_bitmap, mixed, text_blocks
from .common import Stage, partitions, text_of

LENGTH, GRAM = 200, 32
#: Anchors with more different contexts than this are compared by digest.
GROUP = 2000
#: Each bitmap has 2 ** BITMAP_BITS bits (8 MB); three are broadcast.
BITMAP_BITS = 26

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = Powers(_BASE), Powers(pow(_BASE, -1, 1 << 64))


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Anchor occurrences of texts that stand one after another in ``data``.

    Arrays: position, first and last start of the strings it anchors, hash of the gram, hash of the context.
    """
    window, n = length - gram + 1, len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(_U), none.astype(_U)
    up, down = _UP(n + 1), _DOWN(n + 1)
    sums = np.concatenate((np.zeros(1, _U), np.cumsum((data.astype(_U) + _U(7)) * up[:n])))
    grams = n - gram + 1
    h = mixed((sums[gram:] - sums[:grams]) * down[:grams])
    # the smallest hash of every window, the leftmost one first: running minima from both ends of blocks
    key = (h >> _U(24) << _U(24)) | np.arange(grams, dtype=_U)
    key = np.concatenate((key, np.full(-grams % window, ~_U(0)))).reshape(-1, window)
    ahead = np.minimum.accumulate(key, 1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(behind[:starts], ahead[window - 1 : window - 1 + starts])
    sizes = np.diff(np.concatenate(([0], ends)))
    whole = np.flatnonzero(np.repeat(ends, sizes)[:starts] - np.arange(starts) >= length)
    if not len(whole):
        return none, none, none, none.astype(_U), none.astype(_U)
    at = (least[whole] & _U(0xFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1))))
    first, last, at = whole[edge], whole[np.append(edge[1:], len(whole)) - 1], at[edge]
    spread = (at - first) + (last - first) * length
    context = mixed((sums[last + length] - sums[first]) * down[first] + spread.astype(_U) * _U(0xC2B2AE3D27D4EB4F))
    return at, first, last, h[at], context


def _pieces(ends: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Blocks as (first text, last text, begin, end) in bytes; a very long text is cut into overlapping pieces, so
    that every string of ``length`` bytes lies in exactly one of them as a start."""
    for first, last in text_blocks(ends):
        begin, end = int(ends[first - 1]) if first else 0, int(ends[last - 1])
        if last - first > 1 or end - begin <= 2 * BLOCK_BYTES:
            yield first, last, begin, end
        else:
            for cut in range(begin, end, BLOCK_BYTES):
                yield first, last, cut, min(cut + BLOCK_BYTES + length - 1, end)


def _found(column: pa.Array, length: int, gram: int):
    """Per block: bytes, text index per occurrence, offset of the text, and the arrays of :func:`anchors`."""
    data, ends = bytes_of(column)
    for first, last, begin, end in _pieces(ends, length):
        own_ends = np.minimum(ends[first:last], end) - begin
        at, low, high, h, c = anchors(data[begin:end], own_ends, length, gram)
        text = np.searchsorted(own_ends, at, "right")
        starts = np.concatenate(([0], ends))[first:last] - begin
        yield data[begin:end], first + text, starts[text] if len(at) else at, at, low, high, h, c


def _counts(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(h, c) for *_, h, c in _found(batch.column("text"), length, gram)]
            h = np.concatenate([np.zeros(0, _U), *[x[0] for x in got]])
            c = np.concatenate([np.zeros(0, _U), *[x[1] for x in got]])
            order = np.lexsort((c, h))
            h, c = h[order], c[order]
            edge = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))) if len(h) else order
            n = np.diff(np.append(edge, len(h)))
            for k in range(0, len(edge), 1 << 16):
                e = edge[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[e].view(np.int64)), pa.array(c[e].view(np.int64)), pa.array(n[k : k + (1 << 16)], pa.int64())],
                    ["h", "c", "n"],
                )

    return run


_OCCURRENCE = "k1 long, k2 long, at int, h long, c long, low int, high int, context binary, windows array<binary>, n long"


def _occurrences(bitmaps: Broadcast, length: int, gram: int):
    """Occurrences of repeated anchors, and with ``context`` or ``windows`` the different contexts of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, mixed_contexts, hot = (np.frombuffer(x, np.uint8) for x in bitmaps.value)
        cell_mask = _U((1 << BITMAP_BITS) - 1)
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2"))
            seen: dict[tuple[int, int], list] = {}
            for data, text, start, at, low, high, h, c in _found(batch.column("text"), length, gram):
                cell = h & cell_mask
                keep = in_bitmap(repeated, cell)
                need = np.flatnonzero(keep & in_bitmap(mixed_contexts, cell))
                is_hot = in_bitmap(hot, cell[need])
                for i, over in zip(need.tolist(), is_hot.tolist()):
                    key = (int(h[i]), int(c[i]))
                    if key in seen:
                        seen[key][1] += 1
                    else:
                        context = data[low[i] : high[i] + length].tobytes()
                        seen[key] = [(context, int(at[i] - low[i]), over), 1]
                i = np.flatnonzero(keep)
                yield _batch(
                    k1[text[i]], k2[text[i]], at[i] - start[i], h[i].view(np.int64), c[i].view(np.int64),
                    at[i] - low[i], high[i] + length - at[i], [None] * len(i), [None] * len(i), np.ones(len(i), np.int64),
                )
            rows = []
            for (h_, c_), ((context, left, over), n) in seen.items():
                windows = (
                    [hashlib.blake2b(context[s : s + length], digest_size=16).digest() for s in range(len(context) - length + 1)]
                    if over
                    else None
                )
                rows.append((h_, c_, left, len(context) - left, None if over else context, windows, n))
                if len(rows) == 2048:
                    yield _contexts(rows)
                    rows = []
            yield _contexts(rows)

    return run


def _contexts(rows: list) -> pa.RecordBatch:
    h, c = (np.array([r[k] for r in rows], _U).view(np.int64) for k in (0, 1))
    none = [None] * len(rows)
    return _batch(none, none, none, h, c, [r[2] for r in rows], [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows], [r[6] for r in rows])


def _batch(k1, k2, at, h, c, low, high, context, windows, n) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int64())
    columns = (k1, k2, at, h, c, low, high, context, windows, n)
    names = ("k1", "k2", "at", "h", "c", "low", "high", "context", "windows", "n")
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)


# -- the interval tree of one anchor's contexts ----------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(ordered: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the common-prefix tree over sorted strings, children
    before parents, from one scan with a stack."""
    stack: list[tuple[int, int]] = []  # (common prefix, first)
    for i in range(1, len(ordered) + 1):
        here = common_prefix(ordered[i - 1], ordered[i]) if i < len(ordered) else -1
        first = i - 1
        while stack and stack[-1][0] > here:
            shared, first = stack.pop()
            yield shared, first, i - 1
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, first))


def maximal_repeats(contexts: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes to the left, bytes to the right, members) of the repeat groups of at least ``length`` bytes.

    ``contexts``: different (left reversed, right) pairs around one anchor. A group is maximal: its members do not
    all continue alike, neither to the left nor to the right.
    """
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    inner: list[tuple[int, int]] = []  # maximal intervals done so far, to tell groups that lie within one of them
    for right, first, last in intervals([contexts[i][1] for i in order]):
        need = max(length - right, 0)
        place = {order[k]: k for k in range(first, last + 1)}
        by_left = sorted((i for i in place if len(contexts[i][0]) >= need), key=lambda i: contexts[i][0])
        children = [(a, b) for a, b in inner if a >= first and b <= last]
        for left, a, b in intervals([contexts[i][0] for i in by_left]):
            if left < need:
                continue
            members = by_left[a : b + 1]
            low, high = min(place[i] for i in members), max(place[i] for i in members)
            if not any(x <= low and high <= y for x, y in children):
                yield left, right, members
        inner = [(a, b) for a, b in inner if not (a >= first and b <= last)] + [(first, last)]


def extents(contexts: list[tuple[bytes, bytes]], length: int) -> dict[int, tuple[int, int]]:
    """How far to the left and to the right each context is covered by repeats."""
    found: dict[int, tuple[int, int]] = {}
    if len(contexts) == 2:  # the usual case: the tree is one interval
        left, right = (common_prefix(contexts[0][k], contexts[1][k]) for k in (0, 1))
        return {0: (left, right), 1: (left, right)} if left + right >= length else found
    for left, right, members in maximal_repeats(contexts, length):
        for i in members:
            a, b = found.get(i, (0, 0))
            found[i] = (max(a, left), max(b, right))
    return found


_EXTENT = "h long, c long, left int, right int"


def _tree_scan(length: int):
    """Extents per context from rows sorted by anchor; a group that goes on in the next batch is carried over."""

    def scan(h: int, group: dict[int, tuple[bytes, bytes]], out: list) -> None:
        if len(group) > 1:
            keys = list(group)
            for i, (left, right) in extents(list(group.values()), length).items():
                out.append((h, keys[i], left, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, {}
        for batch in batches:
            out: list = []
            rows = zip(*[batch.column(c).to_pylist() for c in ("h", "c", "low", "context")])
            for h, c, low, context in rows:
                if h != current:
                    scan(current, group, out)
                    current, group = h, {}
                group[c] = (context[:low][::-1], context[low:])
            yield _extent_batch(out)
        out = []
        scan(current, group, out)
        yield _extent_batch(out)

    return run


def _extent_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["h", "c", "left", "right"])


# -- the operator -----------------------------------------------------------------------------------------------


def _outermost(marked: Broadcast):
    """Of each context the first and the last window whose digest is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(marked.value, np.uint8)
        for batch in batches:
            out = []
            for h, c, windows in zip(*[batch.column(x).to_pylist() for x in ("h", "c", "windows")]):
                cells = np.frombuffer(b"".join(windows), ">u4").reshape(len(windows), -1)[:, 0] & ((1 << BITMAP_BITS) - 1)
                hit = np.flatnonzero(in_bitmap(bitmap, cells))
                if len(hit):
                    out += [(h, c, int(i), windows[i]) for i in {hit[0], hit[-1]}]
            columns = list(zip(*out)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["h", "c", "i", "w"])

    return run


def _hot_extents(contexts: DataFrame, stage: Stage, length: int) -> DataFrame:
    """Extents of contexts of hot anchors, from the digests of their strings.

    Digests that occur twice are counted in one aggregate. Only the outermost of them matter for a context: they
    are picked through a bitmap and confirmed by a join of two rows a context. Where the bitmap misled, all strings
    of the context are looked up.
    """
    twice = contexts.select("n", F.explode("windows").alias("w")).groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
    twice = stage.write(twice, "twice")
    cell = F.conv(F.hex(F.substring("w", 1, 4)), 16, 10).cast("long").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    marked = twice.sparkSession.sparkContext.broadcast(fixed_bitmap(twice, cell, BITMAP_BITS).tobytes())
    outer = contexts.select("h", "c", "windows").mapInArrow(_outermost(marked), "h long, c long, i int, w binary")
    outer = stage.write(outer.join(contexts.select("h", "c", "low").distinct(), ["h", "c"]).distinct(), "outermost")
    missed = stage.write(outer.join(twice, "w", "left_anti").select("h", "c").distinct(), "missed")
    sure = outer.join(missed, ["h", "c"], "left_anti").select("h", "c", "low", "i")
    again = contexts.join(missed, ["h", "c"], "left_semi").select("h", "c", "low", F.posexplode("windows").alias("i", "w"))
    found = sure.unionByName(again.join(twice, "w").select("h", "c", "low", "i"))
    return found.groupBy("h", "c").agg(
        F.max(F.col("low") - F.col("i")).alias("left"), (F.lit(length) - F.min(F.col("low") - F.col("i"))).alias("right")
    )


def repeated_spans(docs: DataFrame, stage: Stage, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``k1, k2, begin, end``: covered byte ranges per text; ``docs`` has ``k1, k2, text``."""
    spark = docs.sparkSession
    counted = docs.select("text").mapInArrow(_counts(length, gram), "h long, c long, n long")
    classes = stage.write(counted.groupBy("h", "c").agg(F.sum("n").alias("n")), "classes")
    per_anchor = classes.groupBy("h").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least")
    )
    mask = F.lit((1 << BITMAP_BITS) - 1)
    kinds = stage.write(
        per_anchor.where("n > 1").select(
            F.col("h").bitwiseAND(mask).alias("cell"), ((F.col("contexts") > 1) & (F.col("least") == 1)).alias("mixed"), "contexts"
        ),
        "anchors",
    )
    bitmaps = spark.sparkContext.broadcast(
        [
            fixed_bitmap(df, F.col("cell"), BITMAP_BITS).tobytes()
            for df in (kinds, kinds.where("mixed"), kinds.where(F.col("mixed") & (F.col("contexts") > group)))
        ]
    )
    rows = stage.write(docs.select("k1", "k2", "text").mapInArrow(_occurrences(bitmaps, length, gram), _OCCURRENCE), "occurrences")

    contexts = rows.where("context IS NOT NULL").select("h", "c", "low", "context")
    scanned = contexts.repartition(partitions(spark), "h").sortWithinPartitions("h").mapInArrow(_tree_scan(length), _EXTENT)

    by_digest = _hot_extents(rows.where("windows IS NOT NULL").select("h", "c", "low", "windows", "n"), stage, length)
    whole = F.lit(None).cast("int")
    covered = stage.write(
        classes.where("n > 1").select("h", "c", whole.alias("left"), whole.alias("right")).unionByName(scanned).unionByName(by_digest),
        "extents",
    )
    return (
        rows.where("k1 IS NOT NULL")
        .select("k1", "k2", "at", "h", "c", "low", "high")
        .join(covered, ["h", "c"])
        .select(
            "k1",
            "k2",
            (F.col("at") - F.coalesce("left", "low")).alias("begin"),
            (F.col("at") + F.coalesce("right", "high")).alias("end"),
        )
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the spans of every text: ``id, n_bytes, n_removed, n_spans, kept``."""
    for batch in batches:
        data, ends = bytes_of(batch.column("text"))
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        removed, runs, kept = [], [], []
        for begin, end, spans in zip(begins.tolist(), ends.tolist(), batch.column("spans").to_pylist()):
            parts, at, gone, n = [], 0, 0, 0
            here = data[begin:end].tobytes()
            run_end = -1
            for s in sorted((x["begin"], x["end"]) for x in spans or ()):
                if s[0] > run_end:
                    n += 1
                    parts.append(here[at : s[0]])
                run_end = max(run_end, s[1])
                gone += max(0, s[1] - max(at, s[0]))
                at = max(at, s[1])
            parts.append(here[at:])
            removed.append(gone)
            runs.append(n)
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(ends - begins, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per row: ``id_col, n_bytes, n_removed, n_spans, kept`` (binary, as cuts may split a character)."""
    stage = Stage(docs.sparkSession, "repeats")
    keyed = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id", "text", F.xxhash64(F.lit(1), "id", "text").alias("k1"), F.xxhash64(F.lit(2), "id", "text").alias("k2")
    )
    spans = repeated_spans(keyed, stage, **kw)
    per_text = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    kind = dict(keyed.dtypes)["id"]
    joined = keyed.join(per_text, ["k1", "k2"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(_cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)
