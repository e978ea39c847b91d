"""Near-dedup by improved consistent weighted sampling over TF-IDF shingles, banded, with exact verification.

A document is the multiset of its shingles of ``SHINGLE`` words; a shingle weighs its count times an inverse
document frequency between 1 and 1 + ``IDF_STRENGTH``. Document frequencies are counted over all documents in a
hashed table of fixed size (2 ** ``IDF_BITS`` bins), the only thing that is broadcast besides one bitmap.

1. One pass counts document frequencies; one takes ``BANDS * ROWS`` consistent weighted samples per document: two
   documents share a sample with probability their weighted Jaccard similarity.
2. Documents with the same words are one class; only classes are compared. Classes that share a band are a bucket.
   Every member is compared with the bucket's smallest one, so a bucket of thousands of copies costs one
   comparison each and no pairs are listed.
3. Where a member turned out not to be similar to the smallest one, it is compared with all members of the bucket
   in blocks, as products of sparse 0/1 matrices. So every pair of classes that shares a band is linked, directly
   or through a verified chain, or has been found not to be similar: nothing is capped.
4. Links of ``SIMILARITY`` or more give components; the smallest id of each stays.

Nulls and ties: a null text is empty; texts without words are never linked; a text of fewer than ``SHINGLE`` words
is one shingle; null ids come last when the one that stays is chosen; of repeated rows one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import fixed_bitmap, in_bitmap, mixed, word_blocks
from .common import Stage, fresh, partitions, text_of
from .graph import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
IDF_BITS, IDF_STRENGTH = 18, 0.5
BITMAP_BITS = 26
#: Blocks for comparing members of a bucket with all members
BLOCK_LEFT, BLOCK_ALL = 256, 1024

_U = np.uint64
_S48 = _U((1 << 48) - 1)
_MIX = np.array([mixed(np.array([k], _U))[0] | _U(1) for k in range(1, 3 + BANDS * ROWS + SHINGLE)], _U)

# Quantiles of Gamma(2, 1), found by bisection of its distribution function 1 - (1 + x) exp(-x)
_Q = (np.arange(1 << 16) + 0.5) / (1 << 16)
_low, _high = np.zeros(1 << 16), np.full(1 << 16, 40.0)
for _ in range(60):
    _mid = (_low + _high) / 2
    _under = 1 - (1 + _mid) * np.exp(-_mid) < _Q
    _low, _high = np.where(_under, _mid, _low), np.where(_under, _high, _mid)
GAMMA, LOG_GAMMA = _low, np.log(_low)


def shingles(words: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle of 48 bits, count), sorted by text and shingle, of at most 2 ** 16 texts."""
    text = np.repeat(np.arange(len(per_text)), per_text)
    n = len(words)
    parts = []
    if n >= SHINGLE:
        s = np.zeros(n - SHINGLE + 1, _U)
        for i in range(SHINGLE):
            s += (words[i : n - SHINGLE + 1 + i] ^ _MIX[i]) * _MIX[SHINGLE - i]
        inside = text[: n - SHINGLE + 1] == text[SHINGLE - 1 :]
        parts.append((text[:-SHINGLE + 1][inside], mixed(s[inside])))
    short = np.flatnonzero((per_text > 0) & (per_text < SHINGLE))
    if len(short):
        begin = np.cumsum(per_text) - per_text
        s = np.array([_fold(words[begin[t] : begin[t] + per_text[t]]) for t in short], _U)
        parts.append((short, mixed(s)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    key = np.sort(np.concatenate([(t.astype(_U) << _U(48)) | (s & _S48) for t, s in parts]))
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(edge, len(key)))
    key = key[edge]
    return (key >> _U(48)).astype(np.int64), key & _S48, count


def _fold(words: np.ndarray) -> np.uint64:
    s = _U(len(words))
    for w in words:
        s = mixed(np.array([s ^ w], _U))[0]
    return s


def classes(words: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's sequence of words."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    out = []
    full = np.flatnonzero(per_text)
    starts = (np.cumsum(per_text) - per_text)[full]
    for seed in (1, 2):
        h = np.zeros(len(per_text), _U)
        if len(full):
            h[full] = np.add.reduceat(mixed(words ^ _MIX[seed]) * (mixed(place.astype(_U)) | _U(1)), starts)
        out.append(mixed(h + per_text.astype(_U)).view(np.int64))
    return out[0], out[1]


def samples(text: np.ndarray, s: np.ndarray, weight: np.ndarray, n_texts: int) -> np.ndarray:
    """Band keys (texts x BANDS) from consistent weighted samples; rows of texts without shingles are 0."""
    out = np.zeros((n_texts, BANDS), _U)
    if not len(s):
        return out
    counts = np.bincount(text, minlength=n_texts)
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    log_weight = np.log(weight)
    low16 = _U(0xFFFF)
    for k in range(BANDS * ROWS):
        h = (s ^ _MIX[SHINGLE + 2 + k]) * _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        h *= _U(0xC4CEB9FE1A85EC53)
        r = GAMMA[h >> _U(48)]
        beta = ((h >> _U(16)) & low16).astype(np.float64) * (1 / 65536)
        t = np.floor(log_weight / r + beta)
        a = LOG_GAMMA[(h >> _U(32)) & low16] - r * (t - beta + 1)
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == np.repeat(least, counts[full]))
        _, first = np.unique(text[hit], return_index=True)
        hit = hit[first]
        sample = mixed(s[hit] + mixed(t[hit].astype(np.int64).view(_U)))
        out[full, k // ROWS] = mixed(out[full, k // ROWS] * _U(0x9E3779B97F4A7C15) + sample + _U(k + 1))
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(1 << IDF_BITS, np.int64)
    n = 0
    for batch in batches:
        n += batch.num_rows
        for _, _, words, per_text in word_blocks(batch.column("text")):
            _, s, _ = shingles(words, per_text)
            df += np.bincount((s & _U((1 << IDF_BITS) - 1)).astype(np.int64), minlength=1 << IDF_BITS)
    bins = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(bins, -1), pa.int64()), pa.array(np.append(df[bins], n), pa.int64())], ["bin", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The hashed table of inverse document frequencies over all rows of ``text``: 2 ** IDF_BITS numbers."""
    counts = docs.select("text").mapInArrow(_frequencies, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    bins, n = counts.column("bin").to_numpy(), counts.column("n").to_numpy()
    total = max(int(n[bins < 0].sum()), 2)
    df = np.ones(1 << IDF_BITS)
    df[bins[bins >= 0]] = n[bins >= 0]
    return (1 + IDF_STRENGTH * np.maximum(np.log(total / df), 0) / np.log(total)).astype(np.float32)


_SIGNED = "id {kind}, k1 long, k2 long, c1 long, c2 long, bands array<long>"


def _signatures(idf: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            for a, b, words, per_text in word_blocks(batch.column("text")):
                text, s, count = shingles(words, per_text)
                weight = count * table[(s & _U((1 << IDF_BITS) - 1)).astype(np.int64)]
                bands = samples(text, s, weight, b - a).view(np.int64)
                c1, c2 = classes(words, per_text)
                empty = per_text == 0
                offsets = np.arange(0, (b - a + 1) * BANDS, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(a, b - a) for c in ("id", "k1", "k2")],
                        pa.array(c1, pa.int64(), mask=empty),
                        pa.array(c2, pa.int64(), mask=empty),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel(), pa.int64())),
                    ],
                    ["id", "k1", "k2", "c1", "c2", "bands"],
                )

    return run


def _vectors(wanted: Broadcast):
    """The shingles (32 bits each, repeated by their counts) of texts whose class is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for _, _, words, per_text in word_blocks(batch.column("text")):
                c1, c2 = classes(words, per_text)
                hit = in_bitmap(bitmap, c1 & ((1 << BITMAP_BITS) - 1)) & (per_text > 0)
                keep = np.zeros(len(per_text), bool)
                for i in np.flatnonzero(hit).tolist():
                    keep[i] = (c := (int(c1[i]), int(c2[i]))) not in seen
                    seen.add(c)
                if not keep.any():
                    continue
                text, s, count = shingles(words[np.repeat(keep, per_text)], per_text[keep])
                values = np.repeat((s & _U(0xFFFFFFFF)).astype(np.uint32), count)
                ends = np.cumsum(np.bincount(np.repeat(text, count), minlength=int(keep.sum())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1[keep]), pa.array(c2[keep]), pa.array([x.tobytes() for x in np.split(values, ends[:-1])], pa.binary())],
                    ["c1", "c2", "v"],
                )

    return run


def _features(raw: bytes) -> np.ndarray:
    """Distinct numbers for the elements of a multiset: shingle and how often it came before."""
    s = np.sort(np.frombuffer(raw, np.uint32)).astype(_U)
    new = np.concatenate(([True], s[1:] != s[:-1]))
    begin = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    return (s << _U(32)) | (np.arange(len(s)) - begin).astype(_U)


def _weights(features: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return idf[((features >> _U(32)) & _U((1 << IDF_BITS) - 1)).astype(np.int64)]


def weighted_jaccard(x: np.ndarray, y: np.ndarray, idf: np.ndarray) -> float:
    """Of two sorted arrays of :func:`_features`."""
    both = float(_weights(np.intersect1d(x, y, True), idf).sum(dtype=np.float64))
    total = float(_weights(x, idf).sum(dtype=np.float64) + _weights(y, idf).sum(dtype=np.float64))
    return both / (total - both)


def _verify(idf: Broadcast, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            ok = [
                weighted_jaccard(_features(x), _features(y), table) >= similarity
                for x, y in zip(batch.column("va").to_pylist(), batch.column("vb").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    return run


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], idf: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Index pairs whose weighted Jaccard similarity reaches ``similarity``, tile by tile."""
    total = [np.array([_weights(x, idf).sum(dtype=np.float64) for x in side]) for side in (left, right)]
    for i in range(0, len(left), 64):
        tile = left[i : i + 64]
        vocabulary = np.unique(np.concatenate(tile))
        rows = _incidence(tile, vocabulary)
        weight = _weights(vocabulary, idf).astype(np.float64)
        for j in range(0, len(right), 64):
            other = right[j : j + 64]
            shared = _incidence(other, vocabulary)
            used = shared.any(axis=0)
            both = (rows[:, used] * weight[used]) @ shared[:, used].T
            union = total[0][i : i + 64, None] + total[1][None, j : j + 64] - both
            for a, b in zip(*np.nonzero(both >= similarity * union)):
                yield i + int(a), j + int(b)


def _incidence(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(vocabulary)), np.float64)
    for k, x in enumerate(sets):
        at = np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)
        out[k, at[vocabulary[at] == x]] = 1
    return out


def _compare_blocks(idf: Broadcast, similarity: float):
    """A spanning forest of the links between the left and all members of each block; rows come sorted by block."""

    def links(group: dict[bool, dict[int, np.ndarray]]) -> list[tuple[int, int]]:
        left, every = group[True], group[False]
        if not left or not every:
            return []
        ids_a, ids_b = list(left), list(every)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        forest = []
        for i, j in similar_pairs(list(left.values()), list(every.values()), idf.value, similarity):
            a, b = root(ids_a[i]), root(ids_b[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                forest.append((ids_a[i], ids_b[j]))
        return forest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, {True: {}, False: {}}
        for batch in batches:
            out: list[tuple[int, int]] = []
            for block, is_left, cid, v in zip(*[batch.column(c).to_pylist() for c in ("block", "is_left", "cid", "v")]):
                if block != current:
                    out += links(group)
                    current, group = block, {True: {}, False: {}}
                group[is_left][cid] = _features(v)
            yield _pairs(out)
        yield _pairs(links(group))

    return run


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, stage: Stage | None = None
) -> DataFrame:
    """One row per row: ``id_col, rid, k1, k2, component_id, group_size, kept``."""
    spark = docs.sparkSession
    stage = stage or Stage(spark, "near-dedup")
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    idf = spark.sparkContext.broadcast(inverse_frequencies(texts))
    keyed = texts.select("id", "text", F.xxhash64(F.lit(1), "id", "text").alias("k1"), F.xxhash64(F.lit(2), "id", "text").alias("k2"))
    signed = keyed.mapInArrow(_signatures(idf), _SIGNED.format(kind=dict(keyed.dtypes)["id"]))
    rows = stage.write(signed.withColumn("rid", F.monotonically_increasing_id()), "rows")

    # classes of texts with the same words; cid is the first row of the class
    reps = rows.where("c1 IS NOT NULL").groupBy("c1", "c2").agg(F.min_by("bands", "rid").alias("bands"), F.min("rid").alias("cid"))
    reps = stage.write(reps, "classes")
    buckets = reps.select("cid", F.posexplode("bands").alias("band", "key"))
    size = buckets.groupBy("band", "key").agg(
        F.min("cid").alias("first"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cid")).alias("members")
    )
    # buckets with the same members are compared once
    size = size.where("n > 1").groupBy("n", "members", "first").agg(F.min(F.struct("band", "key")).alias("x"))
    size = stage.write(size.select("x.band", "x.key", "first", "n"), "buckets")
    member = stage.write(buckets.join(size, ["band", "key"]).select("band", "key", "cid", "first", "n"), "members")
    pairs = stage.write(member.where("cid <> first").select(F.col("cid").alias("a"), F.col("first").alias("b")).distinct(), "pairs")

    # shingles of the classes in pairs, found again in one pass over the texts through a bitmap of fixed size
    used = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    used = stage.write(reps.join(used, "cid", "left_semi").select("c1", "c2", "cid"), "used")
    cell = F.col("c1").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    wanted = spark.sparkContext.broadcast(fixed_bitmap(used, cell, BITMAP_BITS).tobytes())
    found = texts.select("text").mapInArrow(_vectors(wanted), "c1 long, c2 long, v binary")
    vectors = stage.write(found.dropDuplicates(["c1", "c2"]).join(used, ["c1", "c2"]).select("cid", "v"), "vectors")

    half = pairs.join(vectors.select(F.col("cid").alias("a"), F.col("v").alias("va")), "a")
    sided = half.join(vectors.select(F.col("cid").alias("b"), F.col("v").alias("vb")), "b").select("a", "b", "va", "vb")
    judged = stage.write(sided.mapInArrow(_verify(idf, similarity), "a long, b long, ok boolean"), "judged")

    # members unlike the first of their bucket meet all members, in blocks
    first = member.join(judged.select(F.col("a").alias("cid"), F.col("b").alias("first"), "ok"), ["cid", "first"], "left")
    first = stage.write(first.withColumn("unlike", ~F.coalesce("ok", F.lit(True))).drop("ok"), "firsts")
    rest = first.where("unlike").groupBy("band", "key").agg(F.count(F.lit(1)).alias("n_unlike"))
    rest = stage.write(rest, "rest")
    open_ = first.where("n > 2").join(rest, ["band", "key"])
    parts = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    part = lambda n: F.pmod(F.xxhash64("cid"), n)
    n_left, n_all = parts("n_unlike", BLOCK_LEFT), parts("n", BLOCK_ALL)
    lefts = open_.where("unlike").select(
        "band", "key", "cid", F.lit(True).alias("is_left"), part(n_left).alias("i"), F.explode(F.sequence(F.lit(0), n_all - 1)).alias("j")
    )
    every = open_.select(
        "band", "key", "cid", F.lit(False).alias("is_left"), F.explode(F.sequence(F.lit(0), n_left - 1)).alias("i"), part(n_all).alias("j")
    )
    blocks = lefts.withColumn("j", F.col("j").cast("long")).unionByName(every.withColumn("i", F.col("i").cast("long")))
    blocks = blocks.select("cid", "is_left", F.xxhash64("band", "key", "i", "j").alias("block")).join(vectors, "cid")
    blocks = blocks.repartition(partitions(spark), "block").sortWithinPartitions("block")
    more = blocks.mapInArrow(_compare_blocks(idf, similarity), "a long, b long")

    linked = stage.write(judged.where("ok").select("a", "b").unionByName(more), "linked")
    labels = components(linked, Stage(spark, "near-components"))
    stage.drop("members", "firsts", "vectors")

    # back to the rows: the label of a row is the first row of its component
    row_class = rows.select("rid", "id", "k1", "k2", "c1", "c2").join(
        reps.join(labels, reps["cid"] == labels["node"], "left").select(
            "c1", "c2", F.coalesce("label", "cid").alias("label")
        ),
        ["c1", "c2"],
        "left",
    )
    labelled = stage.write(row_class.select("rid", "id", "k1", "k2", F.coalesce("label", "rid").alias("label")), "labelled")
    best = labelled.groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    best = stage.write(best.select("label", F.col("best.id").alias("component_id"), F.col("best.rid").alias("best_rid"), "group_size"), "best")
    return labelled.join(best, "label").select(
        F.col("id").alias(id_col), "rid", "k1", "k2", "component_id", "group_size", (F.col("rid") == F.col("best_rid")).alias("kept")
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, all columns. Rows are found again by two hashes of id and
    text, which are spread evenly."""
    stage = Stage(docs.sparkSession, "near-dedup")
    groups = near_groups(docs, id_col, text_col, similarity, stage)
    k1, k2 = fresh(docs.columns, "_k1"), fresh(docs.columns, "_k2")
    stays = stage.write(groups.where("kept").select(F.col("k1").alias(k1), F.col("k2").alias(k2)), "stays")
    text = text_of(text_col)
    keyed = docs.withColumns({k1: F.xxhash64(F.lit(1), F.col(id_col), text), k2: F.xxhash64(F.lit(2), F.col(id_col), text)})
    return keyed.join(stays, [k1, k2], "left_semi").dropDuplicates([k1, k2]).drop(k1, k2)
