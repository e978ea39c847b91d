"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and word pairs are hashed into ``2 ** BITS`` buckets. The raw model counts them over all documents; the
target model over labelled good documents, smoothed towards the raw one by ``PRIOR`` expected counts a bucket. A
document's log ratio is the sum of its n-grams' log ratios under the two generative models. As the n-grams of a
document are far from independent, the sum overstates what a long document says: its log weight is the mean over
its n-grams (and ``SHORT`` more of ratio 1) times ``LENGTH``, what a document of that many n-grams would have.
The ``k`` documents with the largest log weight plus seeded Gumbel noise are a sample without replacement by
importance. ``k`` is the number of documents whose log weight is above the value that separates good labels from
bad ones best, a good document lost counting ``LOSS`` times one kept wrongly.

At most ``LABELS`` labelled documents are used, those with the smallest hashed ids: every other one for the target
model, the rest to find the separating value. All other counts cover all documents. The threshold of the top k is
found by histograms over the whole key range, refined until exact; documents that tie at it are all taken.

Nulls and ties: a null text is empty and has log weight 0; null ids share one noise value; without good and bad
labels everything stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import mixed, word_blocks
from .common import Stage, fresh, text_of

BITS = 16
LABELS = 10_000
#: Counts added to a bucket's count in the target and to what the raw model expects there
PRIOR = 20.0
SHORT, LENGTH, LOSS = 10, 100, 5
#: Scale of the Gumbel noise, in units of log weight
TEMPERATURE = 0.25
SEED = 5

_U = np.uint64


def buckets(words: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every word and of every pair of neighbouring words; a word that stands next to
    itself is the same pair whatever the word."""
    text = np.repeat(np.arange(len(per_text)), per_text)
    beside = np.flatnonzero(text[1:] == text[:-1]) + 1
    last, here = words[beside - 1], words[beside]
    pair = np.where(last == here, _U(0), here ^ (last * _U(0x9E3779B97F4A7C15)))
    h = np.concatenate((mixed(words), mixed(pair + _U(1))))
    return (h >> _U(64 - BITS)).astype(np.int64), np.concatenate((text, text[beside]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, good = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        is_good = batch.column("good").fill_null(False).to_numpy(zero_copy_only=False)
        for a, b, words, per_text in word_blocks(batch.column("text"), punctuation=True):
            h, text = buckets(words, per_text)
            raw += np.bincount(h, minlength=1 << BITS)
            good += np.bincount(h[is_good[a:b][text]], minlength=1 << BITS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (used, raw[used], good[used])], ["bucket", "raw", "good"])


def label_sample(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``_label_id, good, fit``: at most ``LABELS`` rows, whatever the size of the table. An id with several labels is
    good if all are."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = known.groupBy(F.col(id_col).alias("_label_id")).agg(F.min(F.col(label_col) > 0).alias("good"))
    first = one.orderBy(F.xxhash64("_label_id"), "_label_id").limit(LABELS)
    return first.withColumn("fit", F.pmod(F.xxhash64(F.lit(1), "_label_id"), F.lit(2)) == 0)


def log_ratios(texts: DataFrame, sample: DataFrame) -> np.ndarray:
    """The log ratio per bucket; ``texts`` has ``id, text``."""
    fit = sample.where("fit AND good").select("_label_id", "good")
    joined = texts.join(F.broadcast(fit), F.col("id") == F.col("_label_id"), "left").select("text", "good")
    counts = joined.mapInArrow(_count, "bucket long, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    table = counts.toArrow()  # at most 2 ** BITS rows
    raw, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    raw[table.column("bucket").to_numpy()] = table.column("raw").to_numpy()
    good[table.column("bucket").to_numpy()] = table.column("good").to_numpy()
    p_raw = raw / max(raw.sum(), 1)
    ratio = (good + PRIOR) / (good.sum() * p_raw + PRIOR)
    return np.log(ratio / max((ratio * p_raw).sum(), 1e-9)) if raw.any() else np.zeros(1 << BITS)


def separating_value(good: np.ndarray, bad: np.ndarray) -> float:
    """The value between neighbouring weights with the least loss when all at or above it are taken."""
    if not len(good) or not len(bad):
        return -np.inf
    cuts = np.unique(np.concatenate((good, bad)))
    lost = LOSS * np.searchsorted(np.sort(good), cuts)
    wrong = len(bad) - np.searchsorted(np.sort(bad), cuts)
    best = int(np.argmin(lost + wrong))
    return float(cuts[best] + cuts[best - 1]) / 2 if best else float(cuts[0])


def _weigh(ratios: Broadcast, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for a, b, words, per_text in word_blocks(batch.column(text), punctuation=True):
                h, owner = buckets(words, per_text)
                n = np.bincount(owner, minlength=b - a)
                weight[a:b] = np.bincount(owner, ratios.value[h], b - a) * LENGTH / (n + SHORT)
            others = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(weight)], [*others, out])

    return run


def gumbel(id_col: Column, seed: int) -> Column:
    """Standard Gumbel noise from seed and id."""
    u = (F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(1 << 32)) + 0.5) / float(1 << 32)
    return -F.log(-F.log(u))


def threshold(keys: DataFrame, key: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of ``key``, from histograms between ever closer bounds."""
    if k <= 0:
        return float("inf")
    low, high = keys.agg(F.min(key), F.max(key)).first()
    while low < high:
        place = F.least(F.floor((F.col(key) - low) / ((high - low) / bins)), F.lit(bins - 1))
        inside = keys.where((F.col(key) >= low) & (F.col(key) <= high)).groupBy(place.alias("bin"))
        rows = sorted(inside.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect(), reverse=True)
        for r in rows:
            if k <= r["n"]:
                break
            k -= r["n"]
        if k == r["n"]:
            return r["low"]
        low, high = r["low"], r["high"]
    return low


class Resampler:
    """Fitted on ``docs``: weighs and selects them."""

    def __init__(
        self, docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", temperature=TEMPERATURE, seed=SEED
    ):
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        self.temperature, self.seed = temperature, seed
        stage = Stage(docs.sparkSession, "quality")
        sample = stage.write(label_sample(labels, id_col, label_col), "labels")
        texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        self.ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(texts, sample))
        self.weights = stage.write(self.weighed(docs.select(F.col(id_col), F.col(text_col)), "log_weight", "key", keep_text=False), "weights")
        rest = F.broadcast(sample.where("NOT fit"))
        known = self.weights.join(rest, F.col(id_col) == F.col("_label_id")).groupBy("_label_id", "good").agg(F.min("log_weight").alias("w")).toArrow()
        good, w = known.column("good").to_numpy(zero_copy_only=False).astype(bool), known.column("w").to_numpy()
        value = separating_value(w[good], w[~good])
        self.threshold = threshold(self.weights, "key", self.weights.where(F.col("log_weight") >= value).count())

    def weighed(self, docs: DataFrame, weight: str, key: str, keep_text: bool = True) -> DataFrame:
        text = fresh([*docs.columns, weight, key], "_text")
        rows = docs.withColumn(text, text_of(self.text_col))
        kept = docs if keep_text else docs.drop(self.text_col)
        rows = rows.select(*kept.columns, text)
        schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes) + f", `{weight}` double"
        noise = gumbel(F.col(self.id_col), self.seed) * self.temperature
        return rows.mapInArrow(_weigh(self.ratios, text, weight), schema).withColumn(key, F.col(weight) + noise)

    def judged(self) -> DataFrame:
        """One row per row: id, ``log_weight, key, selected``."""
        return self.weights.withColumn("selected", F.col("key") >= self.threshold)

    def selected(self) -> DataFrame:
        """The rows of ``docs`` that are selected, all columns, weighed again in one more pass: nothing is joined."""
        weight = fresh(self.docs.columns, "_weight")
        key = fresh(self.docs.columns, "_key")
        return self.weighed(self.docs, weight, key).where(F.col(key) >= self.threshold).drop(weight, key)
