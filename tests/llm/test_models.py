import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableops.llm import maxent, quality
from tableops.llm.arrow_text import bytes_of, word_hashes
from tableops.session import read_table

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- quality ---------------------------------------------------------------------------------------------------


def test_resampling_keeps_clean_and_drops_junk_on_held_out_labels(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    known = labels.where("doc_id % 2 = 0")
    judged = quality.Resampler(docs, known).judged().join(labels.where("doc_id % 2 = 1"), "doc_id")
    got = {r.quality: (r.n, r.kept) for r in judged.groupBy("quality").agg(F.count("*").alias("n"), F.count_if("selected").alias("kept")).collect()}
    assert got[1][1] >= 0.97 * got[1][0]
    assert got[0][1] <= 0.15 * got[0][0]


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.standard_normal(500) * 10, 1).tolist() + [3.0] * 40 + [-1e6, 1e6]
    keys = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 57, 200, len(values)):
        assert quality.threshold(keys, "x", k, bins=8) == ordered[k - 1]
    assert quality.threshold(keys, "x", 0) == math.inf
    assert quality.threshold(spark.createDataFrame([(2.0,)] * 5, "x double"), "x", 3) == 2.0


def test_gumbel_noise_is_standard_and_seeded(spark):
    def draw(seed):
        return [r[0] for r in spark.range(20_000).select(quality.gumbel(F.col("id"), seed)).collect()]

    a = np.array(draw(1))
    assert a.mean() == pytest.approx(0.5772, abs=0.04) and a.var() == pytest.approx(math.pi**2 / 6, rel=0.06)
    assert draw(1) == a.tolist() and draw(2) != a.tolist()


def test_log_weight_by_hand(spark):
    rows = [(i, "good words here and " * 50) for i in range(40)] + [(100 + i, "good ### words ### " * 50) for i in range(40)]
    docs = spark.createDataFrame(rows + [(200, "Good words here"), (201, "words ###"), (202, "unheard")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
    r = quality.Resampler(docs, labels)
    got = {x.doc_id: x for x in r.judged().collect()}
    assert got[0].log_weight == got[39].log_weight > got[200].log_weight > 0 > got[201].log_weight > got[100].log_weight
    h, _ = quality.buckets(*word_hashes(*bytes_of(pa.array(["words ###"])), True))
    assert got[201].log_weight == pytest.approx(r.ratios.value[h].sum() * quality.LENGTH / (len(h) + quality.SHORT))
    assert all(got[i].selected == (i < 100) for i, _ in rows)


def test_separating_value():
    assert quality.separating_value(np.array([1.0, 2, 3]), np.array([-5.0, -1])) == 0.0
    assert quality.separating_value(np.array([1.0, 2, 3]), np.array([])) == -np.inf
    assert quality.separating_value(np.array([-2.0, 2, 3]), np.array([-1.0, -1, -5])) == -3.5  # a good one is worth two bad ones
    assert quality.separating_value(np.array([1.0]), np.array([2.0])) == 1.0


def test_quality_of_messy_and_empty_tables(spark, messy, nothing):
    labels = spark.createDataFrame([(0, 1), (17, 0), (None, 1), (5, None), (0, 1)], "doc_id long, quality int")
    r = quality.Resampler(messy, labels)
    assert r.judged().count() == messy.count()
    assert r.selected().columns == messy.columns
    assert r.selected().count() == r.judged().where("selected").count() > 0
    assert r.judged().where("log_weight = 0").count() >= 3  # null and blank texts
    unlabelled = quality.Resampler(messy, labels.limit(0))
    assert unlabelled.selected().count() == messy.count()
    empty = quality.Resampler(nothing, labels)
    assert empty.judged().count() == 0 and empty.selected().count() == 0


# -- language model --------------------------------------------------------------------------------------------


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + [None]


def expected(rows):
    """Per row: (held out, tokens, known, training tokens, base score)."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    count = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for (_, t), h in zip(rows, held):
        own = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out.append((h, len(own), sum(count[w] > 0 for w in own), n, base))
    return out


@pytest.mark.parametrize("head", [1 << 20, 1100])
def test_base_scores_and_counts(spark, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD", head)  # with a small head the rarer tokens are joined
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in maxent.LanguageModel(docs).score(docs).collect()}
    gain = 0.0
    for (i, _), (h, n, known, total, base) in zip(rows, expected(rows)):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if h:
            gain += r.score - r.base_score
    assert gain > 0  # better than counts on documents it has not seen


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(3)
    words = maxent.mixed(np.arange(1, 700, dtype=np.uint64))
    counts = rng.integers(1, 500, len(words))
    model = maxent.Model.start(words, counts, 1234.5)
    model.flat[:] += rng.normal(0, 0.3, len(model.flat)).astype(np.float32)
    for _ in range(5):
        before, skip = (np.full(len(words) + 1, maxent.mixed(rng.integers(0, 99, 1).astype(np.uint64))[0]) for _ in range(2))
        every = np.append(words, maxent.mixed(np.array([10**6], np.uint64)))
        log, other = model.log10(every, before, skip)
        assert other.sum() == 1 and (10**log).sum() == pytest.approx(1, abs=1e-3)


def test_start_is_the_unigram_model():
    words = maxent.mixed(np.arange(1, 50, dtype=np.uint64))
    counts = np.arange(50, 1, -1)
    model = maxent.Model.start(words, counts, 30.0)
    log, _ = model.log10(words, words, words)
    assert 10**log == pytest.approx((counts + 0.5) / ((counts + 0.5).sum() + 30), rel=1e-4)


def test_learning_raises_the_likelihood():
    rng = np.random.default_rng(5)
    words = maxent.mixed(np.arange(1, 41, dtype=np.uint64))
    chain = [0]
    for _ in range(6000):  # mostly decided by the last word
        chain.append((chain[-1] * 7 + 3) % 40 if rng.random() < 0.8 else int(rng.integers(40)))
    seen, before, skip, _ = maxent._with_ends(words[chain], np.array([len(chain)]))
    model = maxent.Model.start(words, np.bincount(chain, minlength=40), 1.0)
    first = model.log10(seen, before, skip)[0].mean()
    for _ in range(3):
        model.learn(seen, before, skip, [np.zeros(len(p), np.float32) for p in model.parts])
    assert model.log10(seen, before, skip)[0].mean() > first + 0.1


def test_every_counted_token_has_its_own_score():
    rng = np.random.default_rng(7)
    v = 3000
    words = maxent.mixed(np.arange(1, v + 1, dtype=np.uint64))
    counts = np.append(np.full(maxent.CLASSES * maxent.SLOTS, 50), np.full(v - maxent.CLASSES * maxent.SLOTS, 9))
    top, bits = maxent.CLASSES * maxent.SLOTS, maxent.tail_bits(v)
    masses = np.zeros(1 << bits, np.float32)
    np.add.at(masses, maxent.cells_of(words[top:], bits), counts[top:] + 0.5)
    model = maxent.Model.start(words[:top], counts[:top], 0.5, masses)
    unseen = maxent.mixed(np.array([10**6], np.uint64))
    assert 1 << bits >= v and maxent.growth(1 << 30) == 4 and maxent.tail_bits(10**7) == 24  # sized from N and V

    def probabilities(last):
        before = np.full(v + 1, words[last])
        chain, tail, other = model.chains(np.append(words, unseen), before, before)
        return 10 ** np.where(other & (np.arange(v + 1) < v), tail + np.log10(np.append(counts, 0) + 0.5), chain)

    assert probabilities(0)[:v] == pytest.approx((counts + 0.5) / (counts.sum() + 0.5 * (v + 1)), rel=1e-3)
    # two tokens of the tail, equally frequent, each after a word of its own
    after = {0: 2000, 1: 2500}
    last = rng.integers(0, 2, 20_000)
    seen, before = words[np.where(last == 0, 2000, 2500)], words[last]
    for _ in range(3):
        model.learn(seen, before, before, [np.zeros(len(p), np.float32) for p in model.parts])
    for k, w in after.items():
        p = probabilities(k)
        assert p.sum() == pytest.approx(1, abs=1e-3)
        assert p[w] > 10 * p[after[1 - k]]


def test_scores_do_not_depend_on_the_partitioning(spark, monkeypatch):
    monkeypatch.setattr(maxent, "SHARD", 1 << 12)  # several shards a round
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").persist()
    got = []
    for n in (1, 8, 64):
        dealt = docs.repartition(n)
        model = maxent.LanguageModel(dealt)
        assert model.n / maxent.ROUNDS / (maxent.SHARD * model.grow) > 2
        got.append((model.flat.tolist(), {r.doc_id: r.score for r in model.score(dealt).collect()}))
    for flat, scores in got[1:]:
        assert flat == got[0][0]
        assert scores == pytest.approx(got[0][1], rel=1e-7)  # float32 row sums of batches that are cut elsewhere


def test_training_reads_a_shard_in_runs_whatever_its_batches():
    rng = np.random.default_rng(9)
    words = maxent.mixed(np.arange(1, 90, dtype=np.uint64))
    start = maxent.Model.start(words, np.full(89, 50), 0.5)
    texts = [" ".join(map(str, rng.integers(0, 500, int(n)))) for n in rng.integers(0, 3000, 70)]
    changes = []
    for cuts in ([70], [1, 30, 31, 70]):
        shard = maxent._Shard(0, words, start.flat, start.masses, 1)
        for a, b in zip([0, *cuts], cuts):
            shard.learn(pa.array(texts[a:b]))
        changes.append(pa.Table.from_batches(list(shard.changes())))
    assert shard.uses[0].sum() == 3 * sum(len(t.split()) + 1 for t in texts)
    assert changes[0].equals(changes[1]) and changes[0].num_rows > 0


def test_changes_of_a_row_are_averaged_by_its_uses():
    def change(shard, rows, uses, w):
        binary = (np.array(rows, np.int16), np.array(uses, np.int32), np.array(w, np.float16))
        return {"part": 2, "block": 512, "shard": shard, **dict(zip(("rows", "uses", "w"), (x.tobytes() for x in binary)))}

    batch = pa.RecordBatch.from_pylist([change(0, [3, 5], [1, 9], [[1, 2], [4, 4]]), change(7, [3, 6], [3, 2], [[5, -2], [0.5, 0]])])
    (row,) = pa.Table.from_batches(maxent._average(iter([batch]))).to_pylist()
    assert np.frombuffer(row["rows"], np.int16).tolist() == [3, 5, 6]
    assert np.frombuffer(row["w"], np.float32).tolist() == [4, -1, 4, 4, 0.5, 0]  # (1 + 3 * 5) / 4, (2 - 3 * 2) / 4


def _plain_score(model: maxent.LanguageModel, counts: dict, text: str) -> float:
    """log10 probability of a text token by token, from the definition, with Python numbers."""
    mask = (1 << 64) - 1

    def mix(h):
        for k in range(2):
            h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & mask
        return h ^ (h >> 32)

    def share(logits, target):
        top = max(logits)
        return math.exp(logits[target] - top) / sum(math.exp(x - top) for x in logits)

    m = maxent.Model(model.words, model.flat, model.masses, model.grow)
    classes, biases, slots, slot_biases, *tail = [p.tolist() for p in m.parts]
    place = {int(w): k for k, w in enumerate(model.words)}
    mass, bits, grow, spread = model.masses.astype(float), m.bits, model.grow, 0xC2B2AE3D27D4EB4F
    a, b, c = (r * grow for r in maxent.CLASS_ROWS)
    d, e = (r * grow for r in maxent.SLOT_ROWS)
    words = word_hashes(*bytes_of(pa.array([text])))[0].tolist() + [int(maxent.END)]
    total, context = 0.0, [int(maxent.END)] * 2
    for w in words:
        skip, last = context
        rows = (mix((last + 11) & mask) % a, mix((last * 0x9E3779B97F4A7C15 + skip + 12) & mask) % b + a, mix((skip + 13) & mask) % c + a + b)
        kind, slot = (place[w] % maxent.CLASSES, place[w] // maxent.CLASSES) if w in place else (maxent.CLASSES, None)
        p = share([x + sum(classes[r][k] for r in rows) for k, x in enumerate(biases)], kind)
        if slot is not None:
            rows = (mix((last + kind * spread) & mask) % d, mix((skip + kind * spread + 14) & mask) % e + d)
            p *= share([x + sum(slots[r][k] for r in rows) for k, x in enumerate(slot_biases[kind])], slot)
        elif w not in counts:
            p *= 0.5 / (mass.sum() + 0.5)
        else:
            cell, left, node = w >> (64 - bits), bits, 0
            p *= mass.sum() / (mass.sum() + 0.5) * (counts[w] + 0.5) / mass[cell]
            for table, width in zip(tail, m.level_bits(bits)):
                left -= width
                path = cell >> left
                below = [mass[(node << width | k) << left : ((node << width | k) + 1) << left].sum() for k in range(1 << width)]
                rows = [mix((x + (node + 1) * spread + y) & mask) % (maxent.TAIL_ROWS * grow) for x, y in ((last, 15), (skip, 16))]
                p *= share([math.log(max(x, 1e-20)) + sum(table[r][k] for r in rows) for k, x in enumerate(below)], path & ((1 << width) - 1))
                node = path
        total += math.log10(p)
        context = [last, w]
    return total


@pytest.mark.parametrize("grow", [1, 2])
def test_score_by_brute_force(spark, monkeypatch, grow):
    monkeypatch.setattr(maxent, "growth", lambda n: grow)
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    model = maxent.LanguageModel(docs)
    counts = {r.h & ((1 << 64) - 1): r.c for r in model.counts.collect()}
    assert model.v > maxent.CLASSES * maxent.SLOTS and len(model.masses)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in model.score(docs).collect()}
    short = sorted((i for i, t in texts.items() if 5 < len(t.split()) < 200), key=lambda i: (not got[i].held_out, i))[:24]
    assert any(got[i].n_known < got[i].n_tokens for i in short)
    for i in short:
        assert got[i].score == pytest.approx(_plain_score(model, counts, texts[i]), rel=1e-5)


def test_contexts_do_not_cross_texts():
    words = np.array([11, 12, 13, 14], np.uint64)
    got = maxent._with_ends(words, np.array([2, 0, 1, 1]))
    e = int(maxent.END)
    assert got[0].tolist() == [11, 12, e, e, 13, e, 14, e]
    assert got[1].tolist() == [e, 11, 12, e, e, 13, e, 14]
    assert got[2].tolist() == [e, e, 11, e, e, e, e, e]
    assert got[3].tolist() == [0, 0, 0, 1, 2, 2, 3, 3]


def test_scores_of_messy_and_empty_tables(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    got = maxent.LanguageModel(messy).score(messy).collect()
    key = lambda x: tuple(str(v) if i < 4 else f"{v:.6f}" for i, v in enumerate(x))
    assert sorted(key((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in got) == sorted(map(key, expected(rows)))
    assert all(math.isfinite(r.score) for r in got)
    assert maxent.LanguageModel(messy).score(nothing).count() == 0
    unseen = maxent.LanguageModel(nothing).score(messy).collect()  # nothing learned: all tokens alike
    assert len(unseen) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in unseen)


@pytest.mark.parametrize("punctuation", [False, True])
def test_word_hashes_by_hand(punctuation):
    texts = ["", "Ab c", " x,y..z\t", "é Ü", "word" * 9, "end", "start \n", ""]
    data, ends = bytes_of(pa.array(texts))
    got, per_text = word_hashes(data, ends, punctuation)
    kind = rb"[!-/:-@\[-^`{-~]+|[^\x20\x09-\x0D!-/:-@\[-^`{-~]+" if punctuation else rb"[^\x20\x09-\x0D]+"
    words = [re.findall(kind, t.encode()) for t in texts]
    assert per_text.tolist() == [len(w) for w in words]
    sums = [sum((b + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, b in enumerate(w.lower())) + len(w) for ws in words for w in ws]
    assert got.tolist() == maxent.mixed(np.array([s % (1 << 64) for s in sums], np.uint64)).tolist()


def test_word_hashes_take_few_passes():
    data = np.frombuffer((b"x" * 31 + b" ") * (1 << 13), np.uint8)
    word_hashes(data, np.array([len(data)]))  # the tables of powers stay
    tracemalloc.start()
    try:
        word_hashes(data, np.array([len(data)]))
        assert tracemalloc.get_traced_memory()[1] < 24 * len(data)  # numbers of eight bytes: the sums and the places
    finally:
        tracemalloc.stop()


def test_rows_put_as_items_equal_plain_assignment():
    rng = np.random.default_rng(3)
    for width in (2, 32, 33):
        flat = rng.normal(size=7 + 50 * width).astype(np.float32)  # a table is a part of the flat weights
        table, rows = flat[7:].reshape(50, width), rng.permutation(50)[:20]
        values = rng.normal(size=(20, width)).astype(np.float32)
        want = table.copy()
        want[rows] = values
        maxent._put_rows(table, rows, values)
        assert np.array_equal(table, want) and np.shares_memory(table, flat)
