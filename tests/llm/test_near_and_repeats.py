import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableops.llm import embedding_dedup, graph, minhash, repeats
from tableops.llm.arrow_text import Index, bytes_of, mixed, word_hashes
from tableops.llm.common import Stage


def reachable(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


# -- shared parts ----------------------------------------------------------------------------------------------


def test_word_hashes_tell_words_apart():
    texts = ["The the THE", "", None, " a\tb\x0bc ", "é É", "ab  ab", "x" * 5000, "a.b ##"]
    data, ends = bytes_of(pa.array(texts))
    hashes, per_text = word_hashes(data, ends)
    words = [w for t in texts for w in (t or "").translate({k: k + 32 for k in range(65, 91)}).split()]
    assert per_text.tolist() == [len((t or "").split()) for t in texts]
    seen = {}
    for h, w in zip(hashes.tolist(), words):
        assert seen.setdefault(h, w) == w
    assert len(seen) == len(set(words))
    assert word_hashes(*bytes_of(pa.array(["a.b ##"])), punctuation=True)[1].tolist() == [4]
    sliced = bytes_of(pa.array(texts).slice(3, 2))
    assert word_hashes(*sliced)[0].tolist() == hashes[3:8].tolist()


def test_index_finds_all_keys():
    keys = mixed(np.arange(5000, dtype=np.uint64))
    index = Index(keys)
    assert (index.find(keys) == np.arange(5000)).all()
    assert (index.find(mixed(np.arange(5000, 9000, dtype=np.uint64))) == -1).all()
    assert Index(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(5)
    n = 400
    pairs = {
        "path": [(i, i + 1) for i in range(n - 1) if i % 100 != 99],
        "star": [(7, i) for i in range(n) if i % 3],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(250)],
    }[shape]
    edges = spark.createDataFrame(pairs + pairs[:5] + [(b, a) for a, b in pairs[:5]] + [(None, 3)], "a long, b long")
    got = {r.node: r.label for r in graph.components(edges, Stage(spark, "test")).collect()}
    want = reachable(n, pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert graph.components(edges.limit(0), Stage(spark, "test")).count() == 0


# -- MinHash ---------------------------------------------------------------------------------------------------


def corpus(seed=2, groups=14):
    """Groups of near copies at many distances, sharing passages."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(4000)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(40, 150))]
        for k in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(k):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own + (common if g % 2 else [])))
    texts += texts[:6] + [texts[3].upper().replace(" ", "\n "), "", None, "one two", "One  two", "one", "  "]
    return texts


def features(text, idf):
    words, per_text = word_hashes(*bytes_of(pa.array([text])))
    _, s, count = minhash.shingles(words, per_text)
    raw = np.repeat((s & np.uint64(0xFFFFFFFF)).astype(np.uint32), count)
    return minhash._features(raw.tobytes()) if len(raw) else None


@pytest.mark.parametrize("block", [256, 3])
def test_near_groups_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_LEFT", block)
    monkeypatch.setattr(minhash, "BLOCK_ALL", 2 * block)
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    idf = minhash.inverse_frequencies(docs)
    own = [features(t, idf) for t in texts]
    pairs = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if own[i] is not None and own[j] is not None and minhash.weighted_jaccard(own[i], own[j], idf) >= 0.8
    ]
    assert len(pairs) > 30
    want = reachable(len(texts), pairs)
    got = {r.doc_id: r for r in minhash.near_groups(docs).collect()}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(got[i].kept == (want[i] == i) and got[i].group_size == want.count(want[i]) for i in got)


def test_weighted_jaccard_by_definition(spark):
    docs = spark.createDataFrame([("a b c d e f a b c d e",), ("a b c d e f g",), ("q",)], "text string")
    idf = minhash.inverse_frequencies(docs)
    x, y = features("a b c d e f a b c d e", idf), features("a b c d e f g", idf)
    assert len(x) == 7 and len(y) == 3  # the first shingle twice in x
    weight = lambda f: float(minhash._weights(f, idf).sum())
    both = np.intersect1d(x, y)
    assert minhash.weighted_jaccard(x, y, idf) == pytest.approx(weight(both) / (weight(x) + weight(y) - weight(both)))
    assert list(minhash.similar_pairs([x, y], [y, x], idf, 0.99)) == [(0, 1), (1, 0)]


def test_samples_collide_as_often_as_texts_are_similar():
    rng = np.random.default_rng(1)
    s = np.unique(mixed(rng.integers(0, 2**62, 300).astype(np.uint64)) >> np.uint64(16))
    weight = rng.uniform(0.5, 3, len(s))
    agree, trials = 0, 60
    for t in range(trials):
        moved = mixed(s + np.uint64(t)) & np.uint64((1 << 48) - 1)
        other = weight.copy()
        other[: len(s) // 5] *= 0.25
        both = [minhash.samples(np.zeros(len(s), np.int64), moved, w, 1)[0] for w in (weight, other)]
        agree += (both[0] == both[1]).sum()
    similarity = np.minimum(weight, other).sum() / np.maximum(weight, other).sum()
    assert agree / (trials * minhash.BANDS) == pytest.approx(similarity**minhash.ROWS, abs=0.06)


def test_near_dedup_of_messy_and_empty_tables(messy, nothing):
    got = minhash.near_dedup(messy)
    assert got.columns == messy.columns
    groups = minhash.near_groups(messy).collect()
    assert len(groups) == messy.count() and sum(r.kept for r in groups) >= got.count() > 5
    assert minhash.near_groups(nothing).count() == 0 and minhash.near_dedup(nothing).count() == 0


# -- embeddings ------------------------------------------------------------------------------------------------


def cloud(seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.standard_normal((25, 16)):
        out += [(c + rng.standard_normal(16) * s).tolist() for s in rng.uniform(0, 0.5, 12)]
    out += [out[0]] * 40 + [[2 * x for x in out[1]]]
    out += [None, [], [0.0] * 16, [None] + [1.0] * 15, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, [1e300] * 16, [1e-300] * 16, [1.0] * 3]
    return out


@pytest.mark.parametrize("block", [2048, 7])
def test_vectors_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    vectors = cloud()
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, id string, n int").repartition(3)
    usable = [bool(v) and None not in v and bool(np.isfinite(v).all()) and any(v) for v in vectors]
    unit = [np.array(v) / np.abs(v).max() if ok else None for v, ok in zip(vectors, usable)]
    pairs = [
        (i, j)
        for i in range(len(vectors))
        for j in range(len(vectors))
        if i != j and usable[i] and usable[j] and len(unit[i]) == len(unit[j])
        and unit[i] @ unit[j] / np.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= 0.95
    ]
    links, want = Counter(i for i, _ in pairs), reachable(len(vectors), pairs)
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame).collect()}
    assert len(got) == len(vectors) and max(links.values()) >= 40
    for i in got:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i], want[i], want[i] == i)


def test_planned_tables_reach_the_threshold():
    for n in (0, 10, 10**4, 10**6, 10**9):
        bits, tables = embedding_dedup.plan(n)
        assert (1 - (1 - math.acos(0.95) / math.pi) ** bits) ** tables <= 1.0001e-6
    assert embedding_dedup.plan(0)[0] <= embedding_dedup.plan(10**6)[0] <= 14


def test_no_vectors_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, None)]
    got = sorted(embedding_dedup.near_vectors(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == [("5", 2, "5"), ("5", 2, "5"), ("None", 0, "None"), ("None", 2, "5")]


# -- repeats ---------------------------------------------------------------------------------------------------


def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(mark)) if mark[i] and (not i or not mark[i - 1]))
        out.append((len(b), sum(mark), runs, bytes(x for x, y in zip(b, mark) if not y)))
    return sorted(out)


def fragments(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab c") for _ in range(rng.randint(5, 80))) for _ in range(20)]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(90)]
    return out + [None, "", "x" * 300, "ab" * 200, "é" * 90] + out[:4]


@pytest.mark.parametrize("seed,group", [(1, 2000), (2, 2000), (3, 2), (4, 0)])
def test_removed_bytes_match_brute_force(spark, seed, group):
    texts = fragments(seed)
    docs = spark.createDataFrame([(None if i % 11 == 0 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = repeats.remove_repeats(docs.repartition(3), length=20, gram=6, group=group).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == removed(texts, 20)


def test_very_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 100)
    texts = fragments(6)
    column = pa.array(texts)
    whole = {}
    for data, _, start, at, low, high, h, c in repeats._found(column, 20, 6):
        for i in range(len(at)):
            for s in range(low[i], high[i] + 1):
                key = (bytes(data[s : s + 20]), int(h[i]), int(at[i] - s))
                whole[key] = whole.get(key, 0) + 1
    raw = Counter((t or "").encode()[i : i + 20] for t in texts for i in range(len((t or "").encode()) - 19))
    assert Counter({k: 0 for k in raw}) + Counter() == Counter()
    by_string = defaultdict(int)
    for (s, _, _), n in whole.items():
        by_string[s] += n
    assert by_string == raw  # every string once, and equal strings at the same place of the same anchor
    assert len(whole) == len(raw)


def test_interval_tree_and_maximal_repeats():
    strings = sorted(b"banana$"[i:] for i in range(7))
    found = {(p, tuple(strings[a : b + 1])) for p, a, b in repeats.intervals(strings)}
    assert found == {(1, (b"a$", b"ana$", b"anana$")), (3, (b"ana$", b"anana$")), (2, (b"na$", b"nana$")), (0, tuple(strings))}
    # left parts reversed; three occurrences of one anchor "K"
    contexts = [(b"xay", b"Kbcd"), (b"xaz", b"Kbcd"), (b"xq", b"Kbce")]
    groups = {(a, b, tuple(sorted(m))) for a, b, m in repeats.maximal_repeats(contexts, 3)}
    assert groups == {(2, 4, (0, 1)), (1, 3, (0, 1, 2))}
    assert repeats.common_prefix(b"abcd", b"abxd") == 2 and repeats.common_prefix(b"", b"a") == 0


def test_messy_rows(messy, nothing):
    got = repeats.remove_repeats(messy)
    want = removed([r.text for r in messy.collect()], 200)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == want
    assert repeats.remove_repeats(nothing).count() == 0
    assert got.select(F.sha2("kept", 256)).where("n_bytes = 0").first()[0] == hashlib.sha256(b"").hexdigest()
