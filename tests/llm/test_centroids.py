import hashlib
import math
import random

import numpy as np
import pytest

from tableops.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, id string, v string, dots string, cluster string, size string"
CLASH = ("x",) * 5


def vectors(n=300, seed=3):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = []
    for i in range(n):
        m = middles[0 if i % 3 else i % 5]
        rows.append((i, [float(np.float32(c + rng.gauss(0, 0.3))) for c in m], *CLASH))
    rows += [rows[0], rows[0], (None, rows[4][1], *CLASH), (7, rows[9][1], *CLASH)]
    rows += [(1000, None, *CLASH), (1001, [], *CLASH), (1002, [1.0] * 63, *CLASH), (1003, [1.0] * 65, *CLASH)]
    rows += [(1004, [None] + [1.0] * 63, *CLASH), (1005, [math.nan] * 64, *CLASH), (1006, [math.inf] + [0.0] * 63, *CLASH)]
    return rows + [(1007, [0.0] * 64, *CLASH), (1008, [-0.001] * 64, *CLASH)]


def brute(rows, k=16, rounds=3):
    kept = []
    for i, e, *_ in rows:
        if e is not None and len(e) == 64 and all(c is not None and math.isfinite(c) for c in e):
            kept.append((i, [math.floor(64 * c) for c in e]))
    named = sorted((hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cs = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            cs[j] = [sum(col) // len(g) for col in zip(*g)]
    at = [(i, *nearest(v)) for i, v in kept]
    each = {}
    for _, d, j in at:
        each[j] = each.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, j, d, each[j], sum(each.values()), digest[j]) for i, d, j in at), key=str)


def got(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in centroids.cluster(df, **kw).collect()), key=str)


def test_equals_brute_force_with_messy_rows(spark):
    assert got(spark, vectors()) == brute(vectors())


@pytest.mark.parametrize("parts", [1, 7])
def test_few_rows_and_other_numbers(spark, parts):
    assert got(spark, vectors()[:5], parts) == brute(vectors()[:5])
    assert got(spark, vectors(40), parts, k=3, rounds=6) == brute(vectors(40), 3, 6)


def test_empty_and_unusable(spark):
    assert got(spark, []) == []
    assert got(spark, [r for r in vectors() if r[0] in (1000, 1001, 1005)]) == []


def test_far_components_fail(spark):
    with pytest.raises(Exception, match="would not fit"):
        got(spark, [(1, [1e30] * 64, *CLASH)])


def test_update_reads_changed_components_only():
    rng = np.random.default_rng(1)
    v, old = rng.integers(-99, 99, (50, 64)), rng.integers(-99, 99, (4, 64))
    new = old.copy()
    new[1, 3] += 5
    new[2] -= 1
    unread = np.flatnonzero((new == old).all(axis=0))
    damaged = v.copy()
    damaged[:, unread] = 10**6
    assert (centroids.moved(v @ old.T, v, old, new) == v @ new.T).all()
    assert (centroids.moved(v @ old.T, damaged, old, new) == v @ new.T).all()
