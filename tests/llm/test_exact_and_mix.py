import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableops.llm import exact_dedup, mixing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def test_exact_groups_match_brute_force(messy):
    got = exact_dedup.exact_groups(messy).collect()
    groups = defaultdict(list)
    for r in messy.collect():
        groups[digest(r.text)].append(r.doc_id)
    assert len(got) == messy.count()
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == set(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_keeps_whole_rows_once(messy, nothing):
    got = exact_dedup.exact_dedup(messy)
    assert got.columns == messy.columns
    texts = [digest(r.text) for r in got.collect()]
    assert sorted(texts) == sorted({digest(r.text) for r in messy.collect()})
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.exact_dedup(nothing).count() == 0


def test_runs_merge_over_several_rounds(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")  # 64 runs, three rounds
    try:
        docs = spark.range(0, 3000, 1, 50).select(F.col("id").alias("doc_id"), F.pmod("id", F.lit(7)).cast("string").alias("text"))
        got = exact_dedup.exact_groups(docs).where("kept").collect()
        assert sorted((r.text_sha256, r.keep_id, r.group_size) for r in got) == sorted(
            (digest(str(k)), max(range(k, 3000, 7)), len(range(k, 3000, 7))) for k in range(7)
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_disagreeing_checks_fail(spark):
    rows = spark.createDataFrame(
        [(0, bytearray(32), i, i, 100 + i, 5) for i in range(2)], "part int, digest binary, id long, rid long, check long, n_bytes long"
    )
    with pytest.raises(Exception, match="share a SHA-256 digest"):
        exact_dedup.merge_runs(rows).collect()


def fill(sizes, weights, epochs):
    """Water-filling one source at a time."""
    total, capped = sum(sizes), set()
    while True:
        left = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(epochs * sizes[i] for i in capped)
        level = rest / sum(weights[i] for i in left) if left else 0
        over = {i for i in left if level * weights[i] > epochs * sizes[i]}
        if not over:
            return [epochs * sizes[i] if i in capped else level * weights[i] for i in range(len(sizes))]
        capped |= over


def test_water_filling_and_shares(spark):
    rng = np.random.default_rng(3)
    names = ["s%02d" % k for k in range(9)] + [None]
    rows = []
    for s, n in zip(names, (3, 900, 40, 1, 60, 7, 150, 2, 30, 80)):
        rows += [(len(rows) + k, "w " * int(rng.integers(0, 40)), s) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(docs).collect()
    sizes = [sum(len(t.split()) for _, t, x in rows if x == s) for s in names]
    want = fill(sizes, [(5, 2, 1)[k % 3] for k in range(10)], 3)
    for s, size, target in zip(names, sizes, want):
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
        assert all(0 <= r.copies <= 3 for r in own)
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7)).collect())  # reruns agree


def test_mix_of_messy_and_empty_tables(messy, nothing):
    got = mixing.mix(messy)
    assert got.count() == messy.count()
    assert got.where("size = 0 AND taken <> 0").count() == 0
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns
    assert mixed.count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
