"""The pipeline's stages on its own tables and on messy ones, against brute-force versions; the SQL entries."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from check_oracle import _rows, duck
from tableops.llm import mixing, pieces, queries
from tableops.session import read_table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rel = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, rel.fetchall())


def shingles(text):
    words = (text or "").translate(LOWER).split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def plain_similarity(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def test_stages_one_by_one(spark):
    docs = read_table(spark, SF, "documents")
    columns, state = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        state[name] = (before.collect(), docs.collect())
        assert docs.columns == (columns if name != "pieces" else [c for c in columns if c != "text"] + ["ids"])

    quality = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    before, after = state["quality"]
    kept = {r.doc_id for r in after}
    clean = [r.doc_id for r in before if quality.get(r.doc_id) == 1]
    junk = [r.doc_id for r in before if quality.get(r.doc_id) == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.2 * len(junk)

    before, after = state["exact_dedup"]
    best = {}
    for r in before:
        best[digest(r.text)] = max(best.get(digest(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values())

    before, after = state["near_dedup"]
    kept = [shingles(r.text) for r in after]
    gone = [shingles(r.text) for r in before if r.doc_id not in {x.doc_id for x in after}]
    assert gone and all(max(plain_similarity(g, k) for k in kept) > 0.6 for g in gone)  # each has a relative that stays
    assert all(plain_similarity(a, b) < 0.9 for i, a in enumerate(kept) for b in kept[:i])

    before, after = state["mix"]
    frame = spark.createDataFrame(before, read_table(spark, SF, "documents").schema)
    copies = {r.doc_id: r.copies for r in mixing.mix(frame).collect()}
    assert Counter(r.doc_id for r in after) == {i: n for i, n in copies.items() if n}

    before, after = state["pieces"]
    library = pieces.vocabulary(queries.PIECE_MODEL).library
    text = {r.doc_id: r.text for r in before}
    assert len(before) == len(after)
    assert all(r.ids == library.encode(text[r.doc_id], add_eos=True) and library.decode(r.ids) == text[r.doc_id] for r in after)


def test_stages_take_messy_tables(spark, messy, nothing):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, messy, SF)
        assert got.count() >= 0 and set(got.columns) >= set(messy.columns) - {"text"}, name
        assert stage(spark, nothing, SF).count() == 0, name
