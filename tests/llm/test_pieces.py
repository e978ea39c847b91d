import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tableops.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a", "▁▁ b", "\n\n\t", "x" * 900, "ab" * 400, "日本語" * 30, "\x00\x01", "é​�\U0001f600", "<s></s><0x0A><unk>",
    "http://www.example.com/a_b?c=d&e=f" * 5, "    " * 60, "don't\r\nstop", "ǅ ﬁ ſ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = "etaoin shrdlu ETA.,;-_\n\t▁äöüßéñ中あ\U0001f600\x00<>/0123"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_ids_and_text_equal_the_library(library):
    v = pieces.vocabulary(MODEL)
    texts = ODD + random_texts(600, 1)
    for t, ids in zip(texts, v.encode(texts)):
        own = [*ids.tolist(), v.end]
        assert own == library.encode(t, add_eos=True), t
        assert v.decode(own) == library.decode(own), t


def test_heap_and_side_by_side_agree():
    v = pieces.vocabulary(MODEL)
    for t in ODD[2:] + random_texts(100, 2):
        if t:
            codes = [ord(c) for c in " " + t]
            assert v.merge_by_heap(v.char_symbol[codes].tolist(), codes) == v.encode([t])[0].tolist()


def test_decoding_any_ids(library):
    v = pieces.vocabulary(MODEL)
    rng = np.random.default_rng(4)
    plain = [i for i in range(library.get_piece_size()) if not library.is_byte(i) and not library.is_unknown(i)]
    for _ in range(50):
        ids = [int(x) for x in rng.choice(plain, 30)]
        assert v.decode(ids) == library.decode(ids)


def test_columns_rows_and_a_failing_check(spark, messy, nothing, library, monkeypatch):
    got = pieces.encode(messy, MODEL)
    assert got.columns == [c for c in messy.columns if c != "ids"] + ["ids"]
    for r in got.collect():
        assert r.ids == library.encode(r.text or "", add_eos=True) and r._text == "clash"
    digests = {r.doc_id: r for r in pieces.encode_digests(messy, MODEL).collect()}
    r = digests[4]  # a null text
    assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (1, hashlib.sha256(b"2").hexdigest(), hashlib.sha256(b"").hexdigest())
    assert pieces.encode(nothing, MODEL).count() == 0 and pieces.encode_digests(nothing, MODEL).count() == 0
    with pytest.raises(ValueError, match="differ from the library"):
        pieces._checked(pieces.vocabulary(MODEL), "some words", [5, 6, 2], "some words")
