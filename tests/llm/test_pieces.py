import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from stowage.llm import piece_agenda as pg
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pg.model_of(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    "", " ", "Hello  World", " lead", "trail ", "a\tb\nc", "▁x ▁▁", "<s>hi</s><unk><0x41>", "é́ﬁ１", "\x00a \x85b", "日本語 テキスト 한국어",
    "😀😀 x", "x" * 4000, " " * 3000, "ab" * 40 + " " + "the " * 500, "supercalifragilistic" * 30,
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁aeinrst\nThe"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=5))
def test_ids_are_the_librarys(texts):
    flat, bounds = pg.encode_batch(texts, MODEL)
    want = LIBRARY.encode(texts)
    for r, ids in enumerate(want):
        assert flat[bounds[r] : bounds[r + 1]].tolist() == ids
        assert pg.encode_alone(texts[r], MODEL).tolist() == ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 260), st.integers(0, 31_999)), max_size=30))
def test_any_ids_decode_as_in_the_library(ids):
    assert MODEL.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_the_heap_and_the_steps_agree(monkeypatch):
    texts = TEXTS[:-2] + ["the quick brown fox jumps over it " * 5]
    want = [LIBRARY.encode(t) for t in texts]
    for most in (1, 10**9):
        monkeypatch.setattr(pg, "IN_STEP", most)
        flat, bounds = pg.encode_batch(texts, MODEL)
        assert [flat[bounds[r] : bounds[r + 1]].tolist() for r in range(len(texts))] == want


def test_rows_have_ids_and_texts(documents):
    rows = list(enumerate(TEXTS)) + ODD + [(None, "again"), (4, "one")]
    got = pg.encode_and_decode(documents(*rows), PATH).collect()
    want = []
    for d, t in rows:
        ids = LIBRARY.encode(t or "", add_bos=True, add_eos=True)
        want.append((d, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), LIBRARY.decode(ids)))
    assert sorted(((r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in got), key=str) == sorted(want, key=str)
    bare = pg.encode_and_decode(documents((1, "a b")), PATH, bos=False, eos=False).collect()[0]
    assert np.frombuffer(bare.ids, "<u4").tolist() == LIBRARY.encode("a b")
    assert pg.encode_and_decode(documents(), PATH).collect() == []


def test_parts_that_share_a_hash_are_mended_by_the_comparison(monkeypatch):
    monkeypatch.setattr(pg, "_hashes", lambda points, starts, sizes: sizes.astype(np.uint64))
    texts = ["the cat sat on the mat", "abc def", ""]
    got = pg.checked(texts, pa.array([1, 2, 3]), MODEL, True, True)
    assert [g.tolist() for g in got] == LIBRARY.encode(texts, add_bos=True, add_eos=True)


def test_a_difference_ends_the_batch(monkeypatch):
    monkeypatch.setattr(pg, "encode_alone", lambda text, model: np.zeros(1, np.int64))
    monkeypatch.setattr(pg, "encode_batch", lambda texts, model: (np.zeros(1, np.int64), np.array([0, 1])))
    with pytest.raises(ValueError, match="document 8"):
        pg.checked(["abc"], pa.array([8]), MODEL, True, True)
