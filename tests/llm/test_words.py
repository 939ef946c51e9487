import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stowage.llm.license_scan import license_words
from stowage.llm.text import slices, space_words, whole_runs, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Zé\n\t\x0b.9€", max_size=30)), max_size=8)


def spelled(words):
    data = words.data.tobytes()
    return [[data[words.starts[i] : words.ends[i]].decode() for i in range(*words.of_row(r).indices(len(words)))]
            for r in range(len(words.counts))]


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(0, 3))
def test_words_are_those_of_the_patterns(texts, skip):
    column = pa.array(texts, pa.string())[skip:]
    kept = texts[skip:]
    assert spelled(space_words(column)) == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in kept]
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in kept]
    assert spelled(license_words(column)) == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in low]


def test_hash_follows_the_word():
    words = ["a", "b", "ab", "a" * 8, "a" * 9, "a" * 16 + "b", "a" * 17, "é", "a\x00", "a" * 5000]
    h = space_words(pa.array([" ".join(words), " ".join(reversed(words))])).hashes()
    assert len(set(h.tolist())) == len(words)
    assert (h[: len(words)] == h[len(words) :][::-1]).all()


def test_windows_hash_their_words_in_order():
    h = space_words(pa.array(["a b c d e f g a b c d e f g", "b a"])).hashes()
    for k in range(1, 8):
        w = windows(h, k)
        assert w[0] == w[7]
        assert len(set(w[:7].tolist())) == 7
    assert windows(h, 2)[0] != windows(h, 2)[-1]
    assert len(windows(h, 99)) == 0
    assert whole_runs(np.array([0, 0, 1, 1, 1]), 2).tolist() == [0, 2, 3]


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["x" * n for n in (5, 0, 50, 3, 3, 3)] + [None])})
    parts = list(slices(iter([batch]), "text", 10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(len(p.column("text")[0].as_py() or "") for p in parts) == 50
