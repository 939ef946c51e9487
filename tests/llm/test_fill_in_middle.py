import hashlib
import re

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from stowage.llm import fim_frames as ff
from tests.llm.conftest import ODD

UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SIGNS = [s.encode() for s in ff.SENTINELS]


def by_hand(doc_id, text):
    """n, form, characters of prefix and middle, output."""
    text = text or ""
    units = re.findall(UNITS, text)
    n = len(units)
    x = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:one], units[one:two], units[two:]))
    if not text or any(sign in text for sign in ff.SENTINELS) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    "one two  three", " \tlead and trail \n", "ünï 日本 テキスト 😀 x", "a<P>b", "<M>", "<S", "a <P <S> b", "<<P", "word " * 300,
    "x" * 900 + " " + "y" * 900 + "  ", "a\x85b\xa0c\x1cd", "<P", "P>", "\n",
]


def rows_for_all_forms():
    rows = [(100 * k + i, t) for k in range(12) for i, t in enumerate(TEXTS)] + ODD + [(None, "no id"), (7, "x " * 200)]
    forms = {by_hand(d, t)[1] for d, t in rows}
    assert forms == {"plain", "psm", "spm"}
    return rows


@pytest.mark.parametrize("frame_bytes", [7, 64, ff.FRAME_BYTES])
def test_outputs_and_texts_rebuilt_are_those_by_hand(documents, tmp_path, frame_bytes):
    rows = rows_for_all_forms()
    if frame_bytes == 7:
        rows = [r for r in rows if len(r[1] or "") < 5000]
    store = ff.store_frames(documents(*rows), str(tmp_path / "frames"), frame_bytes=frame_bytes)
    got = ff.digest_outputs(ff.fill_in_middle(store)).collect()
    want = [(d, *by_hand(d, t), t or "") for d, t in rows]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(tuple, got), key=str) == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=str)


def test_frames_are_independent_and_an_output_is_one_stream(documents, tmp_path):
    rows = rows_for_all_forms()
    store = ff.store_frames(documents(*rows), str(tmp_path / "frames"), frame_bytes=64)
    texts = {d: t or "" for d, t in rows if d is not None}
    for r in store.filter("doc_id >= 100").collect():
        chars = 0
        for f in r.frames:
            piece = zstandard.decompress(f.data).decode()
            assert f.chars == chars and f.units == len(re.findall(UNITS, texts[r.doc_id][:chars]))
            chars += len(piece)
        assert chars == r.n_chars == len(texts[r.doc_id])
    some = [r for r in ff.fill_in_middle(store).collect() if r.doc_id and r.doc_id >= 100]
    assert any(len(r.output) > 6 for r in some)
    for r in some:
        whole = zstandard.ZstdDecompressor().stream_reader(b"".join(r.output), read_across_frames=True).read()
        assert whole.decode() == by_hand(r.doc_id, texts[r.doc_id])[4]


def test_only_frames_with_a_cut_are_opened(documents, tmp_path, monkeypatch):
    store = ff.store_frames(documents((0, "word " * 4000)), str(tmp_path / "frames"), frame_bytes=100)
    row = store.collect()[0]
    text = ff.Framed([f.asDict() for f in row.frames], row.n, row.n_chars)
    first, second = text.place(1005), text.place(3011)
    parts = [text.between(text.start, first), text.between(first, second), text.between(second, text.end)]
    assert len(text._opened) == 2 and len(row.frames) > 150
    got = [b"".join(ff.opened(p)).decode() for p in parts]
    units = re.findall(UNITS, "word " * 4000)
    assert got == ["".join(units[:1005]), "".join(units[1005:3011]), "".join(units[3011:])]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab <PSM>\n", max_size=30), st.integers(0, 30), st.integers(0, 30), st.sampled_from(["psm", "spm"]), st.integers(1, 9))
def test_texts_come_back_from_frames_cut_anywhere(text, one, two, form, size):
    if any(s in text for s in ff.SENTINELS):
        return
    one, two = sorted((one % (len(text) + 1), two % (len(text) + 1)))
    parts = [text[:one], text[two:], text[one:two]]
    output = "".join(ff.SENTINELS[k] + parts[k] for k in ff.FORMS[form]).encode()
    frames = [zstandard.compress(output[i : i + size]) for i in range(0, len(output), size)]
    assert b"".join(ff.restored(frames, form, SIGNS)).decode() == text


def test_an_output_without_its_sentinels_is_refused():
    with pytest.raises(ValueError):
        list(ff.restored([zstandard.compress(b"<P>a<S>b")], "psm", SIGNS))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aé \n\t", max_size=12), max_size=6))
def test_units_are_those_of_the_expression(texts):
    data = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts], dtype=np.int64)]).astype(np.int64)
    ends, bounds = ff.unit_ends(np.frombuffer(data, np.uint8), offsets)
    for r, t in enumerate(texts):
        want = np.cumsum([len(u.encode()) for u in re.findall(UNITS, t)]).tolist()
        assert (ends[bounds[r] : bounds[r + 1]] - offsets[r]).tolist() == want


def test_an_empty_table(documents, tmp_path):
    store = ff.store_frames(documents(), str(tmp_path / "frames"))
    assert ff.digest_outputs(ff.fill_in_middle(store)).collect() == []
