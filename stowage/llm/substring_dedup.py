"""Removal of passages that an earlier document already holds.

A *window* is ``WINDOW`` (13) consecutive words. A word goes if a window that covers it
also starts in a document with a smaller id; windows are judged on the input.

Not every window is compared with all others. Positions whose number modulo ``PERIOD``
(7) lies in ``COVER`` {0, 1, 3} are *anchors*: differences of cover members give every
residue, so any two places are both anchors after the same shift of 0 to 6 words. Two
equal windows of 13 words therefore share an anchor with its 7 words, 13 - (7 - 1).

1. Each anchor's 7 words are hashed and looked up in the corpus (see ``blocks``): does
   another document hold them at an anchor of its own?
2. From each such anchor the match is extended to the windows of 13 words around it, and
   those are looked up by their 64-bit hash: which is the smallest document with it?

Step 1 looks at 3 of 7 positions and step 2 only at places next to a shared anchor.
A window of n is taken for another by chance with a probability of n / 2^64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stowage.llm import blocks as B
from stowage.llm.text import space_words, whole_runs, windows

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
DIGEST = T.StructType().add("doc_id", "long").add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
#: Rows without an id come after all others.
LAST = np.iinfo(np.int64).max


def digest_repeats(docs: DataFrame) -> DataFrame:
    """What removal leaves of each row of ``docs`` (``doc_id``, ``text``), as a digest.

    ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256``: lowercase hex of SHA-256
    over the kept words joined by one space, in UTF-8. See ``remove_repeats`` for rules.
    """
    return _remove(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]), DIGEST, _digest)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``; no other column changes.

    A removed word goes with the white space after it; the rest keeps its layout. A text
    of which nothing is removed is unchanged, and a null text stays null. Texts of fewer
    than 13 words never change. Rows with the same id are one document: they take
    nothing from each other, so a repeated row is kept. Rows without an id come after
    all others: they lose what others hold and take nothing from anyone. Columns other
    than ``doc_id`` and ``text`` are carried along, whatever their names. A text is held whole by a
    task. An empty table gives no rows.
    """
    # Carried columns have numbers for names on the way, so that none meets a working column.
    names = [c if c in ("doc_id", "text") else f"carried{i}" for i, c in enumerate(docs.columns)]
    carried = docs.toDF(*names)
    return _remove(carried, carried.schema, _cut).toDF(*docs.columns)


def _remove(docs: DataFrame, schema, give) -> DataFrame:
    size = B.text_bytes(docs)
    anchors = B.Layout.of(size, keys_per_byte=0.08, width=5)
    runs = B.Layout.of(size, keys_per_byte=0.08, width=8)
    blocks = B.with_blocks(docs, anchors)

    def send_anchors(table: pa.Table) -> pa.Table:
        distinct, several = _anchors(_words(table), anchors)[2:]
        return B.cells(table[B.BLOCK][0].as_py(), distinct, several, anchors)

    def share(table: pa.Table) -> pa.Table:
        bucket = B.Bucket(table, np.uint8)
        shared = (bucket.times > 1) | (bucket.per_key(np.maximum) > 0)
        return bucket.answers(shared, lambda x: np.packbits(x).tobytes(), kind=1)

    def send_runs(table: pa.Table, answers: pa.Table) -> pa.Table:
        words = _words(table)
        _, keys = _runs(words, answers, anchors, runs)
        ids = _ids(table)
        order = np.lexsort((ids[words.rows[keys[0]]], keys[1]))
        first = _firsts(keys[1][order])
        least = ids[words.rows[keys[0]]][order][first]
        return B.cells(table[B.BLOCK][0].as_py(), keys[1][order][first], least, runs)

    def least(table: pa.Table) -> pa.Table:
        bucket = B.Bucket(table, np.int64)
        return bucket.answers(bucket.per_key(np.minimum), B.planes, kind=2)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        words = _words(table)
        _, (starts, keys) = _runs(words, answers, anchors, runs)
        distinct = np.sort(keys)
        distinct = distinct[_firsts(distinct)]
        gone = np.zeros(len(words) + 1, np.int64)
        if len(distinct):
            holder = B.answer_to(distinct, answers, 2, runs, lambda a, n: B.from_planes(a, np.int64))
            holder = holder[np.searchsorted(distinct, keys)]
            hit = starts[holder < _ids(table)[words.rows[starts]]]
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + WINDOW, -1)
        return give(table, words, np.cumsum(gone)[:-1] > 0)

    shared = B.reply(B.ask(blocks, send_anchors), share)
    windows_sent = B.meet(blocks, shared, send_runs, B.CELLS)
    answers = shared.unionByName(B.reply(windows_sent, least))
    return B.as_often(B.meet(blocks, answers, finish, T.StructType([*schema.fields, T.StructField(B.TIMES, T.LongType())])))


def _words(table: pa.Table):
    return space_words(table["text"])


def _ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].cast(pa.int64()).fill_null(LAST).to_numpy()


def _firsts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _anchors(words, layout: B.Layout):
    """Where anchors begin, their keys; the distinct keys, and which stand in several rows.

    Equal rows take nothing from each other, so it does not matter how often a row is there.
    """
    h = words.hashes()
    keys = windows(h, ANCHOR)
    at = whole_runs(words.rows, ANCHOR)
    place = at - words.bounds[words.rows[at]]
    at = at[np.isin(place % PERIOD, COVER) & (words.counts[words.rows[at]] >= WINDOW)]
    keys = layout.cut(keys[at])
    order = np.argsort(keys, kind="stable")
    k, r = keys[order], words.rows[at][order]
    first = _firsts(k)
    last = np.append(first[1:], len(k)) - 1 if len(first) else first
    return at, keys, k[first], (r[first] != r[last]).astype(np.uint8)


def _runs(words, answers: pa.Table, anchors: B.Layout, runs: B.Layout):
    """Starts and keys of the windows that hold a shared anchor."""
    at, keys, distinct, _ = _anchors(words, anchors)
    starts = whole_runs(words.rows, WINDOW)
    if not len(distinct) or not len(starts):
        return at, (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    bits = B.answer_to(distinct, answers, 1, anchors,
                       lambda a, n: np.unpackbits(np.frombuffer(a, np.uint8), count=n))
    shared = at[bits[np.searchsorted(distinct, keys)] > 0]
    count = np.zeros(len(words) + 1, np.int64)
    count[shared + 1] = 1
    count = np.cumsum(count)
    starts = starts[count[starts + PERIOD] > count[starts]]
    return at, (starts, runs.cut(windows(words.hashes(), WINDOW)[starts]))


def _digest(table: pa.Table, words, gone: np.ndarray) -> pa.Table:
    removed = np.add.reduceat(np.append(gone, False), np.minimum(words.bounds[:-1], len(gone)), dtype=np.int64)
    removed[words.counts == 0] = 0
    shas = []
    for row, text in enumerate(table["text"]):
        kept = (text.as_py() or "").encode().split()  # at the same bytes as words are parted
        if removed[row]:
            stays = ~gone[words.of_row(row)]
            kept = [kept[i] for i in np.flatnonzero(stays)]
        shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return pa.table({
        "doc_id": table["doc_id"].combine_chunks(),
        "n_words": pa.array(words.counts, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "kept_sha256": pa.array(shas, pa.string()),
        B.TIMES: table[B.TIMES],
    })


def _cut(table: pa.Table, words, gone: np.ndarray) -> pa.Table:
    texts = []
    for row, text in enumerate(table["text"].to_pylist()):
        mine = words.of_row(row)
        if gone[mine].any():
            begin = words.starts[mine]
            base = begin[0] - (len(text.encode()) - len(text.encode().lstrip()))
            data = text.encode()
            begin = begin - base
            turns = np.flatnonzero(np.diff(np.concatenate([[False], ~gone[mine], [False]]).astype(np.int8)))
            edges = np.append(begin, len(data))
            edges[0] = 0
            texts.append(b"".join(data[edges[a] : edges[b]] for a, b in zip(turns[::2], turns[1::2], strict=True)).decode())
        else:
            texts.append(text)
    at = table.schema.get_field_index("text")
    out = table.set_column(at, "text", pa.array(texts, pa.string()))
    return out.drop_columns([B.BLOCK])
