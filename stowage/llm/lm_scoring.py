"""Stupid-backoff language-model scores of documents.

Count tables of n-grams of each order up to three are held partitioned by hash. The
n-grams of every document are sent to the tables by block (see ``blocks``), joined
there by key, and the scores of a document's words are summed in its block. Words and
pairs go first. A triple that stands in another document has both its pairs there, so only
triples of which both pairs are known elsewhere are sent and counted.

Each document is scored by the counts of **all other** documents: its own n-grams are
taken off first. Otherwise each n-gram would be found at the highest order, and scores
would say nothing. A word's score is ``c(a b w) / c(a b)`` if that n-gram was seen,
else 0.4 times the score with one word of context less; at last ``c(w) / N``, where a
word never seen counts as seen once.

N-grams are told apart by hashes of 56 bits and those that name one of the buckets, of
which there is one for a million n-grams, 64 bits together at most. A given n-gram meets
another by chance with a probability of about 2^-36, and of n / 2^64 from n = 2^28 distinct
n-grams on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stowage.llm import blocks as B
from stowage.llm.text import mix, space_words, windows

ORDER = 3
BACKOFF = 0.4
SCHEMA = ("doc_id long, n_words long, n_trigrams long, n_bigrams long, n_unigrams long, "
          "log_score double, mean_log_score double")
#: The key under which blocks count all words.
ALL_WORDS = mix(np.array([1], np.uint64))


def score_documents(docs: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (``doc_id``, ``text``); other columns are not read.

    One row per input row: ``n_words``; how many words were scored at each order
    (``n_trigrams``, ``n_bigrams``, ``n_unigrams``); ``log_score``, the sum of natural
    logarithms over the words, and ``mean_log_score``, that per word, to six digits.
    A text that is null, empty or all spaces has zero words, ``log_score`` 0 and
    ``mean_log_score`` null. Rows that repeat are documents of their own, and so is one
    without an id; equal rows are counted and scored together, so a third of all may be one
    row. A text is held whole by a task. An empty table gives no rows.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    layout = B.Layout.of(B.text_bytes(docs), keys_per_byte=0.2, width=7, block_bytes=4 << 20)
    blocks = B.with_blocks(docs, layout)

    def send_pairs(table: pa.Table) -> pa.Table:
        return B.cells(table[B.BLOCK][0].as_py(), *_distinct(*_Grams(table, layout).lower()), layout)

    def send_triples(table: pa.Table, answers: pa.Table) -> pa.Table:
        grams = _Grams(table, layout)
        grams.hear(answers)
        return B.cells(table[B.BLOCK][0].as_py(), *_distinct(*grams.triples()), layout)

    def count(kind: int):
        def resolve(table: pa.Table) -> pa.Table:
            bucket = B.Bucket(table, np.uint64)
            return bucket.answers(bucket.per_key(np.add), B.planes, kind)

        return resolve

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        grams = _Grams(table, layout)
        grams.hear(answers)
        grams.hear_triples(answers)
        return _scores(table["doc_id"], grams).append_column(B.TIMES, table[B.TIMES])

    pairs = B.reply(B.ask(blocks, send_pairs), count(1))
    triples = B.reply(B.meet(blocks, pairs, send_triples, B.CELLS), count(2))
    return B.as_often(B.meet(blocks, pairs.unionByName(triples), finish, f"{SCHEMA}, {B.TIMES} long"))


class _Grams:
    """The n-grams of a block's texts, and what is known of how often they stand elsewhere.

    ``seen[k][i]``: how often the (k + 1)-gram that ends at word ``i`` stands in other rows.
    """

    def __init__(self, table: pa.Table, layout: B.Layout):
        self.layout = layout
        self.words = words = space_words(table["text"])
        h = words.hashes()
        self.place = np.arange(len(words)) - np.repeat(words.bounds[:-1], words.counts)
        self.ends = [self.place >= k for k in range(ORDER)]
        self.keys = []
        for k in range(ORDER):
            runs = windows(h, k + 1)
            self.keys.append(layout.cut(runs[np.flatnonzero(self.ends[k]) - k] if len(runs) else runs))
        times = table[B.TIMES].to_numpy()
        #: How many copies of its row a word stands for; None where all rows are there once.
        self.times = np.repeat(times, words.counts).astype(np.uint64) if (times > 1).any() else None
        self.presence = layout.cut(ALL_WORDS)[0]
        self.seen = [np.zeros(len(words), np.int64) for _ in range(ORDER)]
        self.all_words = 0

    def lower(self) -> tuple[np.ndarray, np.ndarray | None]:
        """The keys of all words and pairs, and that of a word's presence, once a word; how often each counts."""
        if not len(self.words):
            return np.array([self.presence]), np.zeros(1, np.uint64)
        keys = np.concatenate([*self.keys[: ORDER - 1], np.full(len(self.words), self.presence)])
        if self.times is None:
            return keys, None
        return keys, np.concatenate([*[self.times[e] for e in self.ends[: ORDER - 1]], self.times])

    def hear(self, answers: pa.Table) -> None:
        distinct, _ = _distinct(*self.lower())
        totals = B.answer_to(distinct, answers, 1, self.layout, _numbers)
        if len(self.words):
            self.all_words = int(totals[np.searchsorted(distinct, self.presence)])
        for k in range(ORDER - 1):
            self._note(k, self.ends[k], self.keys[k], distinct, totals)

    def known(self) -> np.ndarray:
        """Words that end a triple of which both pairs stand elsewhere."""
        pair = self.seen[ORDER - 2] > 0
        return self.ends[ORDER - 1] & pair & np.concatenate([[False], pair[:-1]])

    def triples(self) -> tuple[np.ndarray, np.ndarray | None]:
        known = self.known()
        return self.keys[ORDER - 1][known[self.ends[ORDER - 1]]], None if self.times is None else self.times[known]

    def hear_triples(self, answers: pa.Table) -> None:
        keys, _ = self.triples()
        distinct, _ = _distinct(keys)
        if len(distinct):
            self._note(ORDER - 1, self.known(), keys, distinct, B.answer_to(distinct, answers, 2, self.layout, _numbers))

    def _note(self, k: int, ends: np.ndarray, keys: np.ndarray, distinct: np.ndarray, totals: np.ndarray) -> None:
        if ends.any():
            self.seen[k][ends] = _others(keys, self.words.rows[ends], distinct, totals)


def _numbers(answer: bytes, _: int) -> np.ndarray:
    return B.from_planes(answer, np.int64)


def _distinct(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each is there; an entry counts once, or as ``times`` says."""
    if times is not None:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    else:
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if times is not None and len(keys):
        return keys[first], np.add.reduceat(times, first)
    return keys[first], np.diff(np.append(first, len(keys))).astype(np.uint64)


def _others(keys: np.ndarray, rows: np.ndarray, distinct: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """For each n-gram: how often it stands in other documents."""
    order = np.argsort(keys, kind="stable")
    k, r = keys[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])]))
    own = np.diff(np.append(first, len(k)))
    left = totals[np.searchsorted(distinct, k[first])] - own
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(left, own)
    return out


def _scores(ids, grams: _Grams) -> pa.Table:
    words, place, seen = grams.words, grams.place, grams.seen
    n_rows, counts = len(words.counts), words.counts
    rest = np.maximum(grams.all_words - counts, 1)
    log = np.log(np.maximum(seen[0], 1)) - np.log(np.repeat(rest, counts))
    log += np.log(BACKOFF) * np.minimum(place, ORDER - 1)
    level = np.ones(len(words), np.int64)
    for k in range(1, ORDER):
        hit = np.flatnonzero(seen[k] > 0)
        hit = hit[seen[k - 1][hit - 1] > 0]  # always so, but for hashes that meet by chance
        log[hit] = np.log(seen[k][hit] / seen[k - 1][hit - 1])
        log[hit] += np.log(BACKOFF) * (np.minimum(place[hit], ORDER - 1) - k)
        level[hit] = k + 1
    total = np.bincount(words.rows, log, n_rows) + 0.0
    mean = np.divide(total, counts, out=np.zeros(n_rows), where=counts > 0)
    at = [np.bincount(words.rows[level == k], minlength=n_rows) for k in (3, 2, 1)]
    return pa.table({
        "doc_id": ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids,
        "n_words": pa.array(counts, pa.int64()),
        "n_trigrams": pa.array(at[0], pa.int64()),
        "n_bigrams": pa.array(at[1], pa.int64()),
        "n_unigrams": pa.array(at[2], pa.int64()),
        "log_score": pa.array(np.round(total, 6)),
        "mean_log_score": pa.array(np.round(mean, 6), mask=counts == 0),
    })
