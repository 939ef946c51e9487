"""Document quality by a linear-chain conditional random field over lines.

Every line (a run of bytes without line feeds) is good or bad. A line's evidence is a
weighted sum of features of itself and of the lines before and after it; neighbouring
labels are tied by a transition weight. Forward-backward gives each line's probability
of being good, and a document's quality is their mean, weighted by the lines' lengths.

Weights are fitted by maximum likelihood, where all lines of a labelled document bear
its label, on a bounded sample of labelled documents: in the order of a hash of the id, at most
``MOST_DOCS``, and as many as have ``MOST_LINES`` lines together. Of each all lines are
used, and scoring reads whole texts. Fitting is done on the driver, with the features of the sample
only: at its bounds they are 10 MB there for 10^5 lines, some ten times that while it fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stowage.llm.shared import scratch_root, stored
from stowage.llm.text import SPACES, Words, slices, text_buffer

MOST_DOCS = 6000
MOST_LINES = 400_000
THRESHOLD = 0.7
FEATURES = 9
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LETTER = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0xC0)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_STOP = np.isin(_BYTES, [ord(c) for c in ".,;:?'\"-()"])
_SYMBOL = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_LETTER & ~_DIGIT & ~_STOP


class Lines:
    """The lines of a column of texts, with their features (rows of ``features``)."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        data, offsets = text_buffer(texts)
        lines = Words(data, offsets, _BYTES != 0x0A)
        words = Words(data, offsets, ~SPACES)
        self.bounds, self.counts, self.rows = lines.bounds, lines.counts, lines.rows
        self.lengths = lines.ends - lines.starts
        first = np.searchsorted(words.starts, lines.starts)
        n_words = np.searchsorted(words.starts, lines.ends) - first

        def per_line(at: np.ndarray, of: np.ndarray) -> np.ndarray:
            total = np.zeros(len(at) + 1, np.int64)
            np.cumsum(at, out=total[1:])
            return (total[lines.ends] - total[lines.starts]) / np.maximum(of, 1)

        def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
            return per_line(kind[data], of)

        signs = np.zeros(len(data), bool)  # words of one symbol, as between the cells of a table
        one = words.starts[words.ends - words.starts == 1]
        signs[one] = _SYMBOL[data[one]]

        h = words.hashes()
        same = np.zeros(len(h) + 1, np.int64)
        if len(h):
            same[2:] = np.cumsum(h[1:] == h[:-1])  # same[i]: words below i that equal the word before
        inner = np.minimum(first + 1, first + n_words)
        self.features = np.column_stack([
            np.log1p(n_words),
            share(_UPPER, share(_LETTER, np.ones(1))),
            share(_DIGIT, self.lengths),
            np.minimum(share(_SYMBOL, n_words), 1.0),
            per_line(signs, n_words),
            (same[first + n_words] - same[inner]) / np.maximum(n_words, 1),
            self.lengths / np.maximum(n_words, 1) / 10.0,
            share(_STOP, n_words),
            n_words == 0,
        ]).astype(np.float64)


@dataclass(frozen=True)
class Model:
    """Weights of a fitted field. ``prior`` is the score of a document without lines."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of a line's own features, of its neighbours', and a constant
    tie: np.ndarray  # 2 x 2 weights of neighbouring labels
    prior: float

    def evidence(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return _design((x - self.mean) / self.scale, bounds) @ self.weights


def _design(z: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero where there is none), and 1."""
    before, after = np.zeros_like(z), np.zeros_like(z)
    before[1:], after[:-1] = z[:-1], z[1:]
    heads, tails = bounds[:-1], bounds[1:] - 1
    some = bounds[1:] > bounds[:-1]
    before[heads[some]] = 0
    after[tails[some]] = 0
    return np.hstack([z, before, after, np.ones((len(z), 1))])


def marginals(evidence: np.ndarray, bounds: np.ndarray, tie: np.ndarray):
    """P(good) of each line, and the expected number of each pair of neighbouring labels.

    ``evidence`` is the log weight of good against bad. All chains go forward together,
    a line a step, longest first, so that a step takes those that are still running.
    """
    n = len(evidence)
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    lengths, heads = counts[order], bounds[:-1][order]
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(longest), "left")  # chains longer than t
    node = np.zeros((n, 2))
    node[:, 1] = evidence
    forward, backward = node.copy(), np.zeros((n, 2))
    for t in range(1, longest):
        at = heads[: running[t]] + t
        forward[at] += np.logaddexp(forward[at - 1, 0:1] + tie[0], forward[at - 1, 1:2] + tie[1])
    for t in range(longest - 2, -1, -1):
        at = heads[: running[t + 1]] + t
        ahead = node[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(tie[:, 0] + ahead[:, 0:1], tie[:, 1] + ahead[:, 1:2])
    both = forward + backward
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    inner = np.ones(n, bool)
    inner[bounds[:-1][counts > 0]] = False
    at = np.flatnonzero(inner)
    log_z = np.logaddexp(both[at, 0], both[at, 1])
    pairs = np.exp(forward[at - 1][:, :, None] + tie + (node[at] + backward[at])[:, None, :] - log_z[:, None, None])
    return good, pairs.sum(0) if len(at) else np.zeros((2, 2))


def fit(x: np.ndarray, bounds: np.ndarray, quality: np.ndarray, rounds: int = 300, ridge: float = 0.5) -> Model:
    """Fit by gradient steps with momentum and per-weight scaling (Adam), with a ridge.

    Without labelled documents nothing is known to be bad, and every score is 1. With
    one class only, every score is the smoothed share of good documents.
    """
    n = len(quality)
    size = 3 * FEATURES + 1
    prior = 1.0 if n == 0 else float((quality.sum() + 1) / (n + 2))
    flat = Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(size), np.zeros((2, 2)), prior)
    if n == 0 or quality.min() == quality.max() or not len(x):
        return flat
    mean, scale = x.mean(0), x.std(0) + 1e-6
    design = _design((x - mean) / scale, bounds)
    counts = np.diff(bounds)
    truth = np.repeat(quality, counts).astype(float)
    inner = np.maximum(counts - 1, 0)
    tied = np.diag([inner[quality == 0].sum(), inner[quality == 1].sum()]).astype(float)
    theta, m, v = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, rounds + 1):
        tie = theta[size:].reshape(2, 2)
        good, pairs = marginals(design @ theta[:size], bounds, tie)
        gradient = np.concatenate([design.T @ (truth - good), (tied - pairs).ravel()]) / n
        gradient -= ridge * theta / n * 10
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[:size], theta[size:].reshape(2, 2), prior)


def held_out(doc_id):
    """Whether a document's labels are kept from fitting: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, most_lines: int = MOST_LINES) -> Model:
    """Fit on the labelled documents that are not held out.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1; rows with anything else are not
    used). A document labelled twice counts with its lower label. Rows that repeat an id
    are one document, with the smallest of their texts. No more than ``most_docs`` rows with no more
    than ``most_lines`` lines reach the driver, whatever repeats.
    """
    chosen = (
        labels.filter(labels["quality"].isin(0, 1) & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most most_docs rows of two numbers
    sample = sample.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    sample = sample.withColumn("lines", F.coalesce(F.regexp_count("text", F.lit(r"[^\n]+")), F.lit(0)).cast("long"))
    sample = stored(sample, f"{scratch_root(docs.sparkSession)}/sample")
    in_order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # over at most most_docs rows of two numbers
    upto = sample.select("doc_id", F.sum("lines").over(in_order).alias("upto")).filter(F.col("upto") <= most_lines)
    sample = sample.drop("lines").join(upto.select("doc_id"), "doc_id", "left_semi")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines = Lines(batch.column("text"))
            rows = [lines.features[a:b].astype(np.float32).tobytes() for a, b in zip(lines.bounds[:-1], lines.bounds[1:], strict=True)]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("quality"), pa.array(rows, pa.binary())],
                                  names=["doc_id", "quality", "x"])

    got = sample.mapInArrow(features, "doc_id long, quality int, x binary").toArrow().sort_by("doc_id")
    x = [np.frombuffer(b.as_py(), np.float32).reshape(-1, FEATURES) for b in got["x"]]
    bounds = np.concatenate([[0], np.cumsum([len(part) for part in x])]).astype(np.int64)
    whole = np.concatenate(x).astype(float) if x else np.zeros((0, FEATURES))
    return fit(whole, bounds, got["quality"].to_numpy())


def score_lines(texts: pa.Array | pa.ChunkedArray, model: Model) -> tuple[Lines, np.ndarray]:
    """All lines of the texts, and P(good) of each."""
    lines = Lines(texts)
    good, _ = marginals(model.evidence(lines.features, lines.bounds), lines.bounds, model.tie)
    return lines, good


def score_texts(texts: pa.Array | pa.ChunkedArray, model: Model) -> np.ndarray:
    """The quality of each text."""
    lines, good = score_lines(texts, model)
    if not model.weights.any():
        return np.full(len(lines.counts), model.prior)
    n = len(lines.counts)
    weight = np.bincount(lines.rows, lines.lengths, n)
    total = np.bincount(lines.rows, lines.lengths * good, n)
    out = np.full(n, model.prior)
    some = weight > 0
    out[some] = np.clip(total[some] / weight[some], 0.0, 1.0)
    return out


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (``doc_id``, ``text``); other columns are not read.

    One row per input row: ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a
    score of 0.7 on). A text that is null, empty or only line feeds has no lines and
    scores the share of good documents in the sample. A row without an id is scored and
    is not held out. Rows that repeat get equal scores. Empty ``docs`` give no rows;
    with empty ``labels`` every score is 1.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    model = fit_on_labels(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = score_texts(batch.column("text"), model)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                                   pa.array((scores >= THRESHOLD).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])

    return docs.withColumn("held_out", held_out(docs["doc_id"])).mapInArrow(score, SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose predicted quality is good, with all their columns."""
    model = fit_on_labels(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]), labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(score_texts(batch.column("text"), model) >= THRESHOLD))

    return docs.mapInArrow(good, docs.schema)
