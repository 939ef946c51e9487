import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stowage.llm import quality_crf as crf
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.1"


def test_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(3)
    lengths = [4, 0, 1, 3, 0, 2]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    evidence, tie = draw.standard_normal(bounds[-1]), draw.standard_normal((2, 2))
    good, pairs = crf.marginals(evidence, bounds, tie)
    want_good, want_pairs = np.zeros(len(evidence)), np.zeros((2, 2))
    for a, b in itertools.pairwise(bounds):
        weights = {y: np.exp(sum(evidence[a + t] * y[t] for t in range(b - a)) + sum(tie[y[t], y[t + 1]] for t in range(b - a - 1)))
                   for y in itertools.product((0, 1), repeat=int(b - a))}
        z = sum(weights.values())
        for y, w in weights.items():
            for t in range(b - a):
                want_good[a + t] += y[t] * w / z
            for t in range(b - a - 1):
                want_pairs[y[t], y[t + 1]] += w / z
    assert np.allclose(good, want_good) and np.allclose(pairs, want_pairs)


def test_features_are_those_of_the_lines():
    lines = crf.Lines(pa.array(["ABC def 12\n\nx x x | | end.", None, "\n", "é É"]))
    assert lines.counts.tolist() == [2, 0, 0, 1]
    first, second = lines.features[0], lines.features[1]
    assert first[:4] == pytest.approx([np.log(4), 3 / 6, 2 / 10, 0])
    assert second[3:6] == pytest.approx([2 / 6, 2 / 6, 3 / 6])  # two bars, alone, and three words that equal the one before


def test_neighbours_count():
    x = np.zeros((4, crf.FEATURES))
    x[1, 0] = 5.0
    design = crf._design(x, np.array([0, 2, 4]))
    assert design[0, 2 * crf.FEATURES] == 5.0  # the line after
    assert design[2, crf.FEATURES] == 0.0  # the line before is in another text


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = crf.score_quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.99
    assert np.mean([r.predicted for r in held if r.quality == 1]) >= 0.99


def test_labels_of_held_out_rows_change_nothing(spark, documents):
    draw = np.random.default_rng(1)
    texts = [("nice plain words here\n" if i % 3 else "BAD!! $$$ ### 99\n") * int(draw.integers(1, 5)) for i in range(90)]
    docs = documents(*enumerate(texts))
    rows = [(i, int(i % 3 > 0)) for i in range(90)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in rows]
    a, b = ({r.doc_id: r.score for r in crf.score_quality(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()}
            for x in (rows, flipped))
    assert a == b
    assert all((a[i] >= 0.7) == (q == 1) for i, q in rows)


def test_odd_rows_and_labels(spark, documents):
    docs = documents(*ODD)
    labels = [(4, 1), (5, 0), (7, 0), (6, 1), (4, None), (None, 1), (9, 7), (99, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    got = crf.score_quality(docs, frame).collect()
    assert len(got) == len(ODD)
    assert all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (1, 2, 8)}) == 1
    none = frame.limit(0)
    assert {r.score for r in crf.score_quality(docs, none).collect()} == {1.0}
    one = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert {r.predicted for r in crf.score_quality(docs, one).collect()} == {1}
    assert crf.score_quality(documents(), frame).collect() == []
    kept = crf.keep_good(docs, none)
    assert kept.schema == docs.schema and kept.count() == len(ODD)
    assert crf.keep_good(documents(), frame).collect() == []


def test_only_good_documents_are_kept(spark, documents):
    docs = documents(*[(i, "fine words, plain.\n" * 3 if i % 2 else "### $$$ !!! ###\n" * 3) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert sorted(r.doc_id for r in crf.keep_good(docs, labels).collect()) == list(range(1, 60, 2))


def rows_on_the_driver(monkeypatch):
    seen, fit = [], crf.fit
    monkeypatch.setattr(crf, "fit", lambda x, bounds, truth: seen.append((len(bounds) - 1, len(x))) or fit(x, bounds, truth))
    return seen


def test_the_sample_is_bounded_whatever_repeats(spark, documents, monkeypatch):
    seen = rows_on_the_driver(monkeypatch)
    docs = spark.range(20_000).selectExpr("id % 2 AS doc_id", "concat('some words\n', id) AS text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 1)], "doc_id long, quality int")
    crf.fit_on_labels(docs, labels, most_docs=2)
    assert seen == [(2, 4)]


def test_all_lines_of_a_sampled_text_count(spark, documents, monkeypatch):
    seen = rows_on_the_driver(monkeypatch)
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2][:4]
    docs = documents(*[(i, "words of a line\n" * 1000) for i in ids])
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    crf.fit_on_labels(docs, labels)
    crf.fit_on_labels(docs, labels, most_lines=2500)
    crf.fit_on_labels(docs, labels, most_lines=10)
    assert seen == [(4, 4000), (2, 2000), (0, 0)]
