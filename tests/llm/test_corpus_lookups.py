"""Language-model scores and substring dedup: both look keys up across the corpus."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from stowage.llm import blocks
from stowage.llm.lm_scoring import score_documents
from stowage.llm.substring_dedup import digest_repeats, remove_repeats
from tests.llm.conftest import ODD


@pytest.fixture(params=["one block", "many blocks"])
def layout(request, monkeypatch):
    """The same results whether there is one block and bucket or many."""
    if request.param == "many blocks":
        of = blocks.Layout.of.__func__
        monkeypatch.setattr(blocks.Layout, "of", classmethod(
            lambda cls, size, keys_per_byte, width, **_: of(cls, size, keys_per_byte, width, block_bytes=400, bucket_keys=64)))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def babble(seed, n, words, vocabulary):
    draw = random.Random(seed)
    return [" ".join(draw.choice("abcdefghijklmnopqrstuvwxyz"[:vocabulary]) for _ in range(draw.randrange(words))) for _ in range(n)]


def expected_scores(texts):
    grams = [[Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for k in (1, 2, 3)] for w in map(words_of, texts)]
    totals = [sum((g[k] for g in grams), Counter()) for k in range(3)]
    every = sum(totals[0].values())
    out = []
    for text, own in zip(texts, grams, strict=True):
        w = words_of(text)
        seen = lambda g: totals[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: E731, B023
        total, levels = 0.0, Counter()
        for i in range(len(w)):
            scale = 0.0
            for k in range(min(i, 2), -1, -1):
                gram = tuple(w[i - k : i + 1])
                if k and seen(gram):
                    total += scale + math.log(seen(gram) / seen(gram[:-1]))
                elif not k:
                    total += scale + math.log(max(seen(gram), 1) / max(every - len(w), 1))
                else:
                    scale += math.log(0.4)
                    continue
                levels[k] += 1
                break
        out.append((len(w), levels[2], levels[1], levels[0], total))
    return out


def test_scores_are_those_of_the_formula(documents, layout):
    texts = babble(1, 40, 60, 12) + babble(2, 5, 20, 3)
    got = {r.doc_id: r for r in score_documents(documents(*enumerate(texts))).collect()}
    for i, (n, three, two, one, total) in enumerate(expected_scores(texts)):
        r = got[i]
        assert (r.n_words, r.n_trigrams, r.n_bigrams, r.n_unigrams) == (n, three, two, one)
        assert r.log_score == pytest.approx(total, abs=2e-6)
        assert r.mean_log_score == (None if not n else pytest.approx(total / n, abs=2e-6))


def test_scores_of_odd_rows(documents):
    got = score_documents(documents(*ODD)).collect()
    assert len(got) == len(ODD)
    assert all((r.n_words > 0) == (r.mean_log_score is not None) for r in got)
    assert {r.doc_id: r.log_score for r in got if r.n_words == 0} == {1: 0, 2: 0, 3: 0, 8: 0, None: 0}
    assert len({r.log_score for r in got if r.doc_id == 4}) == 1
    assert score_documents(documents()).collect() == []


def test_equal_rows_are_counted_together_and_scored_apart(documents, layout):
    """As many copies as there are: by the formula over all rows, whatever a task joins."""
    texts = [*babble(3, 12, 40, 8), *babble(4, 2, 30, 4) * 30, *[""] * 20]
    rows = [(i if i < 12 else 100 + len(t), t) for i, t in enumerate(texts)]
    got = Counter((r.doc_id, r.n_words, r.n_trigrams, r.n_bigrams, r.n_unigrams, round(r.log_score, 4))
                  for r in score_documents(documents(*rows).repartition(3)).collect())
    want = Counter((d, n, three, two, one, round(total, 4))
                   for (d, _), (n, three, two, one, total) in zip(rows, expected_scores(texts), strict=True))
    assert got == want


def test_texts_without_words_add_none_to_the_corpus(documents, layout):
    texts = ["a b c", None, None, "c d"]
    got = {r.doc_id: r.log_score for r in score_documents(documents(*[(i, t) for i, t in enumerate(texts)])).collect()}
    assert [got[i] for i in range(4)] == [pytest.approx(e[-1], abs=2e-6) for e in expected_scores(texts)]


@pytest.mark.parametrize("row", [(7, "five words that come often " * 4), (None, None)])
def test_a_hot_row_reaches_its_block_joined(spark, row):
    """10^5 equal rows are one for each task that reads them, with their number; results are for all."""
    from pyspark.sql import functions as F

    hot = spark.range(0, 100_000, 1, 4).select(
        F.lit(row[0]).cast("long").alias("doc_id"), F.lit(row[1]).cast("string").alias("text"))
    frame = hot.unionByName(spark.createDataFrame([(1, "other words here"), (9, "that come often and more")], hot.schema))
    layout = blocks.Layout.of(blocks.text_bytes(frame), 0.2, 6)
    dealt = blocks.with_blocks(frame, layout)
    sizes = {r[blocks.BLOCK]: (r.n, r.all) for r in
             dealt.groupBy(blocks.BLOCK).agg(F.count("*").alias("n"), F.sum(blocks.TIMES).alias("all")).collect()}
    assert sum(a for _, a in sizes.values()) == 100_002
    assert max(n for n, _ in sizes.values()) <= 6
    got = score_documents(frame).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("log_score").alias("k")).collect()
    assert {r.doc_id: (r.n, r.k) for r in got} == {row[0]: (100_000, 1), 1: (1, 1), 9: (1, 1)}
    left = remove_repeats(frame.withColumn("x", F.lit(0.5)))
    assert {r.doc_id: r.n for r in left.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {row[0]: 100_000, 1: 1, 9: 1}
    assert left.filter(~F.col("text").eqNullSafe(F.lit(row[1]))).count() == 2


def test_rows_that_differ_in_a_carried_column_stay_apart(documents):
    rows = [(1, "same text"), (1, "same text"), (1, "same text")]
    frame = documents(*rows)  # they differ in their clashing columns
    assert sorted(tuple(r) for r in remove_repeats(frame).collect()) == sorted(tuple(r) for r in frame.collect())
    twice = frame.unionByName(frame).coalesce(1)
    assert sorted(tuple(r) for r in remove_repeats(twice).collect()) == sorted(2 * [tuple(r) for r in frame.collect()])


def expected_repeats(rows):
    first = {}
    for d, text in rows:
        w = words_of(text)
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, text in rows:
        w = words_of(text)
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[d] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeats_are_those_of_all_windows(documents, layout, seed):
    draw = random.Random(seed)
    rare = babble(seed, 12, 80, 26)
    parts = [" ".join(f"w{draw.randrange(500)}" for _ in range(draw.choice([8, 12, 13, 14, 19, 40]))) for _ in range(12)]
    texts = [" ".join(draw.choice([*parts, *rare, "z" * draw.randrange(9)]) for _ in range(draw.randrange(6))) for _ in range(40)]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in digest_repeats(documents(*rows)).collect()}
    assert got == expected_repeats(rows)


def test_cover_meets_at_every_shift():
    from stowage.llm.substring_dedup import COVER, PERIOD
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_repeats_of_odd_rows(documents):
    got = digest_repeats(documents(*ODD)).collect()
    assert len(got) == len(ODD)
    assert all(r.n_removed == 0 for r in got)
    assert digest_repeats(documents()).collect() == []
    long = " ".join(f"w{i}" for i in range(20))
    rows = [(2, long), (2, long), (None, long), (None, "fresh " + long), (1, "short")]
    got = sorted((r.doc_id or 0, r.n_removed) for r in digest_repeats(documents(*rows)).collect())
    assert got == [(0, 20), (0, 20), (1, 0), (2, 0), (2, 0)]


def test_cut_texts_keep_their_layout_and_columns(documents):
    passage = "\n".join(f"p{i}" for i in range(13))
    frame = documents((1, passage), (2, f"  Before\t {passage}  after,\n  end "), (3, passage), (4, None), (5, "  as\n it is  "))
    out = remove_repeats(frame)
    assert out.schema == frame.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: passage, 2: "  Before\t after,\n  end ", 3: "", 4: None, 5: "  as\n it is  "}
    assert {r.doc_id: r.bucket for r in out.collect()} == {r.doc_id: r.bucket for r in frame.collect()}


def test_columns_named_like_working_ones_are_carried(documents):
    rows = [(1, " ".join(f"w{i}" for i in range(20))), (2, " ".join(f"w{i}" for i in range(25))), (3, None)]
    frame = documents(*rows)
    wide = frame.withColumns({"__block": frame.n_words, "a.b": frame.n_words, "carried0": frame.n_words})
    out = remove_repeats(wide)
    assert out.columns == wide.columns
    got = {r.doc_id: r for r in out.collect()}
    assert all(r["__block"] == r["a.b"] == r["carried0"] == r.n_words for r in got.values())
    assert got[2].text.split() == [f"w{i}" for i in range(20, 25)] and got[3].text is None
