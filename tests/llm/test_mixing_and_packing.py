import random
import re
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stowage.llm.best_fit_packing import best_fit, pack_documents
from stowage.llm.source_mixing import mix_sources, repeat_texts
from tests.llm.conftest import ODD

SOURCES = ["b", "a", None, "ä", "B", "z"]


def sized(seed, n, sources=SOURCES, most=60):
    draw = random.Random(seed)
    return [(i, " ".join(["w"] * draw.randrange(most)) + f" d{i}", draw.choice(sources)) for i in range(n)]


def levels(sizes, weights, share, epochs):
    """Targets by giving out in rounds, as the rule says."""
    total, target, open_ = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while open_ and left > 1e-9:
        w = sum(weights[s] for s in open_)
        full = {s for s in open_ if target[s] + left * weights[s] / w >= epochs * sizes[s]}
        if not full:
            for s in open_:
                target[s] += left * weights[s] / w
            break
        for s in full:
            left -= epochs * sizes[s] - target[s]
            target[s] = epochs * sizes[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken_words(documents, seed):
    rows = sized(seed, 300)
    got = mix_sources(documents(*rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted(s for s in sizes if s is not None) + [None]
    want = levels(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = mix_sources(documents(*rows[::-1])).collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again}


@pytest.mark.parametrize(("weights", "share", "epochs"), [((5, 2, 1), 1.5, 2.0), ((1, 7), 0.3, 1.0), ((3, 0), 0.9, 2.0), ((1,), 3.0, 2.0)])
def test_targets_of_many_sources(documents, weights, share, epochs):
    rows = sized(9, 900, [f"s{i:03}" for i in range(250)], 9)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    weighed = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    got = {r.source: r.target for r in mix_sources(documents(*rows), weights, share, epochs).collect()}
    if share > epochs:  # more than can be taken: all are filled
        assert got == {s: epochs * n for s, n in sizes.items()}
        return
    total = share * sum(sizes.values())
    low, high = 0.0, 1e9
    for _ in range(200):  # the level, by halving
        level = (low + high) / 2
        low, high = (level, high) if sum(min(epochs * n, weighed[s] * level) for s, n in sizes.items()) < total else (low, level)
    for s, n in sizes.items():
        assert got[s] == pytest.approx(min(epochs * n, weighed[s] * low))


def test_texts_come_as_often_as_taken(documents):
    rows = sized(5, 80)
    frame = documents(*rows)
    taken = {r.doc_id: (r.taken, r.size) for r in mix_sources(frame).collect()}
    out = repeat_texts(frame)
    assert out.columns == frame.columns
    texts = {d: t for d, t, _ in rows}
    copies = defaultdict(list)
    for r in out.collect():
        copies[r.doc_id].append(r.text)
        assert r.bucket == 3 + r.doc_id  # other columns come along
    for d, (n, size) in taken.items():
        assert sum(len(t.split()) for t in copies[d]) == n
        assert copies[d].count(texts[d]) == n // size


def test_mix_of_odd_rows(documents):
    got = mix_sources(documents(*ODD, (20, "a b c", None), (21, None, "empty source"))).collect()
    assert len(got) == len(ODD) + 2
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert [(r.target, r.taken) for r in got if r.source == "empty source"] == [(0.0, 0)]
    assert [r.taken for r in got if r.doc_id == 20] == [6]  # the smaller source is filled
    assert mix_sources(documents()).collect() == []
    assert repeat_texts(documents()).collect() == []


def tightest(items, capacity):
    """Best fit by looking at every bin."""
    bins, chosen = [], []
    for length, source, cluster in items:
        can = [(capacity - sum(x[0] for x in b), i) for i, b in enumerate(bins)
               if sum(x[0] for x in b) + length <= capacity and not any(x[1] & source or x[2] & cluster for x in b)]
        i = min(can)[1] if can else len(bins)
        if not can:
            bins.append([])
        bins[i].append((length, source, cluster))
        chosen.append(i)
    return chosen


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10), st.sampled_from([0, 1, 2, 4]), st.sampled_from([0, 0, 1, 2])), max_size=30))
def test_best_fit_is_the_tightest_compatible_bin(items):
    assert best_fit(items, 10) == tightest(items, 10)


def test_packing_holds_its_rules(documents):
    draw = random.Random(3)
    rows = sized(9, 150, ["a", "b", "c", None], 50)
    rows += [(1000 + i, "Same  text here\nalways", draw.choice("abc")) for i in range(12)]
    rows += [(2000, "long " * 205, "a"), (2001, "full " * 100, "b")]
    got = pack_documents(documents(*rows), capacity=100, shard_docs=64).collect()
    texts = {d: (t, s) for d, t, s in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.first_word, r.length))
        bins[r.bin_id].append(r)
    for d, (text, _) in texts.items():
        n = len(text.split())
        assert sorted(pieces[d]) == [(at, min(100, n - at)) for at in range(0, n, 100)]
    for held in bins.values():
        assert sum(r.length for r in held) == held[0].bin_length <= 100
        assert sorted(r.place for r in held) == list(range(len(held)))
        known = [r.source for r in held if r.source is not None]
        assert len(known) == len(set(known))
        copies = [re.sub(r"\s+", " ", texts[r.doc_id][0].lower()) for r in held]
        assert len(copies) == len(set(copies))
    assert len(bins) < 150
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, pack_documents(documents(*rows[::-1]), capacity=100, shard_docs=64).collect()), key=str)


def test_packing_odd_rows(documents):
    got = pack_documents(documents(*ODD)).collect()
    assert sum(r.length for r in got) == sum(len((t or "").split()) for _, t in ODD)
    none = [r for r in got if r.length == 0]
    assert len(none) == 5 and all(r.bin_id is None and r.place is None for r in none)
    twice = [r.bin_id for r in got if r.doc_id == 4]
    assert len(twice) == 2 and len(set(twice)) == 2  # copies never share a bin
    assert pack_documents(documents()).collect() == []
    with pytest.raises(ValueError):
        pack_documents(documents(), capacity=0)


def test_working_names_of_the_mix_are_free_for_columns(spark, documents):
    rows = sized(5, 40)
    odd = ["__row", "__size", "__source", "__draw", "__text", "__taken", "__more", "__range0", "__of", "__left", "a.b"]
    frame = documents(*rows)
    plain = Counter(tuple(r) for r in repeat_texts(frame).collect())
    wide = frame.select("*", *[(F.col("n_words") + i).alias(c) for i, c in enumerate(odd)])
    out = repeat_texts(wide)
    assert out.columns == wide.columns
    got = out.collect()
    assert all(tuple(r[len(frame.columns):]) == tuple(r.n_words + i for i in range(len(odd))) for r in got)
    assert Counter(tuple(r[: len(frame.columns)]) for r in got) == plain
    assert Counter(r.doc_id for r in mix_sources(wide).collect()) == Counter(r[0] for r in rows)


def test_equal_rows_are_dealt_to_all_shards(spark):
    one = spark.range(20_000).selectExpr("CAST(7 AS LONG) AS doc_id", "'a b c d' AS text", "'s' AS source")
    none = spark.range(20_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS text", "CAST(NULL AS STRING) AS source")
    got = pack_documents(one.union(none), shard_docs=4096).groupBy(
        "doc_id", F.shiftright("bin_id", 40).alias("shard")).agg(F.count("*").alias("n"), F.count_distinct("bin_id").alias("bins")).collect()
    mine = [r for r in got if r.doc_id == 7]
    assert len(mine) == 10 and sum(r.n for r in mine) == 20_000 and max(r.n for r in mine) < 3000
    assert all(r.bins == r.n for r in mine)  # copies never share a bin
    assert sum(r.n for r in got if r.doc_id is None) == 20_000


def test_many_equal_items_are_packed_at_once():
    begin = time.perf_counter()
    assert best_fit([(5, 1, 1)] * 20_000, 100) == list(range(20_000))
    assert time.perf_counter() - begin < 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0, 1, 2, 4]), st.sampled_from([0, 1, 2])), max_size=40))
def test_a_resumed_search_finds_what_a_whole_one_finds(items):
    items = sorted(items, reverse=True)
    want, bins = [], []
    for length, source, cluster in items:
        fits = [(room, b) for b, (room, s, c) in enumerate(bins) if room >= length and not (s & source or c & cluster)]
        if fits:
            _, b = min(fits)
        else:
            b = len(bins)
            bins.append((10, 0, 0))
        room, s, c = bins[b]
        bins[b] = (room - length, s | source, c | cluster)
        want.append(b)
    assert best_fit(items, 10) == want
