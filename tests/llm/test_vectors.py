import numpy as np
import pytest

from stowage.llm import collision_counting as cc
from stowage.llm import cross_polytope as cp

ODD = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 8, 1), (1003, [1.0, None] * 4, 1), (1004, [float("nan")] + [1.0] * 7, 1),
       (1005, [float("inf")] + [1.0] * 7, 1), (None, [1.0] * 8, 1)]
SCHEMA = "vec_id long, embedding array<double>, label int, score double, id long, n long, bucket int, links long, component long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 0.0, 1, 2, 3, 4, 5)
                                  for i, v, label in rows], SCHEMA)


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(1).standard_normal((20, 24))
    y = cp.rotate(x, 3)
    assert y.shape == (20, 32)
    assert np.allclose(y @ y.T, x @ x.T)
    assert not np.allclose(cp.rotate(x, 4), y)
    assert cp.axes(x, 0, 999).shape == (20, 64)
    near = cp.axes(x, 0, 1)
    z = cp.rotate(x, 0)
    assert (np.abs(z).argmax(1) == near[:, 0] % 32).all()


@pytest.mark.parametrize("rows_per_block", [4096, 16])
def test_neighbours_have_the_recall_asked_for(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(cp, "BLOCK_ROWS", rows_per_block)
    draw = np.random.default_rng(5)
    x = draw.standard_normal((400, 24)) * draw.uniform(0.5, 2, (400, 1))
    x[50:90] = x[50]  # ties
    vectors = frame(spark, [(i, v, 0) for i, v in enumerate(x.tolist())] + ODD)
    got = cp.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=10).collect()
    found = total = 0
    for q in range(0, 400, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        scores = x @ x[q]
        assert all(r.vec_id != q and r.score == pytest.approx(scores[r.vec_id]) for r in mine)
        scores[q] = -np.inf
        found += len({r.vec_id for r in mine} & set(np.lexsort((np.arange(400), -scores))[:10].tolist()))
        total += 10
    assert len(got) == total
    assert found / total >= 0.9


def test_few_candidates_all_come(spark):
    x = np.eye(8).tolist()
    rows = [(i, v, 0) for i, v in enumerate(x)] + [(3, [2.0] * 8, 0), (20, [1.0, 2.0], 0), (40, [3.0, 4.0], 0), (60, [5.0], 0)] + ODD
    vectors = frame(spark, rows)
    got = cp.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)
    by = {q: [(r.vec_id, r.score) for r in got.filter(f"query_id = {q}").orderBy("rank").collect()] for q in (0, 20, 40, 60)}
    assert by == {0: [(3, 2.0)] + [(i, 0.0) for i in (1, 2, 4, 5, 6, 7)], 20: [(40, 11.0)], 40: [(20, 11.0)], 60: []}
    assert cp.nearest(vectors.limit(0), vectors.limit(0)).collect() == []


def by_hand(rows, threshold):
    n = len(rows)
    unit = [None if label is None or i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v)
            else np.array(v) / np.linalg.norm(v) for i, v, label in rows]
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
              and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= threshold] for i in range(n)]
    low = [r[0] for r in rows]
    while True:
        best = {}
        for i, r in enumerate(rows):
            near = [low[i], *(low[j] for j in links[i])]
            if r[0] is not None:
                best[r[0]] = min([best.get(r[0], r[0]), *near])
        new = [best.get(r[0]) if r[0] is not None else None for r in rows]
        new = [new[i] if not links[i] else min([new[i], *(new[j] for j in links[i])]) for i in range(n)]
        if new == low:
            return [(r[0], len(links[i]), low[i]) for i, r in enumerate(rows)]
        low = new


@pytest.mark.parametrize("rows_per_block", [1024, 7])
def test_links_are_those_of_all_pairs(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(cc, "BLOCK_ROWS", rows_per_block)
    draw = np.random.default_rng(9)
    base = draw.standard_normal((25, 16))
    x = [base[draw.integers(25)] + draw.standard_normal(16) * draw.choice([0.0, 0.1, 0.25, 0.35]) for _ in range(150)]
    rows = [(int(i), v.tolist(), int(draw.integers(2))) for i, v in zip(draw.permutation(150), x, strict=True)]
    rows += [(200, rows[0][1], None), (201, [2 * c for c in rows[1][1]], rows[1][2]), (202, [1.0, 0.0], 0), (203, [1.0, 0.1], 0), *ODD]
    got = cc.near_vectors(frame(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted(by_hand(rows, 0.93), key=str)
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in got)
    assert cc.near_vectors(frame(spark, [])).collect() == []


def test_repeated_rows_of_vectors(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (9, [0.0, 1.0], 1)]
    got = sorted(tuple(r) for r in cc.near_vectors(frame(spark, rows)).collect())
    assert got == [(3, 2, 3, True), (5, 1, 3, False), (5, 2, 3, False), (5, 2, 3, False), (9, 1, 3, False)]


def test_count_is_calibrated():
    draw = np.random.default_rng(2)
    a = draw.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = draw.standard_normal((400, 64))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * side  # pairs exactly at the threshold
    p = cc.lines(64)
    counts = cc.collisions(a @ p, b @ p, cc.WINDOW * np.sqrt(2 - 2 * 0.93))
    assert np.diag(counts).mean() == pytest.approx(32 * cc.WITHIN, abs=1.0)
    assert (np.diag(counts) >= cc.needed()).all()
    far = counts[~np.eye(400, dtype=bool)]
    assert (far >= cc.needed()).mean() < 0.05
    brute = (np.abs((a @ p)[:, None] - (b @ p)[None]) <= cc.WINDOW * np.sqrt(2 - 2 * 0.93)).sum(2)
    assert (counts == brute).all()


@pytest.mark.parametrize("kind, labels", [
    ("string", ["a", "A", "a ", None]), ("double", [1.2, 1.7, float("nan"), None]), ("long", [2**40, 2**40 + 1, -1, None]), ("boolean", [True, False, True, None])])
def test_labels_are_compared_as_they_are(spark, kind, labels):
    rows = [(10 * k + i, [1.0, 0.1 * i], label) for k, label in enumerate(labels) for i in range(3)]
    vectors = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cc.near_vectors(vectors).collect()}
    several = kind == "boolean"
    assert all(got[10 * k + i] == ((5, 0) if several and k != 1 else (2, 10 * k)) for k in range(3) for i in range(3))
    assert all(got[30 + i] == (0, 30 + i) for i in range(3))
