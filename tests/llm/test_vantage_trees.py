"""Vantage-point trees against brute force."""

import numpy as np
import pytest

from tierstone.llm import vantage_trees as v


def brute(ids, vectors, query, own, k):
    q, x = np.array(query, float), np.array(vectors, float)
    score = (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))
    rows = sorted((-s, i) for s, i in zip(score, ids) if i != own)[:k]
    return [(i, -s) for s, i in rows]


@pytest.fixture(scope="module")
def clustered():
    random = np.random.default_rng(3)
    centres = random.normal(size=(40, 16))
    x = centres[random.integers(40, size=3000)] + 0.2 * random.normal(size=(3000, 16))
    x[100:160] = x[100]
    return np.arange(3000) * 3, np.round(x, 3)


def test_factor_one_is_exact_and_ties_go_to_the_smaller_id(clustered):
    ids, x = clustered
    asked = np.r_[0:50, 100:110]
    who, near, score = v.search_shard(ids, x, ids[asked], x[asked], 5, 1.0)
    for i in asked:
        want = brute(ids, x, x[i], ids[i], 5)
        rows = near[who == ids[i]]
        assert rows.tolist() == [w for w, _ in want]
        assert np.allclose(score[who == ids[i]], [s for _, s in want], atol=1e-12)


def test_recall_of_the_default_factor(clustered):
    ids, x = clustered
    asked = np.arange(0, 3000, 50)
    for factor in (v.FACTOR, 3.0):
        who, near, _ = v.search_shard(ids, x, ids[asked], x[asked], 5, factor)
        hits = sum(len(set(near[who == ids[i]]) & {w for w, _ in brute(ids, x, x[i], ids[i], 5)}) for i in asked)
        assert hits >= 0.9 * 5 * len(asked)


def test_search_over_shards(spark, clustered):
    ids, x = clustered
    rows = [(int(i), r.tolist(), 1, "x") for i, r in zip(ids[:600], x[:600])]
    odd = [
        (9001, None, 1, "x"), (9002, [0.0] * 16, 1, "x"), (9003, [float("nan")] * 16, 1, "x"), (9004, [None] * 16, 1, "x"),
        (9005, [float("inf")] + [1.0] * 15, 1, "x"), (9006, [], 1, "x"), (None, [1.0] * 16, 1, "x"), (9050, [1.0, 2.0], 1, "x"), rows[0],
    ]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, dim int, shard string")
    queries = df.where("vec_id % 50 = 0")
    got = v.nearest_neighbours(df, queries, 5, factor=1.0, shard_rows=100).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    asked = [i for i in ids[:600].tolist() if i % 50 == 0]
    assert set(by) == set(asked)  # 9050 has a length of its own and so no candidate
    for i in asked:
        want = brute(ids[:600].tolist(), x[:600], x[i // 3], i, 5)
        assert [a for a, _ in by[i]] == [a for a, _ in want]
    few = spark.createDataFrame(rows[:3], df.schema)
    assert v.nearest_neighbours(few, few.where("vec_id = 0"), 5).count() == 2
    assert v.nearest_neighbours(df.limit(0), queries.limit(0), 5).collect() == []


def test_ties_of_any_number_go_to_the_smaller_id(monkeypatch):
    random = np.random.default_rng(5)
    x = random.normal(size=(400, 8))
    line = np.round(random.normal(size=8), 2)
    scaled = line * 2.0 ** (np.arange(120) % 60)[:, None]  # one direction, 60 lengths
    corners = np.array([[1.0 if i >> b & 1 else -1.0 for b in range(8)] for i in range(256)])  # equal cosines to an axis
    axis = np.zeros((1, 8))
    axis[0, 0] = 1
    vectors = np.concatenate([x, scaled, corners, axis])
    ids = random.permutation(len(vectors)) * 7
    asked = np.r_[0:30, 400:440, len(vectors) - 1]
    for held in (v.HELD, 50):
        monkeypatch.setattr(v, "HELD", held)
        who, near, score = v.search_shard(ids, vectors, ids[asked], vectors[asked], 5, 1.0)
        for i in asked:
            want = brute(ids, vectors, vectors[i], ids[i], 5)
            assert near[who == ids[i]].tolist() == [w for w, _ in want]


def test_values_of_any_magnitude(spark):
    """Squares of these components are beyond what a double holds."""
    vectors = [(1, [1.0, 2.0]), (2, [1e-200, 3e-200]), (3, [2e200, 1e200]), (4, [5e-324, 0.0]), (5, [-1e308, 1e308]), (6, [1.0, 1e-300])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {}
    for r in v.nearest_neighbours(df, df, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 6)))
    small = {1: (1, 2), 2: (1, 3), 3: (2, 1), 4: (1, 0), 5: (-1, 1), 6: (1, 0)}

    def cosine(a, b):
        return (a[0] * b[0] + a[1] * b[1]) / ((a[0] ** 2 + a[1] ** 2) * (b[0] ** 2 + b[1] ** 2)) ** 0.5

    for q, own in got.items():
        want = sorted((-round(cosine(small[q], small[i]), 6), i) for i in small if i != q)
        assert sorted(own) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert len(got) == 6
