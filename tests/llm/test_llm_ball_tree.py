"""Exact top-k search against brute force."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.llm import ball_tree
from parityline.llm.common import shared_path


def brute(data, is_query, k):
    ok = {}
    kept = [
        (i, np.floor(256 * np.array(v, float)).astype(np.int64))
        for i, v in data
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    for i, v in kept:
        if is_query(i) and (i not in ok or tuple(v) < tuple(ok[i])):
            ok[i] = v
    out = []
    for i, q in ok.items():
        found = sorted((-int(q @ v), j) for j, v in kept if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out, key=repr)


def vectors():
    rng = np.random.default_rng(3)
    data = [(i, rng.standard_normal(6).tolist()) for i in range(300)]
    data += [(300 + i, data[i % 7][1]) for i in range(60)]  # ties
    data += [(400 + i, [0.0] * 6) for i in range(40)]
    data += [(450, None), (460, [1.0, None] * 3), (470, [float("nan")] * 6), (480, [float("inf")] * 6)]
    data += [(490, [1.0, 2.0]), (491, [0.5, 0.5]), (500, [2.0]), (None, [1.0] * 6)]
    data += [(10, [3.0] * 6), (10, data[10][1]), (510, [1e6] * 6), (520, [])]
    return data


def test_equals_brute_force_over_many_shards(spark):
    data = vectors()
    frame = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, id int")
    for shard, block in ((40, 4), (10_000, 512)):
        got = ball_tree.nearest(frame, "id % 10 = 0", k=5, shard_rows=shard, block_rows=block)
        assert rows(got) == brute(data, lambda i: i % 10 == 0, 5)


def clusters(rng, n=4000):
    centres = rng.integers(-3000, 3000, (40, 8))
    return (centres[rng.integers(0, 40, n)] + rng.integers(-30, 30, (n, 8))).astype(np.int64)


def best(points, query, own, k):
    return sorted((-int(s), j) for j, s in enumerate(points @ query) if j != own)[:k]


def test_branches_are_left_out_and_nothing_is_lost():
    rng = np.random.default_rng(5)
    points = clusters(rng)
    tree = ball_tree.Tree.of(np.arange(len(points)), points, leaf=16)
    asked = np.arange(0, 4000, 200)
    found, compared = tree.search(asked, points[asked], 5, np.full(len(asked), -np.inf))
    for i, own in zip(asked, found, strict=True):
        assert [(-int(s), int(j)) for s, j in own] == best(points, points[i], i, 5)
    # Each query is compared with a small part of the vectors, and all of them lie in a leaf.
    assert compared < 0.2 * len(asked) * len(points)
    leaves = [r for r, s in zip(tree.ranges, tree.second, strict=True) if not s]
    assert sorted(i for a, b in leaves for i in tree.ids[a:b]) == list(range(len(points)))
    # With the kth scores known from elsewhere, fewer still, and nothing at or above them goes.
    kth = np.array([own[-1, 0] for own in found], float)
    again, fewer = tree.search(asked, points[asked], 5, kth)
    assert fewer < compared
    assert all(np.array_equal(x, y) for x, y in zip(found, again, strict=True))
    none, nothing = tree.search(asked, points[asked], 5, np.full(len(asked), np.inf))
    assert nothing == 0 and all(len(x) == 0 for x in none)


def test_kth_scores_of_earlier_rounds_reach_later_ones(spark, monkeypatch):
    rng = np.random.default_rng(8)
    points = clusters(rng, 1200)
    frame = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    kept = {}
    real = ball_tree.written
    monkeypatch.setattr(ball_tree, "written", lambda df, name: kept.setdefault((name, len(kept)), real(df, name)))
    got = ball_tree.nearest(frame, "id % 40 = 0", shard_rows=60, block_rows=8)
    want = [(i, n + 1, j, -s) for i in range(0, 1200, 40) for n, (s, j) in enumerate(best(points, points[i], i, 5))]
    assert rows(got) == sorted(want, key=repr)
    rounds = [df for (name, _), df in sorted(kept.items(), key=lambda x: x[0][1]) if name == "kth"]
    assert len(rounds) == 2  # one shard, seven more, the rest
    lowest = []
    for files in rounds:
        known = [ball_tree._get(r.kth) for r in files.collect()]
        lowest.append({i: x for k in known for i, x in zip(k["ids"].tolist(), k["least"].tolist(), strict=True)})
    final = {i: s for i, n, _, s in want if n == 5}
    assert all(lowest[0][i] <= lowest[1][i] <= final[i] for i in final)
    assert any(lowest[0][i] < lowest[1][i] for i in final)


def test_shuffled_rows_grow_with_the_table(spark, monkeypatch):
    """What the tasks of a round are sent are names of files, not vectors."""
    plans = []
    real = ball_tree.written
    monkeypatch.setattr(ball_tree, "written", lambda df, name: plans.append((name, df.columns)) or real(df, name))
    frame = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(400)], "vec_id long, embedding array<double>")
    ball_tree.nearest(frame, "id % 10 = 0", shard_rows=50, block_rows=4).count()
    held = [columns for name, columns in plans if name in ("trees", "asked", "kth", "best")]
    assert len(held) >= 5 and all("v" not in c and "vectors" not in c for c in held)


def test_products_beyond_a_long_are_an_error():
    points = np.full((3, 2), 2**40, np.int64)
    tree = ball_tree.Tree.of(np.arange(3), points)
    with pytest.raises(ValueError, match="64 bits"):
        tree.search(np.array([0]), points[:1], 2, np.array([-np.inf]))
    points = np.array([[2**30 + 1, 3], [2**30, 7], [5, 2**30]], np.int64)
    tree = ball_tree.Tree.of(np.arange(3), points)
    found, _ = tree.search(np.array([0]), points[:1], 2, np.array([-np.inf]))
    assert [(-int(s), int(j)) for s, j in found[0]] == best(points, points[0], 0, 2)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ball_tree.nearest(frame, "id % 50 = 0").count() == 0


def test_rows_of_one_id_go_to_all_shards(spark):
    rng = np.random.default_rng(6)
    data = [(7, rng.standard_normal(4).tolist()) for _ in range(200)] + [(7, [1.0] * 4)] * 200
    data += [(10 * i, rng.standard_normal(4).tolist()) for i in range(20)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = ball_tree.nearest(frame, "id % 10 = 0 or id = 7", k=5, shard_rows=40, block_rows=4)
    assert rows(got) == brute(data, lambda i: i % 10 == 0 or i == 7, 5)

    numbered = ball_tree.quantised(frame, "vec_id", "embedding").withColumn("no", F.monotonically_increasing_id())
    trees = ball_tree.planted(numbered, 10, shared_path(spark, "trees"))
    assert max(r.n for r in trees.collect()) < 120
