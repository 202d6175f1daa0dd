import numpy as np
import pytest
from pyspark.sql import functions as F

from quaybook.llm import box_tree

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 1) for i, v, label in rows], SCHEMA)


def brute(rows, is_anchor, positives=5, negatives=5, window=(80, 100, 100)):
    kept = {(i, tuple(v), label) for i, v, label in rows if i is not None and label is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)}
    kept = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in kept]
    out = []
    for a, va, la in kept:
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in kept if i != a and len(v) == len(va)]
        for s, p, _ in sorted(x for x in scored if x[2] == la)[:positives]:
            hits = sorted((t, i) for t, i, label in scored if label != la
                          and window[0] * -s <= window[2] * -t <= window[1] * -s)[:negatives]
            out += [(a, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(hits)]
    return sorted(out)


def found(spark, rows, every=10, **options):
    return sorted(tuple(r) for r in box_tree.mine(frame(spark, rows), F.col("vec_id") % every == 0, **options).collect())


def table(n, dim, labels, seed, decimals=2):
    """Few different values, so scores tie."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dim))
    return [(i, np.round(centres[i % labels] * 0.3 + rng.standard_normal(dim) * 0.4, decimals).tolist(), int(rng.integers(labels)))
            for i in range(n)]


@pytest.mark.parametrize("n,dim,labels,decimals", [(400, 4, 3, 0), (600, 16, 5, 2), (80, 2, 9, 1), (50, 2, 40, 1)])
def test_brute_force(spark, n, dim, labels, decimals, monkeypatch):
    monkeypatch.setattr(box_tree, "LEAF", 8)
    rows = table(n, dim, labels, n, decimals)
    want = brute(rows, lambda i: i % 10 == 0)
    assert found(spark, rows, shard_bytes=8 * dim * 90, block=7) == want and (want or labels == 40)
    assert found(spark, rows) == want  # one shard, one block


def test_nulls_repeats_lengths_and_hot_vectors(spark):
    rows = table(120, 3, 3, 1, 1)
    rows += rows[:30] + [(500 + i, rows[10][1], i % 2) for i in range(200)]  # a hot vector under two labels
    rows += [(10, [9.0, 9.0, 9.0], 1), (20, None, 1), (30, [1.0, None, 2.0], 1), (40, [float("nan"), 0.0, 0.0], 1),
             (None, [5.0, 5.0, 5.0], 1), (50, [1.0, 1.0, 1.0], None), (60, [], 1), (61, [], 1), (62, [], 2),
             (70, [1.0, 2.0], 0), (71, [2.0, 1.0], 0), (72, [2.0, 0.9], 1), (73, [float("inf")] * 3, 1)]
    assert found(spark, rows, shard_bytes=2000, block=3) == brute(rows, lambda i: i % 10 == 0)


def test_scores_beyond_doubles(spark):
    rows = [(i, [1e5 + i, 1e6 - i, 2e5], i % 2) for i in range(60)]
    assert found(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_negative_positives_have_no_window(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.9, 0.0], 1), (3, [0.0, 0.0], 1)]
    assert found(spark, rows) == []


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1)]) == []  # no anchor
    assert found(spark, [(10, [1.0], 1)]) == []  # no other row


def test_tree_packing_and_bounds(monkeypatch):
    rng = np.random.default_rng(2)
    points = np.floor(rng.standard_normal((3000, 5)) * 50)
    tree = box_tree.BoxTree.packed(np.arange(3000), rng.integers(0, 4, 3000), points, 16)
    assert sorted(tree.ids) == list(range(3000)) and np.diff(tree.bounds).max() <= 16
    assert all(len(set(tree.labels[a:b])) == 1 for a, b in zip(tree.bounds, tree.bounds[1:]))
    assert len(tree.levels[-1][0]) == 1
    search = box_tree.AnchorSearch(tree, points[7], 7, 9)
    first, lows, highs, *_ = search._children(1, 0)
    for child in range(len(lows)):
        scores = search._scores(first + child)
        assert lows[child] <= scores.min() and scores.max() <= highs[child]


def test_far_boxes_are_not_scored():
    rng = np.random.default_rng(4)
    centres = np.array([[100, 0, 0], [0, 100, 0], [0, 0, 100], [-100, 0, 0]])
    points = np.floor(centres[np.arange(4000) % 4] * 8 + rng.standard_normal((4000, 3)) * 3)
    tree = box_tree.BoxTree.packed(np.arange(4000), np.zeros(4000, dtype=np.int64), points, 32)
    search = box_tree.AnchorSearch(tree, points[0], 0, 0)
    assert len(search.best(5, True)) == 5
    assert len(search.scored) < (len(tree.bounds) - 1) / 4


def test_parts_of_anchors_and_groups_of_shards(spark, monkeypatch):
    monkeypatch.setattr(box_tree, "HELD_BYTES", 2000)
    monkeypatch.setattr(box_tree, "PACK", 5)
    monkeypatch.setattr(box_tree, "TILE_ROWS", 60)
    rows = table(500, 4, 4, 3, 1)
    assert found(spark, rows, 5, shard_bytes=8 * 4 * 40, block=6) == brute(rows, lambda i: i % 5 == 0)


def test_no_copies_of_anchors_are_broadcast(spark, monkeypatch):
    """A join of anchors with shards was planned by the size of the anchors'
    files, and broadcast a copy of them for each shard."""
    plans = []
    write = box_tree.write_stage

    def planned(df, *_):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(box_tree, "write_stage", lambda df, name: (planned(df), write(df, name))[1])
    rows = table(200, 3, 3, 1, 1)
    planned(box_tree.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, shard_bytes=300))
    assert len(plans) == 5 and not any("Broadcast" in p for p in plans)
    assert "Join" not in plans[-1]


def test_trees_of_several_kinds(spark):
    """Scores below 2**24, 2**53 and beyond meet in one list."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(1, 40, 3) * [1.0, 300.0, 1e5][i % 3 if i > 60 else 0]).tolist(), int(rng.integers(3)))
            for i in range(240)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert max(s for *_, s, _ in want) > 2**53 > min(s for *_, s, _ in want)
    assert found(spark, rows, shard_bytes=8 * 3 * 12, block=4) == want == found(spark, rows)


def test_floats_stay_floats(spark):
    rows = [(i, np.float32(v).astype(float).tolist(), label) for i, v, label in table(300, 6, 4, 9)]
    df = frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert sorted(tuple(r) for r in box_tree.mine(df, F.col("vec_id") % 10 == 0, shard_bytes=3000).collect()) == brute(
        rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("labels", [1, 4, 900])
def test_a_block_finds_what_its_anchors_find(labels):
    rng = np.random.default_rng(labels)
    points = np.floor(rng.standard_normal((900, 6)) * 9)
    ids, label = np.arange(900) // 2, rng.permutation(900) % labels
    tree = box_tree.BoxTree.packed(ids, label, points, 16)
    at = rng.permutation(900)[:40]
    low, high = np.tile([[-np.inf, 20.0, 60.0]], (40, 1)), np.tile([[np.inf, 90.0, 61.0]], (40, 1))
    for same in (True, False):
        best = box_tree.Best(4, low, high)
        box_tree.AnchorSearch(tree, points[at], ids[at], label[at]).look(best, same)
        for a, row in enumerate(at):
            scores = points @ points[row]
            for w in range(3):
                fits = ((label == label[row]) == same) & (ids != ids[row]) & (scores >= low[a, w]) & (scores <= high[a, w])
                want = sorted((-scores[i], ids[i]) for i in np.flatnonzero(fits))[:4]
                got = [(-s, i) for s, i in zip(best.scores[a, w], best.ids[a, w]) if s > -np.inf]
                assert got == want
