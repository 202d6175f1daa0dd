"""Embedding links against brute force."""
import numpy as np

from quaybook.llm import flat_graph as G

SCHEMA = "vec_id long, embedding array<float>, label int, n int"


def brute(rows):
    ok = [(i, np.asarray(v, dtype=float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = {}, {i: i for i, _ in ok}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in ok:
        links.setdefault(a, 0)
        for b, y in ok:
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[a] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (links.get(i, 0), find(i) if i in root else i) for i, _ in rows}


def test_groups_parts_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(G, "SHARD", 60)
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for size, noise in ((120, 0.02), (40, 0.03), (5, 0.02), (2, 0.01)):
        base = rng.normal(0, 1, 32)
        for _ in range(size):
            rows.append((at, (base + noise * np.linalg.norm(base) / 5.6 * 3 * rng.normal(0, 1, 32)).tolist()))
            at += 1
    rows += [(at + i, rng.normal(0, 1, 32).tolist()) for i in range(250)]
    rows += [(900, rows[0][1]), (901, [0.0] * 32), (902, None), (903, [None] + [1.0] * 31), (904, [float("nan")] * 32),
             (905, [float("inf")] * 32), (906, []), (907, [1.0, 2.0]), (908, [2.0, 4.0])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(3)
    got = {r.vec_id: r for r in G.near_duplicates(df).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())  # no link below the threshold
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert np.mean([got[i].component_id == c for i, (_, c) in want.items()]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    audit = G.audit(df, G.near_duplicates(df)).first()
    assert audit.links == sum(n for i, (n, _) in want.items() if i % 20 == 0)
    assert audit.found >= 0.9 * audit.links


def test_empty_and_lonely(spark):
    assert G.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = G.near_duplicates(spark.createDataFrame([(4, [1.0, 0.0], 0, 0)], SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows] == [(4, 0, 4, True)]


def _spread_pairs(n):
    """Links just above the threshold between vectors spread over many clusters."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        x, y = rng.normal(0, 1, (2, 64))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.905 * x + (1 - 0.905**2) ** 0.5 * y / np.linalg.norm(y)).tolist())]
    return [(i, [float(np.float32(a)) for a in v]) for i, v in rows]


def test_pairs_spread_over_many_clusters(spark, monkeypatch):
    """Recall of links just above the threshold, with the production overlap."""
    monkeypatch.setattr(G, "SHARD", 40)
    rows = _spread_pairs(700)
    got = {r.vec_id: (r.n_links, r.component_id) for r in G.near_duplicates(
        spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(3)).collect()}
    want = {i: (1, i - i % 2) for i, _ in rows}
    assert all(got[i][0] <= 1 and got[i][1] in (i, i - i % 2) for i in want)
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


def test_the_whole_bound_leaves_no_cluster_out():
    """With all of the bound, both ends of a link share the home of either."""
    x = np.array([v for _, v in _spread_pairs(700)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = x[:70]
    row, cluster = G.overlap(x, centres, sigmas=8.0)  # 8 / sqrt(64) = 1
    home = (x @ centres.T).argmax(axis=1)
    assert (cluster[np.flatnonzero(np.diff(row, prepend=-1))] == home).all()
    inside = set(zip(row.tolist(), cluster.tolist(), strict=True))
    assert all((i, home[i ^ 1]) in inside for i in range(len(x)))
    part, _ = G.overlap(x, centres, sigmas=G.SIGMAS)
    assert len(part) < len(row)


def test_dense_cluster_is_cut(spark, monkeypatch):
    """A third of all rows in one group, over many parts and query blocks."""
    monkeypatch.setattr(G, "SHARD", 100)
    monkeypatch.setattr(G, "NODES", 60)
    monkeypatch.setattr(G, "QUERIES", 50)
    rng = np.random.default_rng(3)
    base = rng.normal(0, 1, 16)
    rows = [(i, (base + 0.02 * rng.normal(0, 1, 16)).tolist()) for i in range(200)]
    rows += [(200 + i, rng.normal(0, 1, 16).tolist()) for i in range(400)]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in G.near_duplicates(
        spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(3)).collect()}
    assert all(got[i] == want[i] for i in range(200))
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


def test_rows_without_or_with_repeated_ids(spark):
    near = [1.0, 0.0, 0.01]
    rows = [(3, [1.0, 0.0, 0.0]), (None, near), (1, [0.0, 1.0, 0.0]), (1, [0.0, 0.0, 1.0]), (8, [0.0, 0.01, 1.0]),
            (None, [-1.0, 0.0, 0.0]), (None, [-1.0, 0.0, 0.02]), (None, None), (5, [0.0, 0.0, 0.0]), (9, [1.0, None])]
    got = G.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted([
        ("3", 1, "3", True), ("None", 1, "3", False), ("1", 0, "1", True), ("1", 1, "1", True), ("8", 1, "1", False),
        ("None", 1, "None", True), ("None", 1, "None", True), ("None", 0, "None", True), ("5", 0, "5", True), ("9", 0, "9", True)])
