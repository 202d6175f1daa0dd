"""Embedding near-duplicates by a robust-pruned flat graph.

1. Vectors are normalised in double precision; equal ones form one class, and
   only classes are indexed. Vectors that are null, zero or hold null or
   non-finite components take no part.
2. Cluster centres are fitted on a bounded sample (``SAMPLE`` vectors and
   ``SAMPLE_BYTES``, by hash). Clusters overlap: a class belongs to its nearest
   cluster (its home), to the second nearest, and to every cluster that could be
   the home of a neighbour. A vector at distance s beyond the plane halfway
   between two centres is asin(s) away from all members of the other cluster, so
   s <= sin(acos(0.9)) holds wherever a link is possible at all. A neighbour in
   no particular direction lies 1 / sqrt(dim) of that beyond the plane (standard
   deviation), so ``SIGMAS`` / sqrt(dim) of the bound is used, and all of it where
   that is more than 1.
3. In each cluster a graph is built on float32 vectors: candidates of its own
   members, and of those it is second nearest to, are their nearest in the
   overlapping cluster. Robust pruning drops a candidate that lies nearer to a
   kept neighbour than to the vector (factor ``ALPHA``), up to ``DEGREE``. A
   vector's lists of both clusters are united.
4. Search: the members of a home are the queries of its cluster. A beam walks
   greedily over the united graph from the medoids (one for each connected part)
   towards each query; once it is in range, the range is expanded: the neighbours
   of every vector in range are looked at until none is new.
5. Every hit is verified by the cosine in double precision. A query meets each
   vector of its cluster once, so no pair is emitted: a task returns a count per
   vector and, for the components, one edge from each vector to the root of its
   local tree.
6. A cluster with more than ``NODES`` members is cut by hash, and its queries go
   to every part; more than ``QUERIES`` queries are cut too. So one dense cluster
   never fills a task, and its work is the square of its size, in blocks.

``audit`` measures the recall of links against brute force for a sample of
queries, in blocks.

n_links counts vectors, copies included. Every row has a result of its own:
rows that share an id are judged by their vectors, and rows without an id link
like others, only that a component takes its name from the rows that have one
(null if none has). Vectors of different lengths
are never compared. An empty input gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import pick, prepare
from quaybook.llm.components import component_labels
from quaybook.plans.stages import write_stage

LINK = 0.9
SAMPLE, SAMPLE_BYTES = 20_000, 32 << 20  # vectors that centres are fitted on
SHARD = 3_000  # members of a home, about
MAX_CLUSTERS = 2_048  # so the centres' size is bounded; larger clusters are cut into parts
SIGMAS = 2.0
NODES, QUERIES = 16_000, 6_000  # vectors and queries of a task
DEGREE, CANDIDATES, ALPHA = 16, 48, 1.2
BEAM, MAX_HOPS = 32, 200
QUERY_BLOCK = 512  # queries that walk together
HELD = 1 << 22  # numbers gathered at once


def unit_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, vec) of every row: doubles of length 1, null if it can't link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.asarray(v, dtype=np.float64) if v and None not in v else np.zeros(1)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top  # so the squares neither overflow nor vanish
                    out.append((x / np.sqrt((x * x).sum())).tobytes())
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"])

    return rows.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, vec binary")


def _matrix(column, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=dtype).reshape(len(column), -1) if len(column) else np.empty((0, 1), dtype=dtype)


def fit_centres(classes: DataFrame, n: int, dim: int) -> np.ndarray:
    """Centres of a few rounds of spherical k-means on a bounded sample."""
    k = int(min(MAX_CLUSTERS, max(1, math.ceil(n / SHARD))))
    sample = classes.where(F.octet_length("vec") == 8 * dim)
    size = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    if n > size:
        sample = sample.where(F.pmod(F.xxhash64("cls"), F.lit(10**9)) < math.ceil(10**9 * size / n))
    x = _matrix([r["vec"] for r in sample.select("cls", "vec").orderBy("cls").limit(2 * size).collect()])
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(8):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-30), centres)
    return centres


def overlap(x: np.ndarray, centres: np.ndarray, sigmas: float, link: float = LINK) -> tuple[np.ndarray, np.ndarray]:
    """(row, cluster) of the clusters that rows of x belong to: by row, the
    nearest centre first."""
    sims = x @ centres.T
    home = sims.argmax(axis=1)
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) if len(centres) <= 64 else np.sqrt(
        np.maximum((centres**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * centres @ centres.T, 0))
    share = min(1.0, sigmas / math.sqrt(x.shape[1])) * math.sqrt(1 - link * link)
    inside = sims[np.arange(len(x)), home][:, None] - sims <= (share + 1e-9) * apart[home] + 1e-12
    if len(centres) > 1:
        inside[np.arange(len(x)), np.argpartition(-sims, 1, axis=1)[:, 1]] = True
    row, cluster = np.nonzero(inside)
    order = np.lexsort((cluster != home[row], -sims[row, cluster], row))
    return row[order], cluster[order]


def assign(classes: DataFrame, centres: np.ndarray, dim: int, sigmas: float) -> DataFrame:
    """(cls, n, vec, vec32, clusters) of each class, nearest cluster first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(2).to_pylist())
                row, cluster = overlap(x, centres, sigmas)
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(x))))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(cluster, pa.int32()))
                small = pa.array([v.tobytes() for v in x.astype(np.float32)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, small, lists], names=["cls", "n", "vec", "vec32", "clusters"])

    return (classes.where(F.octet_length("vec") == 8 * dim).select("cls", "n", "vec")
            .mapInArrow(run, "cls long, n long, vec binary, vec32 binary, clusters array<int>"))


def robust_prune(x: np.ndarray, owners: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES,
                 alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours among the rows of x (unit vectors) of the rows ``owners``:
    the nearest first, then the nearest that no kept neighbour is ``alpha``
    times nearer to."""
    m = min(candidates, len(x) - 1)
    if m <= 0:
        return [np.empty(0, dtype=np.int64) for _ in owners]
    out, step = [], int(max(1, min(1024, HELD // (m * x.shape[1]))))
    for at in range(0, len(owners), step):
        own = owners[at:at + step]
        sims = x[own] @ x.T
        sims[np.arange(len(own)), own] = -2
        near = np.argpartition(sims, len(x) - m, axis=1)[:, len(x) - m:]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1, kind="stable"), axis=1)
        far = 1 - np.take_along_axis(sims, near, axis=1)
        between = 1 - np.matmul(x[near], x[near].transpose(0, 2, 1))
        alive, kept = np.ones(near.shape, dtype=bool), np.zeros(near.shape, dtype=bool)
        for j in range(m):  # by distance: keep, then drop what it dominates
            take = alive[:, j] & (kept.sum(axis=1) < degree)
            kept[take, j] = True
            alive[take] &= alpha * between[take, j] > far[take]
        # Very near neighbours stay whatever the pruning, so dense groups hold together.
        kept[:, :2] = True
        out += [row[k] for row, k in zip(near, kept, strict=True)]
    return out


def _neighbours(starts: np.ndarray, flat: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``nodes``, neighbour) for all neighbours of the nodes."""
    size = starts[nodes + 1] - starts[nodes]
    owner = np.repeat(np.arange(len(nodes)), size)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return owner, flat[starts[nodes][owner] + inner]


def _cosines(queries: np.ndarray, x: np.ndarray, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    step = max(1, HELD // x.shape[1])
    parts = [np.einsum("ij,ij->i", queries[rows[i:i + step]], x[to[i:i + step]]) for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.empty(0)


def range_search(x: np.ndarray, starts: np.ndarray, flat: np.ndarray, medoids: np.ndarray, queries: np.ndarray,
                 link: float = LINK) -> tuple[np.ndarray, np.ndarray]:
    """(query, row of x) of the hits with cosine >= link that the walk finds."""
    n, q = len(x), len(queries)
    seen = np.zeros((q, n), dtype=bool)
    beam = np.tile(medoids, (q, 1))
    seen[:, medoids] = True
    sims = queries @ x[medoids].T
    open_ = np.ones(beam.shape, dtype=bool)
    for _ in range(MAX_HOPS):  # greedy: expand the best open node of every query
        score = np.where(open_, sims, -9)
        best = score.argmax(axis=1)
        active = np.flatnonzero(score[np.arange(q), best] > -9)
        if not len(active):
            break
        nodes = beam[active, best[active]]
        open_[active, best[active]] = False
        owner, to = _neighbours(starts, flat, nodes)
        rows = active[owner]
        fresh = ~seen[rows, to]
        rows, to = rows[fresh], to[fresh]
        seen[rows, to] = True
        found = _cosines(queries, x, rows, to)
        width = np.bincount(rows, minlength=q).max() if len(rows) else 0
        if width:
            order = np.argsort(rows, kind="stable")
            rows, to, found = rows[order], to[order], found[order]
            first = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=q))))[:-1]
            column = np.arange(len(rows)) - first[rows]
            more, more_sims = np.zeros((q, width), dtype=np.int64), np.full((q, width), -9.0)
            more[rows, column], more_sims[rows, column] = to, found
            beam, sims = np.hstack([beam, more]), np.hstack([sims, more_sims])
            open_ = np.hstack([open_, more_sims > -9])
            if beam.shape[1] > BEAM:
                top = np.argpartition(-sims, BEAM - 1, axis=1)[:, :BEAM]
                beam, sims, open_ = (np.take_along_axis(a, top, axis=1) for a in (beam, sims, open_))
    at, column = np.nonzero(sims >= link)
    hits = np.zeros((q, n), dtype=bool)
    hits[at, beam[at, column]] = True
    at, to = np.nonzero(hits)
    seen[:] = hits  # from here on: what was compared in the range
    while len(at):  # expand the range until nothing is new
        fresh = np.zeros((q, n), dtype=bool)
        for i in range(0, len(at), 32768):
            owner, new = _neighbours(starts, flat, to[i:i + 32768])
            fresh[at[i:i + 32768][owner], new] = True
        rows, new = np.nonzero(fresh & ~seen)
        seen[rows, new] = True
        near = _cosines(queries, x, rows, new) >= link
        at, to = rows[near], new[near]
        hits[at, to] = True
    return np.nonzero(hits)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least reachable node of each of n nodes, by repeated minimums."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _entries(x: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The medoid of every connected part of the graph, so that all is reachable."""
    n = len(x)
    label = _roots(n, np.repeat(np.arange(n), np.diff(starts)), flat)
    sums = np.zeros_like(x)
    np.add.at(sums, label, x)
    order = np.lexsort((-np.einsum("ij,ij->i", x, sums[label]), label))
    return order[np.concatenate(([True], np.diff(label[order]) > 0))]


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """The lists of neighbours that one cluster gives to its owners."""
    pdf = pdf.sort_values("cls")
    ids, owners = pdf["cls"].to_numpy(), np.flatnonzero(pdf["owner"].to_numpy())
    lists = robust_prune(_matrix(list(pdf["vec32"]), np.float32), owners)
    return pd.DataFrame({"cls": ids[owners], "near": [ids[a] for a in lists]})


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts and tree edges of the links of the queries of one task."""
    pdf = pdf.sort_values("cls")
    ids, copies, vecs = pdf["cls"].to_numpy(), pdf["n"].to_numpy(), _matrix(list(pdf["vec"]))
    is_query, at_node = pdf["query"].to_numpy(), np.flatnonzero(pdf["node"].to_numpy())
    node_ids, x = ids[at_node], vecs[at_node]
    if not len(x) or not is_query.any():
        return pd.DataFrame({"cls": ids[:0], "n_links": ids[:0], "root": ids[:0]})
    near = [np.asarray(a, dtype=np.int64) for a in pdf["near"].to_numpy()[at_node]]
    source, named = np.repeat(np.arange(len(x)), [len(a) for a in near]), np.concatenate(near)
    place = np.minimum(np.searchsorted(node_ids, named), len(x) - 1)
    here = node_ids[place] == named
    source, place = source[here], place[here]
    # Edges lead both ways, so that what is near to a hub is reached from it.
    both = np.unique(np.concatenate([source * len(x) + place, place * len(x) + source]))
    source, place = both // len(x), both % len(x)
    starts = np.concatenate(([0], np.cumsum(np.bincount(source, minlength=len(x)))))
    medoids = _entries(x, starts, place)
    links, tree, queries = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids)), np.flatnonzero(is_query)
    for at in range(0, len(queries), QUERY_BLOCK):
        block = queries[at:at + QUERY_BLOCK]
        row, hit = range_search(x, starts, place, medoids, vecs[block])
        row, hit = block[row], at_node[hit]
        other = row != hit
        row, hit = row[other], hit[other]
        if len(row):
            links += np.bincount(row, weights=copies[hit], minlength=len(ids)).astype(np.int64)
            tree = _roots(len(ids), np.concatenate([row, np.arange(len(ids))]), np.concatenate([hit, tree]))
    some = (links > 0) | (tree != np.arange(len(ids)))
    return pd.DataFrame({"cls": ids[some], "n_links": links[some], "root": ids[tree[some]]})


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    sigmas: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row. ``sigmas`` says how
    far clusters overlap (``SIGMAS``; more finds more and costs more)."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = pick(embeddings, vec_id=id_col, embedding=vec_col)
    units = write_stage(unit_vectors(rows), "units")
    # Equal vectors are one class, named by a hash of the vector; ids only name results.
    classes = write_stage(units.where("vec IS NOT NULL").groupBy("vec").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"))
                          .withColumn("cls", F.xxhash64("vec")), "classes")
    counts, edges = None, None
    for r in classes.groupBy(F.octet_length("vec").alias("size")).count().collect():  # one row per vector length
        part = _links(classes, r["size"] // 8, r["count"], SIGMAS if sigmas is None else sigmas)
        counts = part if counts is None else counts.union(part)
    alone = classes.select("cls", "least_id", "n")
    if counts is None:
        found = alone.withColumns({"own_links": F.lit(0), "component": F.col("cls")})
    else:
        edges = counts.select(F.col("cls").alias("u"), F.col("root").alias("v"))
        labels = component_labels(edges).withColumnRenamed("node", "cls")
        sums = counts.groupBy("cls").agg(F.sum("n_links").alias("own_links"))
        found = alone.join(sums, "cls", "left").join(labels, "cls", "left").withColumn(
            "component", F.coalesce("component", "cls"))
    found = write_stage(found, "found")
    named = found.groupBy("component").agg(F.min("least_id").alias("least_of_all"))
    per_class = found.join(named, "component").select(
        "cls", (F.coalesce("own_links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "least_of_all")
    # Every row looks its own vector up, so rows that share an id, or lack one, are told apart.
    out = units.select("vec_id", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")).alias("cls")).join(per_class, "cls", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("least_of_all", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, dim: int, n: int, sigmas: float) -> DataFrame:
    """(cls, n_links, root) of the classes of one vector length, from all clusters."""
    centres = fit_centres(classes, n, dim)
    placed = write_stage(assign(classes, centres, dim, sigmas), "placed")
    homes, nodes = F.count_if(F.col("rank") == 0), F.count("*")
    sizes = write_stage(placed.select(F.posexplode("clusters").alias("rank", "cluster")).groupBy("cluster").agg(
        F.ceil(nodes / F.lit(NODES)).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.ceil(homes / F.lit(QUERIES))).cast("int").alias("query_parts")), "sizes")  # one row per cluster
    part = F.pmod(F.xxhash64("cls", F.lit(1)), "parts").cast("int")
    build = (placed.select("cls", "vec32", F.posexplode("clusters").alias("rank", "cluster")).join(F.broadcast(sizes), "cluster")
             .select("cluster", part.alias("part"), "cls", "vec32", (F.col("rank") < 2).alias("owner")))
    graph = write_stage(build.groupBy("cluster", "part").applyInPandas(_build, "cls long, near array<long>")
                        .groupBy("cls").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    # A row goes to its part once for each part of the queries, and as a query to all other parts.
    rows = (placed.join(graph, "cls").select("cls", "n", "vec", "near", F.posexplode("clusters").alias("rank", "cluster"))
            .join(F.broadcast(sizes), "cluster").withColumns({
                "home": F.col("rank") == 0, "part": part, "query_part": F.pmod(F.xxhash64("cls", F.lit(2)), "query_parts").cast("int")}))
    cells = F.expr("""concat(
        transform(sequence(0, query_parts - 1), q -> struct(q AS a, part AS b, true AS node, home AND q = query_part AS query)),
        transform(filter(sequence(0, parts - 1), p -> home AND p != part), p -> struct(query_part AS a, p AS b, false AS node, true AS query)))""")
    found = rows.select("cluster", "cls", "n", "vec", "near", F.explode(cells).alias("cell")).select(
        "cluster", "cell.*", "cls", "n", "vec", "near")
    return write_stage(found.groupBy("cluster", "a", "b").applyInPandas(_search, "cls long, n_links long, root long"), "links")


def audit(embeddings: DataFrame, result: DataFrame, every: int = 20, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(queries, links, found): exact links of the vectors whose id ``every``
    divides, against all vectors block by block, and those in ``result``."""
    units = write_stage(unit_vectors(pick(embeddings, vec_id=id_col, embedding=vec_col)).where("vec IS NOT NULL"), "units")
    blocks = max(1, math.ceil(units.count() / NODES))
    slices = F.sequence(F.lit(0), F.lit(blocks - 1))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    size = F.octet_length("vec")
    # Every block of queries meets every block of vectors; the sides share no column names.
    left = units.where(F.col("vec_id") % every == 0).select(
        "vec_id", "vec", size.alias("size"), place.alias("a"), F.explode(slices).alias("b"))
    right = units.select(F.col("vec_id").alias("other_id"), F.col("vec").alias("other"), size.alias("width"),
                         place.alias("d"), F.explode(slices).alias("c"))

    def exact(key, queries: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(len(queries), dtype=np.int64)
        if len(queries) and len(others):
            x, y = _matrix(list(queries["vec"])), _matrix(list(others["other"]))
            for at in range(0, len(y), 1024):
                same = queries["vec_id"].to_numpy()[:, None] == others["other_id"].to_numpy()[at:at + 1024]
                n += ((x @ y[at:at + 1024].T >= LINK) & ~same).sum(axis=1)
        return pd.DataFrame({"vec_id": queries["vec_id"], "links": n})

    links = (left.groupBy("a", "b", "size").cogroup(right.groupBy("c", "d", "width")).applyInPandas(exact, "vec_id long, links long")
             .groupBy("vec_id").agg(F.sum("links").alias("links")))
    return links.join(result.select("vec_id", "n_links"), "vec_id").agg(
        F.count("*").alias("queries"), F.sum("links").alias("links"), F.sum(F.least("links", "n_links")).alias("found"))
