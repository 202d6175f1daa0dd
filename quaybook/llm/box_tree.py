"""Hard-negative mining with STR-packed R-trees of integer vectors.

Index. Components are scaled and floored to integers. Rows are dealt by a
hash of id and vector to shards of about ``SHARD_BYTES`` (so one hot vector,
label or source is spread over all of them), and each shard is packed into one
tree per vector length by sort-tile-recursive: rows of a label are sorted on
the coordinate that spreads most, cut into slabs, each slab is sorted on the
next one, and so on; runs of ``LEAF`` rows are leaves, runs of ``FANOUT``
nodes are the nodes above. A node has a minimum bounding box and the range of
its labels. The index is a written table, one row per shard and length.

Search. A box and an anchor give an interval per coordinate, and their sums an
interval [low, high] of the inner product. The queue hands out the node with
the largest upper end first; a node is left out if its interval lies outside
the score window, if its labels can't match, or if its upper end is strictly
below the kth score found so far (an equal one may hold a smaller id). Leaves
are scored exactly. All rows are searched and nothing is approximate.

Anchors are searched in blocks of up to ``BLOCK``, tiled by label and place as
leaves are. A block has one queue: a node stays in it as long as any anchor of
the block wants it, its place is the largest upper end of those, and the leaves
that it hands out next are scored in one matrix product.

Anchors and trees meet in tiles, one task each: a part of the anchors, of about
``HELD_BYTES`` in the task's memory, and a group of shards, whose trees pass one
at a time. What an anchor found in one tree holds for the next, and the best few
of each anchor leave the task, which a ranked window reduces to the result
(Spark limits groups before and after that exchange). Every row is sent once
for each part and every anchor once for each group, by a shuffle on the tile;
nothing is joined or broadcast, so the driver's memory doesn't grow with the
anchors (a join of anchors with shards was planned by the size of the anchors'
files, and then broadcast a copy of them for each shard).

1. Positives: the best rows of the anchor's label, window unbounded.
2. Negatives: for every positive, the best rows of other labels in
   [ceil(positive * low), positive * high]; windows of one anchor share the
   intervals and leaf scores.

Scores are exact: every sum of products stays below 2**24 in floats or 2**53 in
doubles, or else is computed in integers of any size; a score must fit a long.

Rows with a null id, label or vector, or a null or non-finite component, take
no part, and vectors meet only vectors of the same length. Fully repeated rows
count once; rows that share an id but differ are rows of their own, and none
is another's positive or negative. Ties are ordered by smaller id. Empty
inputs give empty results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaybook.llm.bisector import finite_vector
from quaybook.llm.common import pick, prepare
from quaybook.plans.stages import write_stage

SCALE = 256
LEAF, FANOUT = 128, 16
AXES = 3  # coordinates that tiles are cut on
SHARD_BYTES = 1 << 22  # of a shard's vectors, about
BLOCK = 128  # anchors that are searched together
TOGETHER = 16  # leaves that are scored at once, at most
PACK = 4096  # anchors in a row on their way to the tiles
HELD_BYTES = 1 << 27  # of anchors and what they found, in a task, about
TILE_ROWS = 1 << 19  # of the trees that pass through a task, about
POSITIVES = NEGATIVES = 5
WINDOW = (80, 100, 100)  # least and most negative score, in hundredths of the positive's
EXACT, EXACT_SINGLE = float(2**53), float(2**24)


def str_order(points: np.ndarray, rows: np.ndarray, axes: list[int], leaf: int = LEAF) -> list[np.ndarray]:
    """The rows in tiles of at most ``leaf``: sort, cut into slabs, recurse."""
    if len(rows) <= leaf:
        return [rows]
    rows = rows[np.argsort(points[rows, axes[0]], kind="stable")]
    tiles = -(-len(rows) // leaf)
    slabs = tiles if len(axes) == 1 else int(np.ceil(tiles ** (1 / len(axes))))
    width = -(-tiles // slabs) * leaf  # whole leaves in every slab but the last
    cut = [rows[i:i + width] for i in range(0, len(rows), width)]
    if len(axes) == 1:
        return cut
    return [tile for slab in cut for tile in str_order(points, slab, axes[1:], leaf)]


def label_tiles(labels: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """The rows of every label in tiles, cut on the coordinates that spread most."""
    axes = list(np.argsort(-points.astype(np.float64).std(axis=0), kind="stable")[:AXES]) if points.shape[1] else []
    by_label = np.argsort(labels, kind="stable")
    tiles: list[np.ndarray] = []
    for rows in np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1):
        tiles += str_order(points, rows, axes, leaf) if axes else [rows[i:i + leaf] for i in range(0, len(rows), leaf)]
    return tiles


class BoxTree:
    """A packed tree over vectors of one length; its leaves hold one label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, starts: np.ndarray):
        self.ids, self.labels, self.points = ids, labels, points
        self.bounds = np.append(starts, len(ids))
        self.levels = [(np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts),
                        np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts))]
        while len(self.levels[-1][0]) > 1:
            low, high, least, most = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)))

    @staticmethod
    def packed(ids: np.ndarray, labels: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> BoxTree:
        tiles = label_tiles(labels, points, leaf)
        order = np.concatenate(tiles)
        starts = np.concatenate(([0], np.cumsum([len(t) for t in tiles])[:-1])).astype(np.int64)
        return BoxTree(ids[order], labels[order], points[order], starts)

    def of_kind(self, kind: type) -> BoxTree:
        """The same tree, its points of another type."""
        return BoxTree(self.ids, self.labels, _of_kind(self.points, kind), self.bounds[:-1])


class Best:
    """The ``most`` best (score, id) of every window [low, high] of every
    anchor, best first; low and high are arrays by anchor and window."""

    def __init__(self, most: int, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high
        self.scores = np.full((*low.shape, most), -np.inf)
        self.ids = np.zeros((*low.shape, most), dtype=np.int64)

    def least(self) -> np.ndarray:
        """By anchor and window, the score below which nothing is wanted."""
        return np.maximum(self.low, self.scores[..., -1])

    def add(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows found: the anchor's place, the score and the row's id."""
        if scores.dtype == object and self.scores.dtype != object:
            self.scores = self.scores.astype(object)
        windows, most = self.scores.shape[1:]
        fits = (scores[:, None] >= self.least()[anchors]) & (scores[:, None] <= self.high[anchors])
        at, window = np.nonzero(fits)
        if not len(at):
            return
        owner = anchors[at] * windows + window
        kept_scores, kept_ids = self.scores.reshape(-1, most), self.ids.reshape(-1, most)
        touched = np.unique(owner)
        owner = np.concatenate((owner, np.repeat(touched, most)))
        scores = np.concatenate((scores[at].astype(self.scores.dtype), kept_scores[touched].ravel()))
        ids = np.concatenate((ids[at], kept_ids[touched].ravel()))
        height = np.unique(scores, return_inverse=True)[1] if scores.dtype == object else scores
        order = np.lexsort((ids, -height, owner))
        # Every owner touched has ``most`` rows here at least, so each place is written.
        starts = np.searchsorted(owner[order], touched)
        first = order[(starts[:, None] + np.arange(most)).ravel()]
        kept_scores[touched], kept_ids[touched] = scores[first].reshape(-1, most), ids[first].reshape(-1, most)


class AnchorSearch:
    """The search of anchors in one tree; they share what is computed."""

    def __init__(self, tree: BoxTree, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.tree, self.anchors = tree, np.atleast_2d(anchors)
        self.ids, self.labels = np.atleast_1d(ids), np.atleast_1d(labels)
        self.up, self.down = np.maximum(self.anchors, 0).T, np.minimum(self.anchors, 0).T
        self.scored: set[int] = set()

    def _nodes(self, level: int, a: int, b: int) -> tuple:
        """(first, lows, highs, least labels, most labels) of nodes of a level;
        lows and highs by node and anchor."""
        low, high, least, most = (x[a:b] for x in self.tree.levels[level])
        return a, low @ self.up + high @ self.down, high @ self.up + low @ self.down, least, most

    def _children(self, level: int, node: int) -> tuple:
        return self._nodes(level - 1, node * FANOUT, (node + 1) * FANOUT)

    def _scores(self, leaf: int) -> np.ndarray:
        a, b = self.tree.bounds[leaf:leaf + 2]
        return self.tree.points[a:b] @ self.anchors.T

    def look(self, best: Best, same_label: bool) -> None:
        """Add the rows of the anchors' labels, or of the others, to ``best``."""
        top = len(self.tree.levels) - 1
        kind = self.anchors.dtype
        least, most = best.least().min(axis=1).astype(kind), best.high.max(axis=1).astype(kind)
        queue: list[tuple] = []
        leaves: list[int] = []
        ready = 1 if (least == -np.inf).any() else TOGETHER  # leaves that are scored at once
        nodes, level = self._nodes(top, 0, 1), top
        while True:
            if nodes:
                first, lows, highs, labels, last = nodes
                held = (labels[:, None] <= self.labels) & (self.labels <= last[:, None])
                fits = held if same_label else ~((labels == last)[:, None] & held)
                fits = fits & (highs >= least) & (lows <= most)
                bound = np.where(fits, np.minimum(highs, most), -np.inf).max(axis=1)
                for i in np.flatnonzero(fits.any(axis=1)):
                    heapq.heappush(queue, (-bound[i], level, first + int(i), np.where(fits[i], highs[i], -np.inf)))
                nodes = None
            if len(leaves) == ready or leaves and not queue:
                self._add(best, leaves, same_label, least, most)
                least, leaves, ready = best.least().min(axis=1).astype(kind), [], min(2 * ready, TOGETHER)
            if not queue:
                return
            _, level, node, highs = heapq.heappop(queue)
            if not ((highs >= least) & (highs > -np.inf)).any():
                continue  # strictly below every kth
            if level:
                nodes = self._children(level, node)
                level -= 1
            else:
                leaves.append(node)

    def _add(self, best: Best, leaves: list[int], same_label: bool, least: np.ndarray, most: np.ndarray) -> None:
        tree, leaves = self.tree, sorted(leaves)
        self.scored.update(leaves)
        bounds = tree.bounds
        if leaves[-1] - leaves[0] + 1 == len(leaves):
            rows = np.arange(bounds[leaves[0]], bounds[leaves[-1] + 1])
            points = tree.points[rows[0]:rows[-1] + 1]
        else:
            rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in leaves])
            points = tree.points[rows]
        some = slice(None)
        if same_label:  # anchors of other labels than these leaves have
            some = np.flatnonzero(np.isin(self.labels, tree.labels[bounds[leaves]]))
        scores = points @ self.anchors[some].T
        hit = scores >= least[some]
        if np.count_nonzero(hit) > hit.size // 8:  # else ``best`` looks at the few that are left
            hit &= scores <= most[some]
        row, anchor = np.divmod(np.flatnonzero(hit), max(1, scores.shape[1]))
        scores = scores[row, anchor]
        if same_label:
            anchor = some[anchor]
        row = rows[row]
        kept = ((tree.labels[row] == self.labels[anchor]) == same_label) & (tree.ids[row] != self.ids[anchor])
        scores = scores[kept] if scores.dtype == object else scores[kept].astype(np.float64)
        best.add(anchor[kept], scores, tree.ids[row[kept]])

    def best(self, most: int, same_label: bool, low: float = -np.inf, high: float = np.inf) -> list[tuple]:
        """(score, id) of the best rows of one anchor with scores in [low, high]."""
        found = Best(most, np.array([[low]]), np.array([[high]]))
        self.look(found, same_label)
        return [(int(s), int(i)) for s, i in zip(found.scores[0, 0], found.ids[0, 0], strict=True) if s > -np.inf]


def _of_kind(points: np.ndarray, kind: type) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(points) if kind is object else points.astype(kind)


def _reach(points: np.ndarray) -> float:
    return float(np.abs(points.astype(np.float64)).max(initial=0))


def _kind(reach: float, anchors: np.ndarray) -> type:
    """The narrowest type in which sums of products are exact: every partial
    sum is an integer up to the largest component times the sum of an anchor's."""
    most = reach * float(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0))
    return np.float32 if most < EXACT_SINGLE else np.float64 if most < EXACT else object


def _narrow(points: np.ndarray) -> np.ndarray:
    """Integers in doubles as the narrowest type that holds them."""
    most = _reach(points)
    return points.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def _read_points(data: pa.Buffer, rows: int, dim: int) -> np.ndarray:
    if not dim:
        return np.zeros((rows, 0))
    kind = {2: np.int16, 4: np.int32, 8: np.float64}[data.size // (rows * dim)]
    return np.frombuffer(data, dtype=kind).reshape(rows, dim)


#: Trees and packs of anchors travel together; ``more`` has the starts of a
#: tree's leaves, or a pack's keys and then its lists of positives.
PACKED = "dim int, anchors boolean, ids binary, labels binary, points binary, more binary"


def _points(vectors: pd.Series, scale: int) -> np.ndarray:
    return np.floor(scale * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _packed_row(dim: int, anchors: bool, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, more: np.ndarray) -> list:
    return [dim, anchors, ids.tobytes(), labels.tobytes(), _narrow(points).tobytes(), more.astype(np.int64).tobytes()]


def build_index(rows: DataFrame, scale: int = SCALE, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int, int]:
    """(the written trees of rows (vec_id, label, vector), the number of
    shards, the number of rows)."""
    size, n = rows.agg(F.sum(F.size("vector").cast("double")), F.count("*")).first()
    shards = max(1, int(np.ceil(8 * (size or 0.0) / shard_bytes)))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["vec_id"], kind="stable")
        tree = BoxTree.packed(group["vec_id"].to_numpy(np.int64), group["label"].to_numpy(np.int64),
                              _points(group["vector"], scale))
        row = _packed_row(key[1], False, tree.ids, tree.labels, tree.points, tree.bounds[:-1])
        return pd.DataFrame([[key[0], *row]], columns=["shard", "dim", "anchors", "ids", "labels", "points", "more"])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")).withColumn(
        "dim", F.size("vector"))
    return write_stage(dealt.groupBy("shard", "dim").applyInPandas(build, f"shard int, {PACKED}"), "trees"), shards, n


def _packs(anchors: DataFrame, packs: int, positives: int, scale: int) -> DataFrame:
    """Anchors in packs of one vector length."""
    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        more = np.zeros((len(group), 2 + 2 * positives), dtype=np.int64)
        more[:, 0] = group["anchor_key"]
        for line, others, scores in zip(more, group["others"], group["scores"], strict=True):
            if others is not None and len(others):
                line[1] = len(others)
                line[2:2 + len(others)], line[2 + positives:2 + positives + len(others)] = others, scores
        row = _packed_row(key[0], True, group["anchor_id"].to_numpy(np.int64), group["label"].to_numpy(np.int64),
                          _points(group["vector"], scale), more)
        return pd.DataFrame([[key[1], *row]], columns=["pack", "dim", "anchors", "ids", "labels", "points", "more"])

    return anchors.withColumn("dim", F.size("vector")).groupBy(
        "dim", F.pmod("anchor_key", F.lit(packs)).cast("int").alias("pack")).applyInPandas(pack, f"pack int, {PACKED}")


class _Block:
    """Anchors that are searched together, and what they have found."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, more: np.ndarray, most: int,
                 window: tuple[int, int, int] | None):
        self.ids, self.labels, self.points, self.keys = ids, labels, points, more[:, 0]
        low, high = np.full((len(ids), 1), -np.inf), np.full((len(ids), 1), np.inf)
        if window is not None:
            n = (more.shape[1] - 2) // 2
            self.others, self.scores = more[:, 2:2 + n], more[:, 2 + n:]
            least, largest, whole = window
            scores = self.scores.astype(object)  # of any size
            low, high = -(-least * scores // whole), largest * scores // whole
            if all(abs(x) < EXACT for part in (low, high) for x in part.flat):
                low, high = low.astype(np.float64), high.astype(np.float64)
            none = np.arange(n) >= more[:, 1:2]
            low[none], high[none] = np.inf, -np.inf
        self.window = window
        self.best = Best(most, low, high)

    def look(self, kinds: dict[type, BoxTree], reach: float) -> None:
        """Search a tree, given in the types that it was made of so far."""
        kind = _kind(reach, self.points)
        if kind not in kinds:
            kinds[kind] = next(iter(kinds.values())).of_kind(kind)
        AnchorSearch(kinds[kind], _of_kind(self.points, kind), self.ids, self.labels).look(self.best, self.window is None)

    def found(self) -> pa.RecordBatch:
        best = self.best
        a, w, k = np.nonzero((best.scores > -np.inf).astype(bool))
        scores = best.scores[a, w, k]
        scores = pa.array([int(s) for s in scores] if scores.dtype == object else scores.astype(np.int64), pa.int64())
        none = [pa.nulls(len(a), kind) for kind in (pa.int32(), pa.int64(), pa.int64())]
        positive = none if self.window is None else [pa.array(w, pa.int32()), pa.array(self.others[a, w], pa.int64()),
                                                     pa.array(self.scores[a, w], pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[a], pa.int64()), pa.array(self.keys[a], pa.int64()), *positive,
             pa.array(best.ids[a, w, k], pa.int64()), scores], names=[c.split()[0] for c in FOUND.split(", ")])


def _grouped(packs: list[tuple], block: int, most: int, window: tuple[int, int, int] | None) -> list[_Block]:
    """The anchors of packs in tiles, small ones together, so that a block's
    anchors have few labels and lie near each other."""
    ids, labels, points, more = (np.concatenate(x) for x in zip(*packs, strict=True))
    blocks: list[list[np.ndarray]] = []
    for tile in label_tiles(labels, points, block):
        if not blocks or sum(map(len, blocks[-1])) + len(tile) > block:
            blocks.append([])
        blocks[-1].append(tile)
    cut = [np.concatenate(b) for b in blocks]
    return [_Block(ids[b], labels[b], points[b], more[b], most, window) for b in cut]


FOUND = ("anchor_id long, anchor_key long, positive int, positive_id long, positive_score long, "
         "other_id long, score long")


def _tiles(index: tuple[DataFrame, int, int], anchors: DataFrame, positives: int, most: int, scale: int) -> DataFrame:
    """A partition for every part of the anchors and group of shards: the packs
    of the part first, then the trees of the group. Nothing is broadcast."""
    trees, shards, rows = index
    size, n = anchors.agg(F.sum(F.size("vector").cast("double")), F.count("*")).first()
    parts = max(1, int(np.ceil((4 * (size or 0.0) + 16.0 * n * max(1, positives) * most) / HELD_BYTES)))
    tasks = 3 * anchors.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(shards, max(-(-rows // TILE_ROWS), -(-tasks // parts))))
    packs = _packs(anchors, max(parts, -(-n // PACK)), positives, scale)
    part, group = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    columns = [c.split()[0] for c in PACKED.split(", ")]
    packs = packs.withColumn("part", F.pmod("pack", F.lit(parts))).withColumn("group", group)
    trees = trees.withColumn("part", part).withColumn("group", F.pmod("shard", F.lit(groups)))
    tile = (F.col("part") * groups + F.col("group")).cast("int").alias("tile")
    both = packs.select(tile, *columns).unionByName(trees.select(tile, *columns))
    return both.repartitionById(parts * groups, "tile").sortWithinPartitions(F.col("anchors").desc())


def _search(index: tuple[DataFrame, int, int], anchors: DataFrame, positives: int, most: int,
            window: tuple[int, int, int] | None, scale: int, block: int) -> DataFrame:
    """The best rows in each group of shards for every anchor (``window``
    None: of its label) or for each of its positives (of other labels, in the
    window)."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: dict[int, list[tuple]] = {}
        blocks: dict[int, list[_Block]] = {}  # by vector length
        for batch in batches:
            for row in range(batch.num_rows):
                dim, is_pack = batch.column("dim")[row].as_py(), batch.column("anchors")[row].as_py()
                ids, labels, more = (np.frombuffer(batch.column(c)[row].as_buffer(), dtype=np.int64)
                                     for c in ("ids", "labels", "more"))
                points = _read_points(batch.column("points")[row].as_buffer(), len(ids), dim)
                if is_pack:
                    packs.setdefault(dim, []).append((ids.copy(), labels.copy(), points.copy(), more.reshape(len(ids), -1).copy()))
                    continue
                if dim in packs:
                    blocks[dim] = _grouped(packs.pop(dim), block, most, window)
                if dim in blocks:
                    reach = _reach(points)
                    kinds = {points.dtype.type: BoxTree(ids, labels, points, more)}
                    for b in blocks[dim]:
                        b.look(kinds, reach)
        for some in blocks.values():
            for b in some:
                yield b.found()

    return _tiles(index, anchors, positives, most, scale).drop("tile").mapInArrow(look, FOUND)


def _ranked(found: DataFrame, most: int, *group: str) -> DataFrame:
    order = Window.partitionBy("anchor_id", "anchor_key", *group).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int, int] = WINDOW, scale: int = SCALE, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", shard_bytes: int = SHARD_BYTES, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). ``is_anchor`` is a condition on the column ``vec_id``.
    Ids and labels are whole numbers."""
    prepare(rows.sparkSession)
    given = pick(rows, vec_id=id_col, label=label_col, vector=vector_col)
    # Floats stay floats: a double of each would be twice as long.
    kind = given.schema["vector"].dataType.simpleString()
    taking = given.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast(kind if kind == "array<float>" else "array<double>").alias("vector"))
    taking = write_stage(taking.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                                      & finite_vector(F.col("vector"))).distinct(), "vectors")
    index = build_index(taking, scale, shard_bytes)
    none = F.lit(None).cast("array<bigint>")
    anchors = write_stage(taking.where(is_anchor).select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("vec_id", "label", "vector").alias("anchor_key"), "label", "vector",
        none.alias("others"), none.alias("scores")), "anchors")
    near = _ranked(_search(index, anchors, 0, positives, None, scale, block), positives)
    # At most ``positives`` rows in a list.
    lists = near.groupBy("anchor_id", "anchor_key").agg(
        F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("list")).select(
        "anchor_id", "anchor_key", F.col("list.other_id").alias("others"), F.col("list.score").alias("scores"))
    # Vectors are never broadcast, however small their files are.
    having = write_stage(anchors.drop("others", "scores").hint("merge").join(lists, ["anchor_id", "anchor_key"]), "positives")
    far = _ranked(_search(index, having, positives, negatives, window, scale, block), negatives, "positive")
    return far.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))
