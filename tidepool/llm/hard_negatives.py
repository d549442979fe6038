"""Hard negatives by exact search in STR-packed R-trees.

Rows are packed sort-tile-recursively: a range partitioning on the first coordinate (then
``vec_id``, so that one very common vector still spreads) makes the outer slabs, and each
task cuts its sorted rows into tiles and packs each tile by the next two coordinates into
leaves, whose bounding boxes are grouped into an R-tree. A tile holds rows of one label.

The inner product of an anchor with any row of a box lies between the sums of the
per-coordinate minima and maxima over the box. A search takes boxes best first and drops
those whose interval misses the score window, or lies strictly below the k-th best row so
far (ties are visited, since the smaller id wins).

Anchors are packed into blocks; every block meets the tiles of its own label (positives) or
of the others (negatives), spread over ``salt`` groups of tiles. The tiles' best rows are
merged by a ranked window, so a task ships at most k rows per anchor and window.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import discard, durable

TILE = 4096
LEAF = 64
FAN = 8
BLOCK = 256


# -- packing ------------------------------------------------------------------------------

def str_order(rows: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Order of ``rows`` (sorted by the first coordinate) that packs them into leaves: slabs
    by the second coordinate, runs by the third."""
    n, dim = rows.shape
    slabs = int(np.ceil(np.sqrt(np.ceil(n / leaf))))
    size = int(np.ceil(n / (slabs * leaf))) * leaf
    order = np.argsort(rows[:, min(1, dim - 1)], kind="stable")
    return np.concatenate([
        part[np.argsort(rows[part, min(2, dim - 1)], kind="stable")]
        for part in (order[i:i + size] for i in range(0, n, size))])


class RTree:
    """Bounding boxes over packed rows; node 0 is the root, children are contiguous."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.ids, self.rows = ids, rows
        starts = np.arange(0, len(ids), leaf)
        levels = [(np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts),
                   starts, np.append(starts[1:], len(ids)))]
        while len(levels[-1][2]) > 1:
            lo, hi, first, _ = levels[-1]
            s = np.arange(0, len(first), fan)
            levels.append((np.minimum.reduceat(lo, s), np.maximum.reduceat(hi, s), s,
                           np.append(s[1:], len(first))))
        levels.reverse()
        self.leaves_from = sum(len(x[2]) for x in levels[:-1])
        base, first, last = 0, [], []
        for k, (_, _, a, b) in enumerate(levels):
            base += len(a)
            shift = base if k < len(levels) - 1 else 0
            first.append(a + shift)
            last.append(b + shift)
        self.lo = np.concatenate([x[0] for x in levels])
        self.hi = np.concatenate([x[1] for x in levels])
        self.first, self.last = np.concatenate(first).tolist(), np.concatenate(last).tolist()

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest possible inner product of each query with each node."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        return (plus @ self.lo.T + minus @ self.hi.T, plus @ self.hi.T + minus @ self.lo.T)

    def search(self, query, low, high, k: int, windows: list[tuple], skip: int | None = None
               ) -> list[list[tuple]]:
        """Per window (least, most) the k best (score, id) with a score inside it. ``low``
        and ``high`` are the query's intervals per node, as lists. The windows share one
        queue, so a box is opened at most once."""
        best: list[list] = [[] for _ in windows]    # heaps of (score, -id), the worst first
        floor = [w[0] for w in windows]             # what a row must reach: window, then k-th
        need = min(floor)
        queue = [(-high[0], 0)]
        while queue:
            top, node = heapq.heappop(queue)
            top = -top
            if top < need:
                break
            bottom = low[node]
            if all(top < f or bottom > w[1] for f, w in zip(floor, windows)):
                continue
            a, b = self.first[node], self.last[node]
            if node < self.leaves_from:
                for child in range(a, b):
                    if high[child] >= need:
                        heapq.heappush(queue, (-high[child], child))
                continue
            scores = self.rows[a:b] @ query
            largest = scores.max()
            for w, (least, most) in enumerate(windows):
                if largest < floor[w]:
                    continue
                heap = best[w]
                for i in np.flatnonzero((scores >= floor[w]) & (scores <= most)).tolist():
                    item = (int(scores[i]), -int(self.ids[a + i]))
                    if -item[1] == skip:
                        continue
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
                if len(heap) == k and heap[0][0] > floor[w]:
                    floor[w] = heap[0][0]
            need = min(floor)
        return [[(s, -i) for s, i in heap] for heap in best]


def _binary(rows: np.ndarray) -> bytes:
    small = not rows.size or np.abs(rows).max() < 1 << 31
    return rows.astype(np.int32 if small else np.int64).tobytes()


def _matrix(data: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.int32 if len(data) == 4 * n * dim else np.int64
    return np.frombuffer(data, dtype=kind).reshape(n, dim).astype(np.int64)


PACKED = "tile long, dim int, label int, ids binary, vecs binary, scores array<array<long>>"


def _pack_batches(size: int, tree: bool):
    """Rows (vec_id, label, dim, q, scores) to packed rows of one (dim, label) each."""
    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, {}

        def packed(key):
            nonlocal number
            ids, rows, scores = (list(x) for x in zip(*held.pop(key)))
            ids, rows = np.array(ids, dtype=np.int64), np.array(rows, dtype=np.int64)
            order = str_order(rows) if tree else np.arange(len(ids))
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                pa.array([ids[order].tobytes()]), pa.array([_binary(rows[order])]),
                pa.array([scores], pa.list_(pa.list_(pa.int64())))],
                names=[c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            ids, labels, dims = (batch.column(i).to_pylist() for i in range(3))
            q, scores = batch.column(3), batch.column(4)
            for i, key in enumerate(zip(dims, labels)):
                rows = held.setdefault(key, [])
                rows.append((ids[i], q[i].values.to_numpy(), scores[i].as_py()))
                if len(rows) >= size:
                    yield packed(key)
                if len(held) > 64:
                    yield packed(next(iter(held)))
        for key in list(held):
            yield packed(key)
    return run


# -- search -------------------------------------------------------------------------------

FOUND = "anchor_id long, target long, id long, score long"


def _as_exact(rows: np.ndarray, queries: np.ndarray):
    """Both as doubles if every product sum is exact in doubles, else as integers."""
    top = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if top * rows.shape[1] < 2 ** 52:
        return rows.astype(np.float64), queries.astype(np.float64)
    return rows, queries


def _search_batches(k: int, positives: bool):
    def run(batches):
        for batch in batches:
            out = []
            for dim, ids, vecs, anchors, queries, scores in zip(*batch.columns):
                ids = np.frombuffer(ids.as_buffer(), dtype=np.int64)
                anchors = np.frombuffer(anchors.as_buffer(), dtype=np.int64)
                rows, q = _as_exact(_matrix(vecs.as_py(), len(ids), dim.as_py()),
                                    _matrix(queries.as_py(), len(anchors), dim.as_py()))
                tree = RTree(ids, rows)
                low, high = tree.intervals(q)
                wanted = [None] * len(anchors) if positives else scores.as_py()
                for j, (anchor, own) in enumerate(zip(anchors.tolist(), wanted)):
                    targets = [None] if positives else sorted(s for s in own if s >= 0)
                    windows = [(-(1 << 63), 1 << 63)] if positives else [
                        (-(-s // 2), 95 * s // 100) for s in targets]
                    if not windows or high[j, 0] < windows[0][0] or low[j, 0] > windows[-1][1]:
                        continue
                    found = tree.search(q[j], low[j].tolist(), high[j].tolist(), k, windows,
                                        anchor if positives else None)
                    out += [(anchor, t, i, s) for t, rows in zip(targets, found) for s, i in rows]
            for i in range(0, len(out), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out[i:i + 100_000])],
                    names=[c.split()[0] for c in FOUND.split(", ")])
    return run


def _search(tiles: DataFrame, blocks: DataFrame, groups: int, k: int, positives: bool) -> DataFrame:
    """Best ``k`` rows per anchor and window: every block against the tiles of its label
    (positives) or of the other labels, ``groups`` salted groups of tiles side by side."""
    t = tiles.select("dim", F.col("label").alias("tile_label"), "ids", "vecs",
                     F.pmod(F.xxhash64("tile"), F.lit(groups)).alias("salt"))
    b = blocks.select("dim", "label", F.col("ids").alias("anchors"),
                      F.col("vecs").alias("queries"), "scores",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("salt"))
    same = F.col("label") == F.col("tile_label")
    found = (t.join(b, ["dim", "salt"]).where(same if positives else ~same)
             .select("dim", "ids", "vecs", "anchors", "queries", "scores")
             .mapInArrow(_search_batches(k, positives), FOUND))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "target")
                               .orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def participants(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, dim, q): rows with an id, a label and a vector of finite numbers;
    components become ``floor(scale * x)``. Rows that share an id count as one row, the one
    with the smallest label, then vector."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                       & (F.size(v) > 0) & ok)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.col(label_col).cast("int").alias("label"),
                    F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("q"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r"))
            .select("vec_id", "r.label", F.size("r.q").alias("dim"), "r.q"))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3
                   ) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` (vec_id, label, dim, q) as ``participants`` returns them, ``anchors`` a subset
    of them. The positives of an anchor are its first other rows of its label by inner
    product, ties by the smaller id; per positive, the first rows of other labels whose
    score is between half and 95 % of the positive's are its negatives. Rows of another
    dimension never meet. A positive with a negative score, or without rows in its window,
    gives no row; so do an empty table and a table of one label. Scores are exact while
    sums of products fit 64 bits.
    """
    none = F.lit(None).cast("array<long>")
    own = durable(rows.withColumn("scores", none), "mining-rows")
    tasks = max(1, -(-own.count() // TILE))
    tiles = durable(own.withColumn("x", F.col("q")[0])
                    .repartitionByRange(tasks, "dim", "label", "x", "vec_id")
                    .sortWithinPartitions("dim", "label", "x", "vec_id")
                    .select("vec_id", "label", "dim", "q", "scores")
                    .mapInArrow(_pack_batches(TILE, True), PACKED), "mining-tiles")
    groups = max(1, -(-tiles.count() // 4))
    asked = durable(anchors.select("vec_id", "label", "dim", "q"), "mining-anchors")

    def blocks(scores: DataFrame) -> DataFrame:
        return (scores.select("vec_id", "label", "dim", "q", "scores")
                .mapInArrow(_pack_batches(BLOCK, False), PACKED))

    near = durable(_search(tiles, blocks(asked.withColumn("scores", none)), groups, positives, True)
                   .select("anchor_id", F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "mining-positives")
    wanted = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_set("positive_score").alias("scores"))
    far = durable(_search(tiles, blocks(asked.join(wanted, "vec_id")), groups, negatives, False),
                  "mining-negatives")
    out = durable(near.join(far.select("anchor_id", F.col("target").alias("positive_score"), "rank",
                                       F.col("id").alias("negative_id"),
                                       F.col("score").alias("negative_score")),
                            ["anchor_id", "positive_score"])
                  .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                          "negative_score"), "mining-result")
    discard(own, tiles, asked, near, far)
    return out
