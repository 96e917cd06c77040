"""Hard-negative mining with STR-packed R-trees over integer vectors.

Rows are dealt into trees of one label each, of at most ``TREE_ROWS`` rows: a
range sort by label and first coordinate cuts the rows into slabs, and a slab is
packed by Sort-Tile-Recursive into leaves of ``LEAF`` rows; ``FANOUT`` nodes in a
row make a node of the next level.  Every node keeps the minimum bounding box of
its rows.  A box bounds the inner product with a query coordinate by coordinate:
``q * lo`` or ``q * hi``, whichever is smaller or larger, summed up.

A search keeps a queue of boxes by falling upper bound.  It looks for the first
``k`` rows (by score, ties by id) of one or more score windows at once; a box is
dropped when it lies outside all windows, or strictly below the kth row found so
far (at the kth score a smaller id may still be inside).  It ends when the best
box cannot add to any window.

Anchors are searched in chunks of at most ``CHUNK``: first the trees of their own
label for positives, then all other trees for negatives in the windows that the
positives set.  A (chunk, tree) pair is one row; trees are copied to salts, so no
task gets more than ``CHUNKS_A_SALT`` chunks of one tree, and a hot label is many
trees.  A pair yields at most ``k`` rows a window, ranked over all trees after.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, stored

TREE_ROWS = 16_384      # and at most TREE_BYTES of components
TREE_BYTES = 4 << 20
LEAF, FANOUT, TILED = 128, 16, 4    # rows of a leaf, nodes of a node, coordinates that rows are tiled by
CHUNK = 128             # anchors searched together, and at most CHUNK_BYTES of components
CHUNK_BYTES = 1 << 20
CHUNKS_A_SALT = 32
LARGEST = 1 << 24       # components beyond it count as not finite: sums stay exact in 64 bits
CLOSED = 1 << 62        # beyond all scores


def _str_order(v: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of each leaf: sorted and cut into tiles, coordinate after coordinate."""
    spread = np.argsort(-v.var(axis=0), kind="stable")[:TILED] if v.shape[1] else np.zeros(0, np.int64)

    def tile(rows: np.ndarray, level: int) -> list[np.ndarray]:
        if len(rows) <= leaf:
            return [rows]
        if level == len(spread):
            return [rows[i:i + leaf] for i in range(0, len(rows), leaf)]
        rows = rows[np.argsort(v[rows, spread[level]], kind="stable")]
        leaves = math.ceil(len(rows) / leaf)
        slabs = leaves if level == len(spread) - 1 else math.ceil(leaves ** (1 / (len(spread) - level)))
        size = math.ceil(leaves / slabs) * leaf
        return [x for i in range(0, len(rows), size) for x in tile(rows[i:i + size], level + 1)]
    return tile(np.arange(len(v)), 0)


class RTree:
    """Rows ``ids, rows, v`` in packed order, and nodes, leaves first, the root last."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, v: np.ndarray):
        leaves = _str_order(v)
        order = np.concatenate(leaves)
        self.ids, self.rows, self.v = ids[order], rows[order], v[order]
        cuts = np.cumsum([0, *map(len, leaves)])
        self.first, self.last = list(cuts[:-1]), list(cuts[1:])
        self.n_leaves = len(leaves)
        lo = [self.v[a:b].min(axis=0) for a, b in zip(self.first, self.last, strict=True)]
        hi = [self.v[a:b].max(axis=0) for a, b in zip(self.first, self.last, strict=True)]
        at, n = 0, len(leaves)
        while n > 1:   # the level that was made last, packed in runs
            for a in range(at, at + n, FANOUT):
                b = min(a + FANOUT, at + n)
                self.first.append(a)
                self.last.append(b)
                lo.append(np.min(lo[a:b], axis=0))
                hi.append(np.max(hi[a:b], axis=0))
            at, n = at + n, math.ceil(n / FANOUT)
        self.lo, self.hi = np.stack(lo), np.stack(hi)

    def ready(self) -> RTree:
        """For searches: doubles where their sums are exact, else 64-bit integers."""
        largest = int(np.abs(self.v).max(initial=0))
        self.kind = np.float64 if largest * LARGEST * max(1, self.v.shape[1]) < 1 << 53 else np.int64
        self.v, self.lo, self.hi = (x.astype(self.kind) for x in (self.v, self.lo, self.hi))
        return self

    def search(self, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, skip: int = -1,
               ) -> tuple[list[list[tuple[int, int, int]]], int]:
        """(the first ``k`` rows (score, id, row) of each window, leaves read).

        Window ``w`` holds the rows of score ``low[w]`` to ``high[w]``; row ``skip`` takes no part.
        """
        q = query.astype(self.kind)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        best: list[list[tuple[int, int, int]]] = [[] for _ in low]
        need = np.where(low > high, CLOSED, low)   # the least score that could still get in
        root = len(self.first) - 1
        queue = [(-CLOSED + 1, root)]
        read = 0
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < need.min():
                break
            a, b = self.first[node], self.last[node]
            if node >= self.n_leaves:
                upper, lower = self.hi[a:b] @ up + self.lo[a:b] @ down, self.lo[a:b] @ up + self.hi[a:b] @ down
                use = ((upper[:, None] >= need) & (lower[:, None] <= high)).any(axis=1)
                for i in np.flatnonzero(use).tolist():
                    heapq.heappush(queue, (-int(upper[i]), a + i))
                continue
            read += 1
            score = self.v[a:b] @ q
            inside = (score[:, None] >= need) & (score[:, None] <= high)
            if skip >= 0:
                inside &= (self.rows[a:b] != skip)[:, None]
            for w in np.flatnonzero(inside.any(axis=0)).tolist():
                for i in np.flatnonzero(inside[:, w]).tolist():
                    best[w].append((-int(score[i]), int(self.ids[a + i]), int(self.rows[a + i])))
                best[w] = heapq.nsmallest(k, best[w])
                if len(best[w]) == k:
                    need[w] = max(need[w], -best[w][-1][0])
        return [[(-s, i, r) for s, i, r in found] for found in best], read


def _runs(batches: Iterator[pa.RecordBatch], most: Callable[[int], int]) -> Iterator[tuple]:
    """(label, rows, ids, vectors) of runs of rows of one label and length, of ``most(length)`` rows at most."""
    held: list[tuple[int, int, list[int]]] = []
    key = None

    def out() -> tuple:
        v = np.array([x[2] for x in held], np.int32).reshape(len(held), key[1])
        return key[0], np.array([x[0] for x in held], np.int64), np.array([x[1] for x in held], np.int64), v
    for b in batches:
        for row, i, label, v in zip(*(b.column(n).to_pylist() for n in ("row", "id", "label", "v")), strict=True):
            if held and ((label, len(v)) != key or len(held) >= most(len(v))):
                yield out()
                held = []
            key = (label, len(v))
            held.append((row, i, v))
    if held:
        yield out()


def _packed(build: Callable, rows: int, size: int):
    def most(dim: int) -> int:
        return max(1, min(rows, size // (4 * max(dim, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, at, ids, v in _runs(batches, most):
            yield pa.RecordBatch.from_pylist([{"label": label, "dim": v.shape[1], "held": pickle.dumps(build(ids, at, v))}],
                                             pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("held", pa.binary())]))
    return run


def _boxed(rows: DataFrame, order: list[Column], build: Callable, most: int, size: int, name: str) -> DataFrame:
    """``no, label, dim, held``: runs of rows of one label, sorted by ``order``, each packed into one row."""
    keys = ["label", F.size("v"), *order, "row"]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    packed = sorted_rows.mapInArrow(_packed(build, most, size), "label long, dim int, held binary")
    return stored(packed.withColumn("no", F.monotonically_increasing_id()), name)


def _searched(k: int):
    """Rows ``chunk, tree[, windows]`` -> the first ``k`` rows of each window, tree by tree."""
    names = ["anchor", "anchor_id", "window", "score", "id", "row"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for b in batches:
            for r in range(b.num_rows):
                if b.column("tree_no")[r].as_py() != last:
                    last, tree = b.column("tree_no")[r].as_py(), pickle.loads(b.column("tree")[r].as_py()).ready()
                ids, rows, vectors = pickle.loads(b.column("chunk")[r].as_py())
                windows: dict[int, list] = {}
                if "windows" in b.schema.names:
                    for w in b.column("windows")[r].as_py():
                        windows.setdefault(w["anchor"], []).append((w["window"], w["low"], w["high"]))
                else:
                    windows = {int(x): [(int(x), -CLOSED, CLOSED)] for x in rows}
                found = []
                for i, anchor in enumerate(rows.tolist()):
                    own = windows.get(anchor)
                    if own:
                        low, high = np.array([w[1] for w in own]), np.array([w[2] for w in own])
                        hits, _ = tree.search(vectors[i], low, high, k, skip=anchor)
                        found += [(anchor, int(ids[i]), w[0], s, j, x) for w, hit in zip(own, hits, strict=True)
                                  for s, j, x in hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * len(names))],
                    schema=schema)
    return run


def _first(chunks: DataFrame, trees: DataFrame, same_label: bool, k: int, name: str) -> DataFrame:
    """``anchor, anchor_id, window, score, id, row, rank``: the first ``k`` rows of every window over all trees."""
    n_salts = max(1, -(-chunks.count() // CHUNKS_A_SALT))
    label = (F.col("c_label") == F.col("t_label")) if same_label else (F.col("c_label") != F.col("t_label"))
    own = chunks.select(F.col("no").alias("chunk_no"), F.col("label").alias("c_label"), "dim")
    their = trees.select(F.col("no").alias("tree_no"), F.col("label").alias("t_label"), "dim")
    pairs = (own.join(their, "dim").where(label).select("chunk_no", "tree_no")
             .join(chunks.drop("label", "dim").withColumnsRenamed({"no": "chunk_no", "held": "chunk"}), "chunk_no")
             .withColumn("salt", F.pmod(F.xxhash64("chunk_no"), F.lit(n_salts)).cast("int")))
    copies = trees.select(F.col("no").alias("tree_no"), F.col("held").alias("tree"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("salt"))
    fields = ["anchor", "anchor_id", "window", "score", "id", "row"]
    met = pairs.join(copies, ["tree_no", "salt"]).drop("salt", "chunk_no")
    found = stored(met.mapInArrow(_searched(k), ", ".join(f"{f} long" for f in fields)), name)
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, label: Column, is_anchor: Column,
                  scale: float = 256.0) -> DataFrame:
    """``row, id, label, v, is_anchor``: distinct usable rows, components floor(scale * x)."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("v"),
                           F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()))
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(F.lit(scale) * x.cast("double")) <= LARGEST))
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int"))
    rows = rows.where(usable).withColumn("v", whole).distinct()
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
                   is_anchor: Column | None = None, positives: int = 5, negatives: int = 3, low_percent: int = 50,
                   high_percent: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Vectors become integers, floor(256 x).  An anchor's positives are the first
    ``positives`` other rows of its label by inner product, ties by smaller id.
    For each, the first ``negatives`` rows of other labels with
    low_percent * positive <= 100 * negative <= high_percent * positive are
    ranked from 1.  ``label`` defaults to the column ``label``, ``is_anchor`` to all rows.

    Rows with a null id, label or vector, or with a component that is null, not
    finite or beyond +-2^16, take no part.  Equal rows count once; rows that share
    an id but differ are rows of their own.  Vectors are compared with those of
    their own length.  Other columns are ignored, whatever their names.  An empty
    table, or one without anchors, gives no rows.
    """
    label = F.col("label") if label is None else label
    rows = whole_vectors(vectors, id_col, vec_col, label, F.lit(True) if is_anchor is None else is_anchor)
    bound_batches(vectors)
    trees = _boxed(rows, [F.get("v", F.lit(0))], RTree, TREE_ROWS, TREE_BYTES, "negative-trees")
    chunks = _boxed(rows.where("is_anchor"), [], lambda ids, at, v: (ids, at, v), CHUNK, CHUNK_BYTES, "negative-chunks")
    near = _first(chunks, trees, True, positives, "positive-candidates")
    near = stored(near.select("anchor", "anchor_id", F.col("row").alias("window"), F.col("id").alias("positive_id"),
                              F.col("score").alias("positive_score")), "positives")
    # 50 p <= 100 n <= 95 p, in whole numbers
    low = F.ceil(F.col("positive_score") * low_percent / F.lit(100).cast("decimal(10,0)")).cast("long")
    high = F.floor(F.col("positive_score") * high_percent / F.lit(100).cast("decimal(10,0)")).cast("long")
    windows = (near.select(F.col("anchor"), F.struct("anchor", "window", low.alias("low"), high.alias("high")).alias("w"))
               .where("w.low <= w.high"))
    members = stored(chunks.mapInArrow(_members, "no long, anchor long"), "negative-members")
    by_chunk = windows.join(members, "anchor").groupBy("no").agg(F.collect_list("w").alias("windows"))
    searched = stored(chunks.join(by_chunk, "no"), "negative-windows")
    found = _first(searched, trees, False, negatives, "negative-candidates")
    return (found.select("anchor", "window", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
            .join(near, ["anchor", "window"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which anchors a chunk holds."""
    for b in batches:
        for no, held in zip(b.column("no").to_pylist(), b.column("held").to_pylist(), strict=True):
            rows = pickle.loads(held)[1]
            yield pa.RecordBatch.from_arrays([pa.array([no] * len(rows), pa.int64()), pa.array(rows)], ["no", "anchor"])
