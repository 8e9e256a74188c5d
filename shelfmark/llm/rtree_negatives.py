"""Hard-negative mining with STR-packed R-trees.

``pack`` deals the vectors into blocks of bounded size and stores each block as an R-tree, packed by
sort-tile-recursive: rows are sorted by label and cut into slabs, each slab by the coordinate of the
largest spread, each of these by the next one, down to leaves. A leaf is a row of the table. Its
bounding box is over the coordinates and the label; upper levels are boxes of neighbouring boxes.

A box gives, coordinate by coordinate, the least and the greatest product that a vector in it can have
with an anchor's component; their sums bound the inner product of all its rows. The search takes
boxes from a queue, greatest upper bound first. It passes over a box that has no label of the wanted
kind and one that serves no score window: all its scores lie outside the window, or its bound is
strictly below the k-th score found so far, by any block that the task has searched. An equal bound
goes on, for ties go to the smaller id.

Two passes over the blocks, with the anchors in lots of bounded size: the first finds each anchor's
``n_positives`` best rows of its label, the second, for the windows that their scores give, the
best rows of other labels. All windows of an anchor share one queue.

Vectors are of integers, as :func:`vectors` makes them: ``floor(256 x)`` of each component. Scores are
their inner products, exact in 64 bits; components that could exceed that are refused.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part. A
vector shorter than the longest counts as followed by zeros. Rows with a null id come behind equal
scores. "Other" rows are those with another id than the anchor's; equal rows among the anchors are one
anchor, equal rows among the others are rows each. An anchor without positives, or without rows in
its windows, has no rows in the result. Empty tables give none. Other columns, whatever their names,
are not read.

High dimensions: boxes over many independent coordinates are wide, so their bounds seldom fall below
the scores found (on 64 independent coordinates: never but by label), and most of what the search saves it
saves by label. The result is exact either way.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.common import Workspace, map_batches

#: Factor of the components before they are floored.
SCALE = 256
#: Components of a leaf and of a block (4 bytes each), and boxes of a box.
LEAF_COMPONENTS = 16_384
BLOCK_COMPONENTS = 1_000_000
FANOUT = 16
#: Coordinates that packing sorts by, after the label.
PACK_COORDINATES = 3
#: Components of all anchors of a lot; a lot is collected and broadcast.
LOT_COMPONENTS = 8_000_000
#: Share of a positive's score, in percent, that a negative's score has at least and at most.
LOW_PERCENT, HIGH_PERCENT = 30, 90
#: Beyond any score.
_FAR = 2**62


def vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, components as integers."""
    rows = df.select(
        df[id_col].alias("vec_id"),
        df[label_col].cast("long").alias("label"),
        F.transform(df[vector_col], lambda c: c.cast("double")).alias("x"),
    )
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & ~odd)
    return rows.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * SCALE)).alias("vector"))


def padded(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of one width, shorter ones followed by zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column] = vectors.flatten().to_numpy(zero_copy_only=False)
    largest = int(np.abs(out).max(initial=0))
    if largest >= 2**31 or largest**2 * width >= _FAR:
        raise ValueError("Components are too large for scores of 64 bits.")
    return out


def str_order(labels: np.ndarray, matrix: np.ndarray, leaf_rows: int) -> np.ndarray:
    """Row numbers, sort-tile-recursive by label and the coordinates of the largest spread."""
    spread = matrix.var(axis=0) if len(matrix) else np.zeros(matrix.shape[1])
    by = [c for c in np.argsort(-spread, kind="stable")[:PACK_COORDINATES] if spread[c] > 0]

    def tile(rows: np.ndarray, left: list) -> list[np.ndarray]:
        leaves = math.ceil(len(rows) / leaf_rows)
        if not left or leaves <= 1:
            return [rows]
        rows = rows[np.argsort(matrix[rows, left[0]], kind="stable")]
        slabs = math.ceil(leaves ** (1 / len(left)))
        size = math.ceil(leaves / slabs) * leaf_rows
        return [t for a in range(0, len(rows), size) for t in tile(rows[a : a + size], left[1:])]

    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    tiles = [t for group in np.split(order, cuts) for t in tile(group, by)]
    return np.concatenate(tiles) if tiles else order


def leaf_rows(width: int) -> int:
    return max(8, LEAF_COMPONENTS // max(1, width))


def pack(rows: DataFrame, workspace: Workspace, width: int) -> DataFrame:
    """Store the blocks: ``block, ids, labels, vectors``, a row per leaf, in packed order.

    Rows are dealt out in ranges of label and first component, so that blocks have few labels and
    narrow boxes; rows equal in these are dealt by id, so that a hot label or vector spreads.
    """
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = "label", F.get("vector", F.lit(0)), F.xxhash64("vec_id")
    dealt = rows.repartitionByRange(parts, *ranges)
    most = max(leaf_rows(width), BLOCK_COMPONENTS // max(1, width))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                if held and n + part.num_rows > most:
                    yield _leaves(number, pa.Table.from_batches(held), width)
                    number, held, n = number + 1, [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield _leaves(number, pa.Table.from_batches(held), width)

    schema = f"block long, ids array<{kind}>, labels array<long>, vectors binary"
    return workspace.store(map_batches(dealt, build, schema), "rtree")


def _leaves(number: int, table: pa.Table, width: int) -> pa.RecordBatch:
    table = table.combine_chunks()
    ids, vectors = (table[c].combine_chunks() for c in ("vec_id", "vector"))
    matrix, labels, size = padded(vectors, width), table["label"].to_numpy(), leaf_rows(width)
    order = str_order(labels, matrix, size)
    cuts = np.append(np.arange(0, len(order), size), len(order)).astype(np.int32)
    packed = matrix[order].astype("<i4")
    data = [packed[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    columns = [
        pa.array(np.full(len(data), number, np.int64)),
        pa.ListArray.from_arrays(pa.array(cuts), ids.take(pa.array(order))),
        pa.ListArray.from_arrays(pa.array(cuts), pa.array(labels[order])),
        pa.array(data, pa.binary()),
    ]
    return pa.record_batch(columns, ["block", "ids", "labels", "vectors"])


class Tree:
    """The R-tree of one block: leaves as stored, boxes above them."""

    def __init__(self, ids: list, labels: np.ndarray, matrix: np.ndarray, sizes: list[int]):
        self.ids, self.labels = ids, labels
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        # Sums of products below 2^53 are exact in doubles, which are quicker than integers.
        largest = int(np.abs(matrix).max(initial=0))
        small = largest**2 * matrix.shape[1] < 2**52
        self.matrix = matrix.astype(np.float64 if small else np.int64)
        low, high = (f.reduceat(self.matrix, self.starts, axis=0) for f in (np.minimum, np.maximum))
        least, most = (f.reduceat(labels, self.starts) for f in (np.minimum, np.maximum))
        self.levels = [(low, high, least, most)]
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((low, high, least, most))

    def bounds(self, level: int, boxes: slice, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner products that rows in boxes can have with the anchor."""
        low, high = self.levels[level][0][boxes], self.levels[level][1][boxes]
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        return low @ up + high @ down, high @ up + low @ down

    def search(self, anchor: np.ndarray, label: int, same: bool, own, windows: list[Best]) -> int:
        """Offer the rows of the label, or of others, to the windows; how many leaves were read.

        Rows with the id ``own`` are passed over.
        """
        anchor = anchor.astype(self.matrix.dtype)
        low, high = (np.array(x, np.int64) for x in zip(*[(w.low, w.high) for w in windows]))
        floor = np.array([w.floor() for w in windows], np.int64)
        queue: list[tuple] = []

        def push(level: int, box: int) -> None:
            """Queue the boxes below one, or the topmost."""
            part = slice(box * FANOUT, (box + 1) * FANOUT)
            _, _, least, most = (x[part] for x in self.levels[level])
            least_score, bound = self.bounds(level, part, anchor)
            if same:
                fits = (least <= label) & (label <= most)
            else:
                fits = (least != label) | (most != label)
            fits &= ((bound[:, None] >= floor) & (least_score[:, None] <= high)).any(axis=1)
            for i in np.flatnonzero(fits):
                heapq.heappush(queue, (-bound[i], level, part.start + int(i), least_score[i]))

        push(len(self.levels) - 1, 0)
        read = 0
        while queue:
            bound, level, box, least = heapq.heappop(queue)
            if not ((np.minimum(-bound, high) >= floor) & (least <= high)).any():
                continue
            if level:
                push(level - 1, box)
                continue
            rows = slice(self.starts[box], self.ends[box])
            read += 1
            scores = (self.matrix[rows] @ anchor).astype(np.int64)
            wanted = (self.labels[rows] == label) == same
            served = (scores >= floor[:, None]) & (scores <= high[:, None]) & wanted
            for w in np.flatnonzero(served.any(axis=1)):
                at = np.flatnonzero(served[w])
                ids = [self.ids[rows.start + i] for i in at]
                windows[w].offer([(int(scores[i]), d) for i, d in zip(at, ids) if d != own])
                floor[w] = windows[w].floor()
        return read


class Best:
    """The k best ``(score, id)`` of a score window."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.top: list[tuple] = []

    def floor(self) -> int:
        """What a score must have at least to be among them."""
        return max(self.low, self.top[-1][0]) if len(self.top) == self.k else self.low

    def offer(self, found: list[tuple]) -> None:
        self.top = sorted(self.top + found, key=_best_first)[: self.k]


def _best_first(pair: tuple) -> tuple:
    score, row_id = pair
    return -score, (True,) if row_id is None else (False, row_id)


def _trees(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Tree]:
    """The blocks of a task's rows."""
    current, leaves = None, []

    def tree() -> Tree:
        ids, labels, data = zip(*leaves)
        matrix = np.frombuffer(b"".join(data), "<i4").reshape(-1, width).astype(np.int64)
        flat = [i for leaf in ids for i in leaf]
        return Tree(flat, np.concatenate(labels), matrix, [len(x) for x in ids])

    for batch in batches:
        for i, block in enumerate(batch["block"].to_pylist()):
            if block != current and leaves:
                yield tree()
                leaves = []
            current = block
            labels = batch["labels"][i].values.to_numpy()
            leaves.append((batch["ids"][i].as_py(), labels, batch["vectors"][i].as_py()))
    if leaves:
        yield tree()


def _searched(blocks: DataFrame, lot: list[tuple], width: int, k: int, same: bool, workspace: Workspace):
    """Stored ``(anchor, place, score, other)``: each task's k best for each window of each anchor.

    ``lot`` has ``(anchor, id, label, vector, [(place, low, high)])``.
    """
    spark, kind = blocks.sparkSession, blocks.schema["ids"].dataType.elementType
    shared, arrow = spark.sparkContext.broadcast(lot), to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, Best]]] = {}
        for tree in _trees(batches, width):
            for anchor, own, label, vector, windows in shared.value:
                if anchor not in best:
                    best[anchor] = [(place, Best(low, high, k)) for place, low, high in windows]
                tree.search(vector, label, same, own, [b for _, b in best[anchor]])
        rows = [(a, p, s, d) for a, places in best.items() for p, b in places for s, d in b.top]
        columns = zip(*rows) if rows else ([], [], [], [])
        kinds = pa.int64(), pa.int32(), pa.int64(), arrow
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
        yield pa.record_batch(arrays, ["anchor", "place", "score", "other"])

    schema = f"anchor long, place int, score long, other {kind.simpleString()}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(parts, "block").sortWithinPartitions("block")
    found = workspace.store(map_batches(dealt, run, schema), "found")
    shared.destroy()
    return found


def _ranked(found: list[DataFrame], k: int) -> DataFrame:
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("other"))
    ranked = every.withColumn("rank", F.row_number().over(first))
    return ranked.filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    workspace: Workspace,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    lot_components: int = LOT_COMPONENTS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` are tables as :func:`vectors` makes them. A positive of score ``p`` asks
    for negatives of a score ``s`` with ``low_percent * p <= 100 * s <= high_percent * p``.
    """
    numbered = anchors.distinct().withColumn("anchor", F.monotonically_increasing_id())
    asked = workspace.store(numbered, "anchors")
    size = F.max(F.size("vector"))
    widths = rows.agg(size).first()[0], asked.agg(size).first()[0]
    width = max(1, *(w or 0 for w in widths))
    blocks = pack(rows, workspace, width)
    n_lots = max(1, math.ceil(asked.count() * width / lot_components))
    lot_of = F.pmod(F.xxhash64("anchor"), F.lit(n_lots))
    positives, negatives = [], []
    everything = [(0, -_FAR, _FAR)]
    for lot in range(n_lots):
        own = [
            (anchor, own, label, vector, everything)
            for anchor, own, label, vector in _collected(asked.filter(lot_of == lot), width)
        ]
        found = _ranked([_searched(blocks, own, width, n_positives, True, workspace)], n_positives)
        found = found.select(
            "anchor",
            F.col("rank").alias("place"),
            F.col("score").alias("positive_score"),
            F.col("other").alias("positive_id"),
        )
        positives.append(workspace.store(found, "positives"))
        windows = defaultdict(list)
        for anchor, place, score in positives[-1].select("anchor", "place", "positive_score").collect():
            low, high = -(-low_percent * score // 100), high_percent * score // 100
            if low <= high:
                windows[anchor].append((place, low, high))
        own = [(*a[:4], windows[a[0]]) for a in own if a[0] in windows]
        negatives.append(_searched(blocks, own, width, n_negatives, False, workspace))
    found = _ranked(negatives, n_negatives)
    known = positives[0]
    for part in positives[1:]:
        known = known.unionByName(part)
    ids = asked.select("anchor", F.col("vec_id").alias("anchor_id"))
    return found.join(known, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _collected(lot: DataFrame, width: int) -> list[tuple]:
    """A lot's anchors, vectors as arrays."""
    table = lot.select("anchor", "vec_id", "label", "vector").toArrow()
    matrix = padded(table["vector"].combine_chunks(), width)
    fixed = (table[c].to_pylist() for c in ("anchor", "vec_id", "label"))
    return [(*x, vector) for *x, vector in zip(*fixed, matrix.astype(np.int32))]
