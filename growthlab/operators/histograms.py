"""Binned rows of boosted trees as column blocks, and what a task does with them.

A block is (bins: features x cells, y, rows of the cell, is it a training cell, margin). A cell stands for all rows that have
the same bins, label and part: trees of binned rows cannot tell them apart."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame

from growthlab.session import shared_root

# executors need not have this package installed: ship its few functions with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: cells of a block; cells from which on a table is dealt into more tasks; most cells of a task
BLOCK, WORTH, MOST = 1 << 16, 20_000, 500_000
#: trees between two reliable checkpoints of the margins, which keep lineage short
FIXED = 25
#: partials up to which the driver adds them itself
PARTIALS = 64


def packed(kind: str) -> Callable:
    """Arrow batches of (_train, _y, _bins, _n) -> one row of buffers per block."""

    def buffers(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        column = lambda c, t: np.asarray(table.column(c).to_numpy(), dtype=t)
        bins = np.concatenate([b.column("_bins").flatten().to_numpy() for b in held]).reshape(table.num_rows, -1)
        arrays = {"bins": np.ascontiguousarray(bins.T, dtype=kind), "y": column("_y", "f8"), "n": column("_n", "f8"), "train": column("_train", "?")}
        return pa.RecordBatch.from_pydict({k: pa.array([a.tobytes()], pa.binary()) for k, a in arrays.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                yield buffers(held)
                held = []
        if held:
            yield buffers(held)

    return run


def unpacked(kind: str) -> Callable:
    def run(row) -> tuple[np.ndarray, ...]:
        y = np.frombuffer(row.y, dtype="f8")
        bins = np.frombuffer(row.bins, dtype=kind).reshape(-1, len(y))
        return bins, y, np.frombuffer(row.n, dtype="f8"), np.frombuffer(row.train, dtype="?"), np.zeros(len(y))

    return run


def place(bins: np.ndarray, tree: dict[str, list], steps: int) -> np.ndarray:
    """The node of each cell after at most `steps` steps; cuts are bin numbers."""
    feature, cut, left, right = (np.asarray(tree[k]) for k in ("feature", "cut", "left", "right"))
    at, cells = np.zeros(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
    for _ in range(steps):
        f = feature[at]
        down = np.where(bins[f, cells] < cut[at], left[at], right[at])
        at = np.where(f >= 0, down, at)
    return at


def moved(trees: list[dict[str, list]], depth: int) -> Callable:
    """Adds the trees' leaf values to the margins."""

    def run(block: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        *rest, margin = block
        for tree in trees:
            margin = margin + np.asarray(tree["value"])[place(rest[0], tree, depth)]
        return *rest, margin

    return run


def summed(tree: dict[str, list], leaves: list[int], level: int, slope: Callable, loss: Callable | None, shape: tuple[int, int]) -> Callable:
    """Per partition one flat array: gradient and Hessian sums per (leaf, feature, bin) and rows per leaf of the training
    cells, then the validation cells' loss and weight. `slope` and `loss` take y, the margin and a cell's rows."""
    features, n_bins = shape

    def run(blocks: Iterable[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
        size = len(leaves) * features * n_bins
        out = np.zeros(2 * size + len(leaves) + 2)
        spot = np.full(len(tree["feature"]), -1)
        spot[leaves] = np.arange(len(leaves))
        for bins, y, n, train, margin in blocks:
            g, h = slope(y, margin, n)
            node = np.where(train, spot[place(bins, tree, level)], -1)
            used = node >= 0
            node, g, h = node[used], g[used], h[used]
            for f in range(features):
                cell = (node * features + f) * n_bins + bins[f][used]
                out[:size] += np.bincount(cell, g, size)
                out[size : 2 * size] += np.bincount(cell, h, size)
            out[2 * size : -2] += np.bincount(node, n[used], len(leaves))
            if loss is not None:
                lost, weight = loss(y[~train], margin[~train], n[~train])
                out[-2:] += lost.sum(), weight.sum()
        yield out

    return run


class Cells:
    """The cells with the margins of the trees given so far, kept in the executors and made again where lost."""

    def __init__(self, cells: DataFrame, features: int, n_bins: int, depth: int) -> None:
        """`cells`: fixed rows (_train, _y, _bins, _n)."""
        self.shape, self.depth, kind = (features, n_bins), depth, "u1" if n_bins <= 256 else "u2"
        count = cells.count()
        tasks = max(min(-(-count // WORTH), cells.sparkSession.sparkContext.defaultParallelism), -(-count // MOST), 1)
        blocks = cells.repartition(tasks, "_bins", "_y", "_train").mapInArrow(packed(kind), "bins binary, y binary, n binary, train binary")
        self.base = blocks.rdd.map(unpacked(kind)).persist(StorageLevel.MEMORY_AND_DISK)
        self.now, self.old, self.moves, self.tasks = self.base, None, 0, tasks
        shared_root(cells.sparkSession)

    def move(self, tree: dict[str, list]) -> None:
        self.moves += 1
        before, self.now = self.now, self.now.map(moved([tree], self.depth)).persist(StorageLevel.MEMORY_AND_DISK)
        if self.moves % FIXED == 0:
            self.now.checkpoint()
        self.old = before if before is not self.base else None

    def sums(
        self, tree: dict[str, list], leaves: list[int], level: int, slope: Callable, loss: Callable | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gradients and Hessians (leaves x features x bins), rows per leaf, validation loss and weight."""
        parts = self.now.mapPartitions(summed(tree, leaves, level, slope, loss, self.shape))
        size = len(leaves) * self.shape[0] * self.shape[1]
        found = parts.treeReduce(np.add) if self.tasks > PARTIALS else parts.fold(0.0, np.add)
        if self.old is not None:  # the job has made the margins that replace them
            self.old.unpersist()
            self.old = None
        whole = np.zeros(2 * size + len(leaves) + 2) + found
        grads, hessians = whole[: 2 * size].reshape(2, len(leaves), *self.shape)
        return grads, hessians, whole[2 * size : -2], whole[-2:]

    def close(self) -> None:
        for rdd in {self.base, self.now}:
            rdd.unpersist()
