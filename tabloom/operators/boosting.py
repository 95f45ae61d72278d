"""Boosted regression trees on histograms, for squared loss.

Features are cut into bins once, at approximate quantiles. Rows that fall into the same bins of all features are alike to
every tree, so they are one cell with its rows and their sum; predictions hold per cell. Each level of a tree needs the
gradients per node, feature and bin, which is one aggregate over the cells, and is grown from that small table on the
driver: splits by second-order gain, leaves -G / (H + lambda).

Up to LOCAL_CELLS cells are held by the driver as arrays. More stay a Spark table: an aggregate per level, and one written
table per round that carries the predictions on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name
from ..functions.materialize import materialize
from ..functions.selection import Profile, profile

BINS = 64
LOCAL_CELLS = 1 << 20
_LEAST_GAIN = 1e-9


@dataclass
class Tree:
    """Nodes by number, the children of k being 2k + 1 and 2k + 2. `feature` is -1 in a leaf; values go left up to bin `at`."""

    feature: np.ndarray
    at: np.ndarray
    weight: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bin numbers."""
        node = np.zeros(len(bins), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return node
            own = node[inner]
            right = bins[inner, self.feature[own]] > self.at[own]
            node[inner] = 2 * own + 1 + right

    def column(self, values: np.ndarray | None, bins: Sequence[Column], node: int = 0) -> Column:
        """The node number of a row, or its entry in `values`, as a Spark expression."""
        if self.feature[node] < 0:
            return F.lit(node) if values is None else F.lit(float(values[node]))
        left, right = (self.column(values, bins, 2 * node + k) for k in (1, 2))
        return F.when(bins[self.feature[node]] > int(self.at[node]), right).otherwise(left)


@dataclass
class Boosted:
    """A fitted model: `cuts` per feature are the largest values of its bins but the last; `trees` have shrunk weights."""

    features: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self, missing: float) -> list[Column]:
        """The bin of each feature; a missing one counts as the value `missing`."""
        def place(name: str, cuts: np.ndarray) -> Column:
            value = F.coalesce(F.nanvl(by_name(name).cast("double"), F.lit(None).cast("double")), F.lit(float(missing)))
            edges = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
            return F.size(F.filter(edges, lambda c: value > c))

        return [place(name, cuts) for name, cuts in zip(self.features, self.cuts)]

    def predict(self, wanted: Column, missing: float) -> Column:
        """The prediction of rows where `wanted` is true, NULL elsewhere. Bins go to Python, for these rows only."""
        base, trees = self.base, self.trees

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            asked = columns[0].notna().to_numpy()
            out = np.full(len(asked), np.nan)
            bins = np.column_stack([c.to_numpy()[asked].astype(np.int64) for c in columns])
            total = np.full(len(bins), base)
            for tree in trees:
                total += tree.weight[tree.leaves(bins)]
            out[asked] = total
            return pd.Series(out)

        if not self.features:
            return F.when(wanted, F.lit(base))
        return F.nanvl(score(*[F.when(wanted, b) for b in self.bins(missing)]), F.lit(None).cast("double"))


class LocalCells:
    """Cells as arrays: bins, rows and their sum, and what is predicted so far."""

    def __init__(self, bins: np.ndarray, rows: np.ndarray, sums: np.ndarray, base: float):
        self.bins, self.rows, self.sums, self.predicted = bins, rows, sums, np.full(len(rows), base)

    def histogram(self, tree: Tree, first: int, nodes: int, width: int) -> np.ndarray:
        """(gradient, rows) by node of the level that starts at `first`, feature and bin."""
        node = tree.leaves(self.bins) - first
        inside = np.flatnonzero(node >= 0)
        gradient = (self.predicted * self.rows - self.sums)[inside]
        out = np.zeros((2, nodes, self.bins.shape[1], width))
        for f in range(self.bins.shape[1]):
            place = node[inside] * width + self.bins[inside, f]
            out[0, :, f] = np.bincount(place, gradient, nodes * width).reshape(nodes, width)
            out[1, :, f] = np.bincount(place, self.rows[inside], nodes * width).reshape(nodes, width)
        return out

    def add(self, tree: Tree) -> None:
        self.predicted += tree.weight[tree.leaves(self.bins)]


class SparkCells:
    """The same over a table of cells (bins, rows, sums, predicted)."""

    def __init__(self, cells: DataFrame, width: int, base: float):
        self.cells = materialize(cells.withColumn("predicted", F.lit(base)))
        self.features = width

    def _bins(self) -> list[Column]:
        return [F.col("bins")[i] for i in range(self.features)]

    def histogram(self, tree: Tree, first: int, nodes: int, width: int) -> np.ndarray:
        level = self.cells.select(
            (tree.column(None, self._bins()) - first).alias("node"),
            (F.col("predicted") * F.col("rows") - F.col("sums")).alias("gradient"),
            "rows",
            F.posexplode("bins").alias("feature", "bin"),
        )
        sums = level.where("node >= 0").groupBy("node", "feature", "bin").agg(F.sum("gradient"), F.sum("rows"))
        out = np.zeros((2, nodes, self.features, width))
        for node, f, b, gradient, rows in sums.collect():  # at most nodes x features x bins rows
            out[:, node, f, b] = gradient, rows
        return out

    def add(self, tree: Tree) -> None:
        more = F.col("predicted") + tree.column(tree.weight, self._bins())
        self.cells = materialize(self.cells.withColumn("predicted", more))


def grow(cells: LocalCells | SparkCells, width: int, depth: int, least_rows: float, penalty: float, step: float) -> Tree:
    """One tree, level by level. A split leaves rows on both sides, `least_rows` at least, and has a gain."""
    size = 2 ** (depth + 1) - 1
    tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size))
    open_ = np.zeros(size, bool)
    open_[0] = True
    for level in range(depth + 1):
        first, nodes = 2**level - 1, 2**level
        if not open_[first : first + nodes].any():
            break
        gradient, rows = cells.histogram(tree, first, nodes, width)
        for k in np.flatnonzero(open_[first : first + nodes]).tolist():
            left, left_rows = np.cumsum(gradient[k], axis=1), np.cumsum(rows[k], axis=1)
            total, all_rows = left[0, -1], left_rows[0, -1]
            tree.weight[first + k] = -step * total / (all_rows + penalty) if all_rows + penalty else 0.0
            if level == depth:
                continue
            right, right_rows = total - left, all_rows - left_rows
            fits = (left_rows >= max(least_rows, 1)) & (right_rows >= max(least_rows, 1))
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left**2 / (left_rows + penalty) + right**2 / (right_rows + penalty) - total**2 / (all_rows + penalty)
            gain = np.where(fits, gain, -np.inf)
            f, at = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[f, at] > _LEAST_GAIN * max(total**2, 1.0) / max(all_rows, 1.0):
                tree.feature[first + k], tree.at[first + k] = f, at
                open_[2 * (first + k) + 1 : 2 * (first + k) + 3] = True
    return tree


def fit_boosted(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    maxIter: int = 200,
    maxDepth: int = 5,
    stepSize: float = 0.01,
    minInstancesPerNode: int = 30,
    penalty: float = 1.0,
    base: float | None = 0.5,
    missing: float = -9999.0,
    known: Profile | None = None,
    local_cells: int | None = None,
) -> Boosted:
    """Fitted on the rows of `df` that have the label. `base` is the first prediction, the mean of the label if None."""
    features = list(features)
    known = known or profile(df, {f: by_name(f) for f in features})
    cuts = []
    for f in features:
        near = [v for _, v in known.grids[f]][:: max(len(known.grids[f]) // BINS, 1)]
        few = sorted({v for _, v in known.grids[f]})
        # one bin per value where the quantiles are few values; the bin of `missing` is its own
        cuts.append(np.array(sorted({missing, *(few[:-1] if len(few) <= BINS else near)}), float))
    model = Boosted(features, cuts, 0.0)
    filled = df.where(by_name(label).isNotNull()).select(F.array(*model.bins(missing)).cast("array<int>").alias("bins"), by_name(label).cast("double").alias("y"))
    cells = materialize(filled.groupBy("bins").agg(F.count("*").cast("double").alias("rows"), F.sum("y").alias("sums")))
    size, rows, total = cells.agg(F.count("*"), F.sum("rows"), F.sum("sums")).first()
    model.base = float(base) if base is not None else (total / rows if rows else 0.0)
    if not size or not features:
        return model
    if size <= (LOCAL_CELLS if local_cells is None else local_cells):
        table = cells.toArrow()
        bins = np.array(table.column("bins").to_pylist(), np.int64)
        order = np.lexsort(bins.T[::-1])  # sums do not depend on the order in which cells arrive
        held = LocalCells(bins[order], table.column("rows").to_numpy()[order], table.column("sums").to_numpy()[order], model.base)
    else:
        held = SparkCells(cells, len(features), model.base)
    width = max(map(len, cuts)) + 1
    for _ in range(maxIter):
        tree = grow(held, width, maxDepth, minInstancesPerNode, penalty, stepSize)
        held.add(tree)
        model.trees.append(tree)
    return model
