"""Energy distance between two samples and its permutation or resampling test.

The statistic needs the distance of every pair of rows. Rows are spread over equal
blocks by key hash and sent to the tasks of all block pairs they belong to; a task
computes its distance tiles with array arithmetic and returns only weighted sums, so
no pair ever becomes a row. Every replicate is one more weight per row and sample,
hence each distance is computed once for all replicates. Memory of a
task is bounded, but work grows with the square of the rows.

Many points in the plane (two features) are summed by cells: near cells point by point, distant
ones through Chebyshev nodes, to about 1e-11 of a distance; the work grows with the power 4/3 of the rows.

One-dimensional `linear` energy needs no pairs: it is the integral of (F - G)^2 over the
two distribution functions, summed while range-sorted partitions pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import by_name
from ..functions.materialize import materialize
from ..functions.order import row_index
from ..functions.rng import uniform

BLOCK_BYTES = 64 << 20  # coordinates and weights of one block
TILE_CELLS = 1 << 18  # a square tile that stays in the cache
PRODUCT_WIDTH = 8  # from here on distances are a matrix product
CLOSE = 1e-5  # share of the squared lengths below which the product has too few digits left
CLOSE_PAIRS = 1 << 14
PAIR_ROWS = 50_000  # above this, points in the plane are summed by cells
CELL_ROWS = 25  # times the cube root of the rows: points in a cell at most
CELLS_A_BLOCK = 8
FAR = [(16.0, 8), (3.5, 14)]  # cells that many half sides apart: Chebyshev nodes an axis
DEPTH = 26  # halvings of the plane
MIN_BLOCK_ROWS = 256
MAX_TASKS = 20_000

_SUMS = "rep int, s11 double, s22 double, s12 double, z11 double, z22 double, z12 double"


def _blocks(rows: int, width: int, reps: int, parallelism: int) -> int:
    """Enough blocks to bound a task's memory and, for small tables, to keep all cores busy."""
    by_memory = math.ceil(rows * 8 * (width + 2 * reps) / BLOCK_BYTES)
    by_cores = min(math.ceil(math.sqrt(16 * parallelism)), math.ceil(rows / MIN_BLOCK_ROWS))
    return max(1, by_memory, by_cores)


def _tile_squares(a: np.ndarray, b: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Squared distances; wide rows by one matrix product, whose close pairs are then taken from the gaps."""
    if a.shape[1] < PRODUCT_WIDTH:
        total = np.zeros((len(a), len(b)))
        for k in range(a.shape[1]):
            gap = a[:, k][:, None] - b[:, k][None, :]
            gap *= gap
            total += gap
        return total
    p, q = a - center, b - center
    pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
    total = np.column_stack([p, pp, np.ones(len(p))]) @ np.column_stack([-2.0 * q, np.ones(len(q)), qq]).T
    if not total.min() > CLOSE * (pp.max() + qq.max()):  # also for NaN
        i, j = np.nonzero(total <= CLOSE * (pp[:, None] + qq))
        for at in range(0, len(i), CLOSE_PAIRS):
            part = slice(at, at + CLOSE_PAIRS)
            gap = a[i[part]] - b[j[part]]
            total[i[part], j[part]] = np.einsum("ij,ij->i", gap, gap)
    return total


def _pair_sums(x, y, left, right, same: bool, log: bool) -> np.ndarray:
    """s11, s22, s12 and the counts z11, z22, z12 of equal rows, per replicate; `left` and `right` hold (w1, w2)."""
    sums = np.zeros((6, left[0].shape[1]))
    center = np.nan_to_num(x.mean(axis=0), posinf=0.0, neginf=0.0)
    split = all((w1 + w2 == 1).all() for w1, w2 in (left, right))  # each row in one part
    columns = np.column_stack([right[0], np.ones(len(y)) if split else right[1]])
    reps, side = sums.shape[1], max(1, math.isqrt(TILE_CELLS))
    for at in range(0, len(x), side):
        a1, a2 = (w[at : at + side] for w in left)
        for to in range(at if same else 0, len(y), side):
            d = _tile_squares(x[at : at + side], y[to : to + side], center)
            both = same and at == to
            if both:
                np.fill_diagonal(d, 1.0)  # a row has no distance to itself
            zero = np.argwhere(d == 0.0) if not d.min() > 0.0 else ()
            if log:
                if len(zero):
                    d[zero[:, 0], zero[:, 1]] = 1.0
                np.log(d, out=d)
                d *= 0.5
            else:
                np.sqrt(d, out=d)
                if both:
                    np.fill_diagonal(d, 0.0)
            tile = np.zeros_like(sums)
            m = d @ columns[to : to + side]
            m1, m2 = m[:, :reps], m[:, reps:] - m[:, :reps] if split else m[:, reps:]
            tile[0], tile[1] = (a1 * m1).sum(axis=0), (a2 * m2).sum(axis=0)
            tile[2] = (a1 * m2).sum(axis=0) + (a2 * m1).sum(axis=0)
            for cut in range(0, len(zero), CLOSE_PAIRS):
                i, j = zero[cut : cut + CLOSE_PAIRS].T
                z1, z2 = (w[to : to + side][j] for w in right)
                tile[3] += (a1[i] * z1).sum(axis=0)
                tile[4] += (a2[i] * z2).sum(axis=0)
                tile[5] += (a1[i] * z2 + a2[i] * z1).sum(axis=0)
            sums += tile / 2.0 if both else tile  # there each unordered pair was met twice
    return sums


def _block_sums(log: bool):
    """Task function: weighted distance sums of one block pair, one row per replicate."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
        left = pdf[pdf["side"] == 0]
        right = left if same else pdf[pdf["side"] == 1]
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({c.split()[0]: [] for c in _SUMS.split(", ")})
        x, y = (np.stack(part["v"].to_numpy()).astype(np.float64) for part in (left, right))
        l1, l2, r1, r2 = (
            np.stack(part[w].to_numpy()).astype(np.float64) for part in (left, right) for w in ("w1", "w2")
        )
        return _sums_frame(_pair_sums(x, y, (l1, l2), (r1, r2), same, log))

    return run


def _sums_frame(sums: np.ndarray) -> pd.DataFrame:
    names = [c.split()[0] for c in _SUMS.split(", ")]
    return pd.DataFrame(dict(zip(names, [np.arange(sums.shape[1]), *sums])))


def _resampled_pairs(weighted: DataFrame) -> DataFrame:
    """(rep, p11, p22, p12): pairs of copies of the same row; their distance is zero."""
    per = weighted.select(F.posexplode(F.arrays_zip("w1", "w2")).alias("rep", "w")).select("rep", "w.*")
    return per.groupBy("rep").agg(
        F.sum(F.col("w1") * (F.col("w1") - 1) / 2.0).alias("p11"),
        F.sum(F.col("w2") * (F.col("w2") - 1) / 2.0).alias("p22"),
        F.sum((F.col("w1") * F.col("w2")).cast("double")).alias("p12"),
    )


_SPANS = (
    "part int, rep int, low double, high double, w1 bigint, w2 bigint, gap1 double, gap2 double, "
    "dup double, head bigint, tail bigint, whole boolean, bad boolean"
)


def _choose2(c):
    return c * (c - 1) / 2.0


def _span_sums(n: int, m: int):
    """Task function over one sorted partition: per replicate, what joins it to its neighbours.

    With d the difference of both distribution functions, counted from the partition's start, and g the gap to
    the next value: gap1 sums g*d, gap2 sums g*d*d. `head` and `tail` are the weights of the partition's first
    and last value (`whole`: these are one); `dup` counts pairs of equal rows of the values between them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = low = high = head = w1 = None
        bad = False
        for b in batches:
            if b.num_rows == 0:
                continue
            reps = len(b.column(1)[0])
            if w1 is None:
                part = b.column(3)[0].as_py()
                w1, w2, tail = (np.zeros(reps, np.int64) for _ in range(3))
                gap1, gap2, dup = (np.zeros(reps) for _ in range(3))
            step = max(1, TILE_CELLS // reps)
            for at in range(0, b.num_rows, step):
                piece = b.slice(at, step)
                x = piece.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
                a1, a2 = (piece.column(k).flatten().to_numpy().reshape(len(x), reps).astype(np.int64) for k in (1, 2))
                fine = np.isfinite(x)
                if not fine.all():  # no distance to such a row is a number; it equals none but its own copies
                    bad = True
                    dup += _choose2(a1[~fine] + a2[~fine]).sum(axis=0)
                    x, a1, a2 = x[fine], a1[fine], a2[fine]
                    if len(x) == 0:
                        continue
                if low is None:
                    low = high = x[0]
                gaps = np.diff(x, prepend=high)
                up1, up2 = w1 + np.cumsum(a1, axis=0), w2 + np.cumsum(a2, axis=0)
                d = np.vstack([w1, up1[:-1]]) / n - np.vstack([w2, up2[:-1]]) / m
                gap1 += gaps @ d
                gap2 += gaps @ (d * d)
                w1, w2, high = up1[-1], up2[-1], x[-1]
                begins = np.flatnonzero(gaps)  # rows with a new value
                if gaps[0] == 0:
                    runs = np.add.reduceat(a1 + a2, np.append(0, begins), axis=0)
                    runs[0] += tail
                else:
                    runs = np.vstack([tail, np.add.reduceat(a1 + a2, begins, axis=0)])
                closed, tail = runs[:-1], runs[-1]
                if head is None and len(closed):
                    head, closed = closed[0], closed[1:]
                dup += _choose2(closed).sum(axis=0)
        if w1 is None:
            return
        whole = head is None
        same = [part, low, high, whole, bad]
        names = ["part", "low", "high", "whole", "bad"]
        types = [pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_()]
        own = {name: pa.array([value] * reps, kind) for name, value, kind in zip(names, same, types)}
        own |= {"rep": pa.array(np.arange(reps), pa.int32()), "head": pa.array(tail if whole else head)}
        own |= {name: pa.array(value) for name, value in (("w1", w1), ("w2", w2), ("gap1", gap1), ("gap2", gap2), ("dup", dup), ("tail", tail))}
        order = [c.split()[0] for c in _SPANS.split(", ")]
        yield pa.RecordBatch.from_arrays([own[c] for c in order], names=order)

    return run


def _spans_joined(n: int, m: int):
    """Task function: one replicate's partitions, one row each, in order -> its energy and pairs of equal rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        energy, pairs = 0.0, float(pdf["dup"].sum())
        w1 = w2 = open_run = 0
        high = None
        for r in pdf[pdf["low"].notna()].itertuples():
            d = w1 / n - w2 / m
            if high is not None:
                energy += (r.low - high) * d * d
            energy += (r.high - r.low) * d * d + 2 * d * r.gap1 + r.gap2
            if high != r.low:
                pairs += _choose2(open_run)
                open_run = 0
            open_run += r.head
            if not r.whole:
                pairs += _choose2(open_run)
                open_run = r.tail
            w1, w2, high = w1 + r.w1, w2 + r.w2, r.high
        pairs += _choose2(open_run)
        energy = None if pdf["bad"].any() else energy
        return pd.DataFrame({"rep": [pdf["rep"].iloc[0]], "energy": [energy], "duplicates": [int(pairs)]})

    return run


def _ordered_energies(weighted: DataFrame, n: int, m: int) -> DataFrame:
    """(rep, energy, duplicates) of one-dimensional rows under `linear`, by order instead of by pairs.

    Equal values may span partitions, so a value with many rows is spread by key. A NULL, NaN or infinite value
    makes the energy NULL.
    """
    flat = weighted.select(F.get("v", F.lit(0)).alias("x"), "w1", "w2", "key").orderBy("x", "key")
    spans = flat.select("x", "w1", "w2", F.spark_partition_id().alias("part")).mapInArrow(_span_sums(n, m), _SPANS)
    return spans.groupBy("rep").applyInPandas(_spans_joined(n, m), "rep int, energy double, duplicates bigint")


def _morton(low: Sequence[float], span: float):
    """Position of a point on a curve through the squares of 26 halvings."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        code = np.zeros(len(x), np.int64)
        for turn, v in enumerate((x, y)):
            k = np.clip((v.to_numpy() - low[turn]) / span * (1 << DEPTH), 0, (1 << DEPTH) - 1).astype(np.int64)
            for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
                k = (k | (k << shift)) & mask
            code |= k << turn
        return pd.Series(code)

    return F.pandas_udf(run, "bigint")


def _squares(code: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of sorted codes: squares halved until each holds at most `limit` rows."""
    out, todo = [], [(0, len(code), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low <= limit or depth == DEPTH:
            out.append((low, high))
            continue
        shift = 2 * (DEPTH - depth - 1)
        first = code[low] >> (shift + 2) << 2
        cuts = low + np.searchsorted(code[low:high] >> shift, first + np.arange(5))
        todo += [(a, b, depth + 1) for a, b in zip(cuts, cuts[1:]) if a < b]
    return out


_CELLS = (
    "cell bigint, box array<double>, v array<double>, w1 array<double>, w2 array<double>, z array<double>"
)


def _as_cells(limit: int):
    """Task function over one sorted partition: equal points merged, then one row per square with its points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts).combine_chunks()
        part = t.column("part")[0].as_py()
        code, x, y = (t.column(c).to_numpy() for c in ("code", "x", "y"))
        w1, w2 = (t.column(c).chunk(0).flatten().to_numpy().reshape(len(x), -1).astype(np.float64) for c in ("w1", "w2"))
        begins = np.append(True, (np.diff(x) != 0) | (np.diff(y) != 0)).nonzero()[0]
        m1, m2 = (np.add.reduceat(w, begins, axis=0) for w in (w1, w2))
        # pairs of equal rows; those of copies of one row are counted with the resamples
        z = [
            _choose2(m1) - np.add.reduceat(_choose2(w1), begins, axis=0),
            _choose2(m2) - np.add.reduceat(_choose2(w2), begins, axis=0),
            m1 * m2 - np.add.reduceat(w1 * w2, begins, axis=0),
        ]
        code, v = code[begins], np.column_stack([x[begins], y[begins]])
        for no, (a, b) in enumerate(_squares(code, limit)):
            row = {
                "cell": [(part << 32) + no],
                "box": [np.concatenate([v[a:b].min(axis=0), v[a:b].max(axis=0)])],
                "v": [v[a:b].ravel()], "w1": [m1[a:b].ravel()], "w2": [m2[a:b].ravel()],
                "z": [np.concatenate([k[a:b].sum(axis=0) for k in z])],
            }
            yield pa.RecordBatch.from_pydict({c: pa.array(k) for c, k in row.items()})

    return run


def _apart(box: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Gaps between a box (low x, low y, high x, high y) and others, in units of the larger half side."""
    gap = np.hypot(*np.maximum(0.0, np.maximum(boxes[:, :2] - box[2:], box[:2] - boxes[:, 2:])).T)
    half = np.maximum((box[2:] - box[:2]).max(), (boxes[:, 2:] - boxes[:, :2]).max(axis=1)) / 2.0
    with np.errstate(divide="ignore"):
        return np.where(gap > 0.0, gap / half, 0.0)


def _nodes(v: np.ndarray, box: np.ndarray, weights: Sequence[np.ndarray], count: int):
    """Chebyshev nodes of a box with the weights that stand for its points; few points stand for themselves."""
    if len(v) <= count * count:
        return v, *weights
    at = (2.0 * np.arange(count) + 1.0) * np.pi / (2.0 * count)
    axes, shares = [], []
    for k in range(2):
        mid, half = (box[k] + box[k + 2]) / 2.0, (box[k + 2] - box[k]) / 2.0
        if half == 0.0:
            axes.append(np.array([mid]))
            shares.append(np.ones((len(v), 1)))
            continue
        turn = np.arccos(np.clip((v[:, k] - mid) / half, -1.0, 1.0))
        order = np.arange(1, count)
        axes.append(mid + half * np.cos(at))
        shares.append((1.0 + 2.0 * np.cos(turn[:, None] * order) @ np.cos(order[:, None] * at)) / count)
    grid = np.stack(np.meshgrid(*axes, indexing="ij"), axis=-1).reshape(-1, 2)
    basis = (shares[0][:, :, None] * shares[1][:, None, :]).reshape(len(v), -1)
    return grid, *[basis.T @ w for w in weights]


def _unpacked(pdf: pd.DataFrame) -> list[tuple]:
    """(cell, box, points, w1, w2) of each row."""
    return [
        (r.cell, np.asarray(r.box), v := np.asarray(r.v).reshape(-1, 2), *(np.asarray(w).reshape(len(v), -1) for w in (r.w1, r.w2)))
        for r in pdf.itertuples()
    ]


def _with_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per cell and row of FAR the nodes that stand for it."""
    for pdf in batches:
        out = []
        for cell, box, v, w1, w2 in _unpacked(pdf):
            for level, (_, count) in enumerate(FAR):
                grid, *weights = _nodes(v, box, (w1, w2), count)
                out.append((cell, level, box, grid.ravel(), *[w.ravel() for w in weights]))
        yield pd.DataFrame(out, columns=["cell", "level", "box", "v", "w1", "w2"])


def _far_sums(log: bool):
    """Task function: one block pair of cells, each pair of distant cells by its nodes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
        level = pdf["level"].iloc[0]
        low, high = FAR[level][0], FAR[level - 1][0] if level else np.inf
        left = _unpacked(pdf[pdf["side"] == 0])
        right = left if same else _unpacked(pdf[pdf["side"] == 1])
        sums = None
        if left and right:
            ids, boxes = np.array([c[0] for c in right]), np.stack([c[1] for c in right])
            for cell, box, v, w1, w2 in left:
                apart = _apart(box, boxes)
                met = np.flatnonzero((apart >= low) & ((apart < high) | (level == 0)) & ((ids > cell) | (not same)))
                for at in range(0, len(met), 256):
                    y, r1, r2 = (np.concatenate(k) for k in zip(*[right[i][2:] for i in met[at : at + 256]]))
                    found = _pair_sums(v, y, (w1, w2), (r1, r2), False, log)
                    sums = found if sums is None else sums + found
        return _sums_frame(np.zeros((6, 0)) if sums is None else sums)

    return run


def _near_sums(log: bool):
    """Task function: a block of cells against the near cells sent to it, point by point."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = _unpacked(pdf)
        ids, boxes = np.array([c[0] for c in cells]), np.stack([c[1] for c in cells])
        sums = np.zeros((6, cells[0][3].shape[1]))
        for (cell, box, v, w1, w2), own, z in zip(cells, pdf["own"], pdf["z"]):
            if not own:
                continue
            sums += _pair_sums(v, v, (w1, w2), (w1, w2), True, log)
            sums[3:] += np.asarray(z).reshape(3, -1)
            for i in np.flatnonzero((_apart(box, boxes) < FAR[-1][0]) & (ids > cell)):
                sums += _pair_sums(v, cells[i][2], (w1, w2), cells[i][3:], False, log)
        return _sums_frame(sums)

    return run


def _sent_near(ids: np.ndarray, boxes: np.ndarray):
    """Task function: a cell goes to its own block and to those of near cells with a smaller number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(len(pdf)):
                row = pdf.iloc[k]
                no = int(np.searchsorted(ids, row["cell"]))
                near = np.flatnonzero(_apart(np.asarray(row["box"]), boxes[: no + 1]) < FAR[-1][0])
                home = np.unique(np.append(near, no) // CELLS_A_BLOCK)
                out = pd.DataFrame({"home": home, "own": home == no // CELLS_A_BLOCK})
                for c in pdf.columns:
                    out[c] = [row[c]] * len(home)
                yield out

    return run


def _cell_sums(weighted: DataFrame, extent, rows: int, reps: int, log: bool) -> DataFrame:
    """Sums of `_SUMS` for points in the plane: near cells point by point, distant ones by interpolation.

    Both kernels are smooth away from zero; on boxes FAR[.][0] half sides apart, that many Chebyshev nodes an axis
    reproduce them to about 1e-11 of their size. The work grows with the power 4/3 of the rows.
    """
    spark = weighted.sparkSession
    flat = weighted.select(F.col("v")[0].alias("x"), F.col("v")[1].alias("y"), "w1", "w2", "key")
    flat = flat.where(F.abs("x") < math.inf).where(F.abs("y") < math.inf).select(
        (F.col("x") + 0.0).alias("x"), (F.col("y") + 0.0).alias("y"), "w1", "w2", "key"
    )
    span = max(extent["hx"] - extent["lx"], extent["hy"] - extent["ly"]) or 1.0
    flat = flat.withColumn("code", _morton((extent["lx"], extent["ly"]), span)("x", "y"))
    parallel = spark.sparkContext.defaultParallelism
    parts = max(parallel, math.ceil(rows * 16 * (reps + 2) / BLOCK_BYTES))
    placed = flat.repartitionByRange(parts, "code", "x", "y", "key").sortWithinPartitions("code", "x", "y")
    placed = placed.select("code", "x", "y", "w1", "w2", F.spark_partition_id().alias("part"))
    limit = max(1, round(CELL_ROWS * rows ** (1 / 3)))
    cells = materialize(placed.mapInArrow(_as_cells(limit), _CELLS))
    # a few numbers per cell, and cells grow with the power 2/3 of the rows
    known = cells.select("cell", "box").orderBy("cell").collect()
    ids, boxes = np.array([r["cell"] for r in known]), np.array([r["box"] for r in known])

    sent = cells.mapInPandas(_sent_near(ids, boxes), "home bigint, own boolean, " + _CELLS)
    homes = math.ceil(len(ids) / CELLS_A_BLOCK)
    near = sent.repartition(min(2 * homes, MAX_TASKS), "home").groupBy("home").applyInPandas(_near_sums(log), _SUMS)

    nodes = cells.mapInPandas(
        _with_nodes, "cell bigint, level int, box array<double>, v array<double>, w1 array<double>, w2 array<double>"
    )
    b = max(math.ceil(len(ids) * 8 * FAR[-1][1] ** 2 * (2 + 2 * reps) / BLOCK_BYTES), math.ceil(math.sqrt(8 * parallel)))
    pairs = _paired(nodes, F.col("cell"), b, ["cell", "level", "box", "v", "w1", "w2"])
    pairs = pairs.repartition(min(2 * b * (b + 1), MAX_TASKS), "level", "bi", "bj")
    return near.unionByName(pairs.groupBy("level", "bi", "bj").applyInPandas(_far_sums(log), _SUMS))


def _paired(df: DataFrame, key: Column, b: int, cols: Sequence[str]) -> DataFrame:
    """Each row once for every block pair (bi, bj) that its block is part of."""
    own = F.pmod(F.xxhash64(key), F.lit(b)).cast("int")
    sent = df.select(*cols, own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("other"))
    return sent.select(
        F.least("own", "other").alias("bi"),
        F.greatest("own", "other").alias("bj"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        *cols,
    )


def _extent(weighted: DataFrame):
    """Bounds of the points in the plane, and whether a row has no place there."""
    x, y = F.col("v")[0], F.col("v")[1]
    fine = (F.abs(x) < math.inf) & (F.abs(y) < math.inf)  # NaN is above all numbers
    bounds = [f(F.when(fine, c)).alias(n) for n, f, c in (("lx", F.min, x), ("hx", F.max, x), ("ly", F.min, y), ("hy", F.max, y))]
    return weighted.agg(*bounds, (F.count_if(fine) < F.count("*")).alias("bad")).first()


def _energies(weighted: DataFrame, rows: int, reps: int, width: int, n: int, m: int, method: str) -> DataFrame:
    """(rep, energy, duplicates) from rows (key, v, w1, w2) with one weight per replicate."""
    if method not in ("log", "linear"):
        raise ValueError(f"method must be 'log' or 'linear', not {method!r}")
    if method == "linear" and width == 1 and n and m:
        return _ordered_energies(weighted, n, m)
    log, extent = method == "log", None
    if width == 2 and rows > PAIR_ROWS and n and m:
        extent = _extent(weighted)
    if extent and extent["lx"] is not None and max(abs(extent[c]) for c in ("lx", "hx", "ly", "hy")) < 1e150:
        parts = _cell_sums(weighted, extent, rows, reps, log)
    else:
        b = _blocks(rows, width, reps, weighted.sparkSession.sparkContext.defaultParallelism)
        sent = _paired(weighted, F.col("key"), b, ["v", "w1", "w2"])
        # a block pair is few bytes but much work, so the number of tasks is fixed rather than sized by bytes
        sent = sent.repartition(min(b * (b + 1), MAX_TASKS), "bi", "bj")
        parts = sent.groupBy("bi", "bj").applyInPandas(_block_sums(log), _SUMS)
        extent = None
    total = parts.groupBy("rep").agg(*[F.when(F.count(c) == F.count("*"), F.sum(c)).alias(c) for c in ("s11", "s22", "s12", "z11", "z22", "z12")])
    total = total.join(_resampled_pairs(weighted), "rep")
    duplicates = sum((by_name(a) + by_name(p) for a, p in (("z11", "p11"), ("z22", "p22"), ("z12", "p12"))), F.lit(0.0))
    energy = F.col("s12") / F.lit(float(n * m)) - F.col("s11") / F.lit(float(n * n)) - F.col("s22") / F.lit(float(m * m))
    if log:  # a zero distance has no logarithm
        energy = F.when(duplicates == 0, energy)
    if extent and extent["bad"]:
        energy = F.lit(None).cast("double")
    return total.select("rep", energy.alias("energy"), duplicates.cast("bigint").alias("duplicates"))


def _vectors(df: DataFrame, sample: str, features: str | Sequence[str], key: str, first) -> DataFrame:
    """(key, first, v) with v a vector of doubles; `features` is an array column or a list of columns."""
    v = by_name(features).cast("array<double>") if isinstance(features, str) else F.array(*[by_name(c).cast("double") for c in features])
    return df.select(by_name(key).alias("key"), (by_name(sample) == F.lit(first)).alias("first"), v.alias("v"))


def _sizes(vectors: DataFrame) -> tuple[int, int, int]:
    n, m, width = vectors.agg(F.count_if("first"), F.count_if(~F.col("first")), F.max(F.size("v"))).first()
    return n, m, width


def energy(df: DataFrame, sample: str, features, key: str, first, method: str = "log") -> DataFrame:
    """(energy, duplicates): sum d(x,y)/nm - sum d(x,x')/n^2 - sum d(y,y')/m^2 over unordered pairs within a sample.

    `log` takes the logarithm of the Euclidean distance; where equal rows make it infinite
    the energy is NULL and `duplicates` counts the pairs. A row with a NULL, NaN or infinite component has no
    distances: the energy is NULL.
    """
    vectors = _vectors(df, sample, features, key, first)
    n, m, width = _sizes(vectors)
    weighted = vectors.select("key", "v", *_own_weights())
    return _energies(weighted, n + m, 1, width, n, m, method).select("energy", "duplicates")


def _own_weights() -> list[Column]:
    one = F.when(F.col("first"), 1).otherwise(0)
    return [F.array(one).alias("w1"), F.array(F.lit(1) - one).alias("w2")]


def _standardized(vectors: DataFrame, width: int) -> DataFrame:
    """A constant feature becomes 0 and adds nothing."""
    row = vectors.agg(*[f(F.col("v")[k]) for k in range(width) for f in (F.avg, F.stddev_pop)]).first()
    scaled = [(F.col("v")[k] - F.lit(row[2 * k])) / F.lit(row[2 * k + 1] or 1.0) for k in range(width)]
    return vectors.withColumn("v", F.array(*scaled))


def _permutation_limits(vectors: DataFrame, rows: int, n: int, nboot: int, draws: Column) -> list[float]:
    """Per replicate the n-th smallest draw; each is found in one narrow slice of the unit interval."""
    bins = min(max(rows // 1_000, 1), 1 << 16)
    long = vectors.select(F.posexplode(draws).alias("rep", "u")).withColumn("bin", F.floor(F.col("u") * bins))
    counts = long.groupBy("rep", "bin").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("rep").orderBy("bin"))  # at most `bins` rows per replicate
    slices = (
        counts.withColumn("upto", upto)
        .where((F.col("upto") >= n) & (F.col("upto") - F.col("c") < n))
        .select("rep", "bin", (F.lit(n) - F.col("upto") + F.col("c")).alias("wanted"))
    )
    inside = long.join(F.broadcast(slices), ["rep", "bin"])  # one slice per replicate
    ranked = inside.withColumn("no", F.row_number().over(Window.partitionBy("rep").orderBy("u")))
    found = ranked.where(F.col("no") == F.col("wanted")).select("rep", "u").collect()
    return [r["u"] for r in sorted(found, key=lambda r: r["rep"])]


def _permuted(vectors: DataFrame, rows: int, n: int, nboot: int, seed) -> DataFrame:
    """Weights of the observed split, then of `nboot` random splits with n rows in the first part."""
    draws = F.transform(
        F.sequence(F.lit(1), F.lit(nboot)),
        lambda r: uniform(seed, F.concat(F.lit("perm:"), r.cast("string")), F.col("key")),
    )
    limits = _permutation_limits(vectors, rows, n, nboot, draws)
    in_first = F.zip_with(draws, F.lit(limits), lambda u, t: F.when(u <= t, 1).otherwise(0))
    own = F.when(F.col("first"), 1).otherwise(0)
    weighted = vectors.select("key", "v", F.concat(F.array(own), in_first).alias("w1"))
    return weighted.select("key", "v", "w1", F.transform("w1", lambda w: F.lit(1) - w).alias("w2"))


def _resampled(vectors: DataFrame, rows: int, n: int, nboot: int, seed) -> DataFrame:
    """Weights of the observed split, then of `nboot` resamples with replacement from all rows."""
    placed = row_index(vectors, [F.desc("first"), "key"])
    draws = vectors.sparkSession.range(nboot * rows).select(
        (F.floor(F.col("id") / rows) + 1).cast("int").alias("rep"), (F.col("id") % rows).alias("slot")
    )
    drawn = draws.select(
        "rep",
        F.when(F.col("slot") < n, 1).otherwise(0).alias("s1"),
        (F.floor(uniform(seed, "boot", "rep", "slot") * F.lit(float(rows))) + 1).cast("bigint").alias("row_no"),
    )
    per = drawn.groupBy("row_no", "rep").agg(F.sum("s1").alias("c1"), F.sum(F.lit(1) - F.col("s1")).alias("c2"))
    # at most nboot entries per row
    maps = per.groupBy("row_no").agg(
        F.map_from_entries(F.collect_list(F.struct("rep", F.struct("c1", "c2")))).alias("m")
    )
    own = F.when(F.col("first"), 1).otherwise(0)
    reps = F.sequence(F.lit(1), F.lit(nboot))

    def weights(name: str, observed: Column) -> Column:
        drawn_count = F.transform(reps, lambda r: F.coalesce(F.try_element_at(F.col("m"), r)[name], F.lit(0)).cast("int"))
        return F.concat(F.array(observed), drawn_count)

    return placed.join(maps, "row_no", "left").select(
        "key", "v", weights("c1", own).alias("w1"), weights("c2", F.lit(1) - own).alias("w2")
    )


def estat_replicates(
    df: DataFrame, sample: str, features, key: str, first, nboot: int, method: str = "log", replace: bool = False, seed=0
) -> DataFrame:
    """(rep, energy, duplicates) on pooled-standardised features; rep 0 is the observed split."""
    vectors = _vectors(df, sample, features, key, first)
    n, m, width = _sizes(vectors)
    vectors = _standardized(vectors, width)
    make = _resampled if replace else _permuted
    weighted = materialize(make(vectors, n + m, n, nboot, seed))
    return _energies(weighted, n + m, nboot + 1, width, n, m, method)


def estat(
    df: DataFrame, sample: str, features, key: str, first, nboot: int = 1000, method: str = "log", replace: bool = False, seed=0
) -> DataFrame:
    """(energy, p_value): share of replicates whose energy is at least the observed one.

    A replicate without an energy (equal rows under `log`) leaves the p-value undefined: NULL.
    """
    reps = estat_replicates(df, sample, features, key, first, nboot, method, replace, seed)
    # one row per replicate
    observed = F.max(F.when(F.col("rep") == 0, F.col("energy"))).alias("energy")
    values = F.collect_list(F.when(F.col("rep") > 0, F.col("energy"))).alias("boot")
    both = reps.agg(observed, values)
    share = F.size(F.filter("boot", lambda e: e >= F.col("energy"))) / F.lit(float(nboot))
    return both.select("energy", F.when(F.col("energy").isNotNull() & (F.size("boot") == nboot), share).alias("p_value"))


def estat2d(df: DataFrame, sample: str, x: str, y: str, key: str, first, **options) -> DataFrame:
    return estat(df, sample, [x, y], key, first, **options)
