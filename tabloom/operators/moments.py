"""Cross-moment matrices in one pass, and what is solved from them on the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name, replace_columns
from .network import Layer, Network, complete, dense_forward

BUILTIN_WIDTH = 12  # up to here plain sums of products, beyond it partial matrices per task


def cross_moments(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """The matrix of sums v_i * v_j over all rows without a NULL or NaN; the driver sees width x width numbers."""
    width = len(columns)
    df = df.where(complete(columns))
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    out = np.zeros((width, width))
    if width <= BUILTIN_WIDTH:
        row = df.agg(*[F.sum(columns[i] * columns[j]).alias(f"m{n}") for n, (i, j) in enumerate(pairs)]).first()
        for (i, j), v in zip(pairs, row):
            out[i, j] = out[j, i] = v or 0.0
        return out

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            total += x.T @ x
        if total.any():
            i, j = np.triu_indices(width)
            names = ["i", "j", "v"]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names)

    vector = df.select(F.array(*[c.cast("double") for c in columns]).alias("v"))
    cells = vector.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = cells.toArrow()
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v
    return out


def svd_basis(df: DataFrame, cols: Sequence[str], nsvd: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest `nsvd` singular values of the uncentred columns, descending, and their loadings, one per column.

    Signs are fixed so that the largest loading of each component is positive.
    """
    values, vectors = np.linalg.eigh(cross_moments(df, [by_name(c) for c in cols]))
    first = np.argsort(values)[::-1][:nsvd]
    basis = vectors[:, first]
    largest = np.abs(basis).argmax(axis=0)
    return np.sqrt(np.maximum(values[first], 0.0)), basis * np.sign(basis[largest, np.arange(basis.shape[1])])


def svd_standardize(df: DataFrame, cols: Sequence[str], nsvd: int = 30, prefix: str = "svd_") -> DataFrame:
    """Uncentred truncated SVD scores standardised with the population deviation; nsvd 0 skips the SVD."""
    names = list(cols)
    work = df
    if nsvd > 0:
        _, basis = svd_basis(df, cols, nsvd)
        names = [f"{prefix}{k}" for k in range(basis.shape[1])]
        net = Network([Layer("svd", "dense", weight=basis, bias=np.zeros(basis.shape[1]))])
        work = dense_forward(df, net, list(cols), names)
    row = work.agg(*[f(by_name(c)) for c in names for f in (F.avg, F.stddev_pop)]).first()
    scaled = {c: (by_name(c) - F.lit(row[2 * i])) / F.lit(row[2 * i + 1] or 1.0) for i, c in enumerate(names)}
    out = replace_columns(work, scaled)
    return out.drop(*cols) if nsvd > 0 else out


def fit_generator(df: DataFrame, data: Sequence[str], conditions: Sequence[str], name: str = "output") -> Network:
    """Linear conditional generator x = B*y + L*z + c as one dense layer over (z, y).

    B and c come from least squares, L is the symmetric square root of the residual
    covariance; all from one pass of cross moments of (1, y, x).
    """
    ny, nx = len(conditions), len(data)
    m = cross_moments(df, [F.lit(1.0), *[by_name(c) for c in conditions], *[by_name(c) for c in data]])
    rows = max(m[0, 0], 1.0)  # of complete rows; without any the net is zero
    a, cross, square = m[: ny + 1, : ny + 1], m[: ny + 1, ny + 1 :], m[ny + 1 :, ny + 1 :]
    beta = np.linalg.lstsq(a, cross, rcond=None)[0]
    residual = (square - cross.T @ beta - beta.T @ cross + beta.T @ a @ beta) / rows
    values, vectors = np.linalg.eigh((residual + residual.T) / 2)
    root = (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T
    return Network([Layer(name, "dense", weight=np.vstack([root, beta[1:]]), bias=beta[0])])
