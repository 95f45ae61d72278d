"""Dense networks: a weights table and the forward pass over a DataFrame.

A row with a NULL or NaN input has NULL outputs. Three forms of the forward pass give the same numbers:
* `expression`: tiny nets as plain column arithmetic inside code generation,
* `batches`: broadcast weights and one matrix product per Arrow batch,
* `relational`: weights stay a distributed table, each dense layer is a join and a sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import by_name
from ..functions.materialize import materialize
EXPRESSION_WEIGHTS = 64
BROADCAST_BYTES = 1 << 30
TASK_PRODUCTS = 50_000_000_000  # multiplications of a forward pass worth a task of their own
MAX_TASKS = 100_000
WEIGHTS_SCHEMA = "layer string, in_i int, out_j int, w double"  # in_i = -1 holds the bias


@dataclass
class Layer:
    name: str
    kind: str  # dense, relu, sigmoid or dropout
    rate: float = 0.0
    weight: np.ndarray | None = None
    bias: np.ndarray | None = None


def layer_order(config: Mapping[str, Mapping]) -> list[Layer]:
    """Follow `previous` from 'input'; of several successors the first counts."""
    out, at = [], "input"
    while True:
        following = [name for name, layer in config.items() if layer["previous"] == at]
        if not following:
            return out
        at = following[0]
        out.append(Layer(at, config[at]["type"], float(config[at].get("rate", 0.0))))


@dataclass
class Network:
    layers: list[Layer]

    @classmethod
    def from_weights(cls, config: Mapping[str, Mapping], weights: Mapping[str, tuple]) -> "Network":
        """`weights` maps each dense layer to (matrix inputs x outputs, bias)."""
        layers = layer_order(config)
        for layer in layers:
            if layer.kind == "dense":
                w, b = weights[layer.name]
                layer.weight, layer.bias = np.asarray(w, dtype=np.float64), np.asarray(b, dtype=np.float64)
        return cls(layers)

    @classmethod
    def from_frame(cls, config: Mapping[str, Mapping], table: DataFrame) -> "Network":
        """Collect a weights table that fits the broadcast limit; larger ones use `forward_relational`."""
        cells = table.count()
        if cells * 8 > BROADCAST_BYTES:
            raise ValueError(f"{cells} weights do not fit a broadcast; use forward_relational with the table")
        got = table.toPandas()
        weights = {}
        for name, part in got.groupby("layer"):
            w = np.zeros((int(part.in_i.max()) + 1, int(part.out_j.max()) + 1))
            b = np.zeros(w.shape[1])
            inner = part[part.in_i >= 0]
            w[inner.in_i, inner.out_j] = inner.w
            outer = part[part.in_i < 0]
            b[outer.out_j] = outer.w
            weights[name] = (w, b)
        return cls.from_weights(config, weights)

    @property
    def dense(self) -> list[Layer]:
        return [layer for layer in self.layers if layer.kind == "dense"]

    @property
    def outputs(self) -> int:
        return self.dense[-1].weight.shape[1]

    @property
    def size(self) -> int:
        return sum(layer.weight.size + layer.bias.size for layer in self.dense)

    def weights_frame(self, spark: SparkSession) -> DataFrame:
        parts = []
        for layer in self.dense:
            inputs, outputs = layer.weight.shape
            cells = {
                "layer": pa.array([layer.name]).take(pa.array(np.zeros((inputs + 1) * outputs, np.int64))),
                "in_i": np.repeat(np.arange(-1, inputs, dtype=np.int32), outputs),
                "out_j": np.tile(np.arange(outputs, dtype=np.int32), inputs + 1),
                "w": np.concatenate([layer.bias, layer.weight.ravel()]),
            }
            parts.append(pa.table(cells))
        return spark.createDataFrame(pa.concat_tables(parts)).to(spark.createDataFrame([], WEIGHTS_SCHEMA).schema)


def dense_forward(
    df: DataFrame,
    net: Network,
    inputs: Sequence[str],
    outputs: Sequence[str],
    how: str = "auto",
    dtype: str = "float64",
    mc_dropout: bool = False,
    key: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """Append the network's output columns.

    Dropout passes values through unless `mc_dropout` keeps it active; its mask then
    depends on the row key and the seed only.
    """
    if how == "auto":
        tiny = net.size <= EXPRESSION_WEIGHTS and not mc_dropout and dtype == "float64"
        fits = net.size * np.dtype(dtype).itemsize <= BROADCAST_BYTES
        how = "expression" if tiny else "batches" if fits else "relational"
    if how == "expression":
        return _forward_expression(df, net, inputs, outputs)
    if how == "batches":
        if net.size * np.dtype(dtype).itemsize > BROADCAST_BYTES:
            raise ValueError(f"{net.size} weights are too many to broadcast; use the relational form")
        return _forward_batches(df, net, inputs, outputs, dtype, mc_dropout, key, seed)
    if mc_dropout:
        raise ValueError("the relational form has no active dropout")
    return forward_relational(df, net.weights_frame(df.sparkSession), net.layers, inputs, outputs, key)


def spread(df: DataFrame, net: Network, key: str, rows: int | None = None) -> DataFrame:
    """More tasks where the forward pass is heavy: narrow rows come in few partitions. Rows are counted if not given."""
    if net.size <= EXPRESSION_WEIGHTS:
        return df
    rows = df.count() if rows is None else rows
    tasks = min(-(-rows * net.size // TASK_PRODUCTS), MAX_TASKS)
    return df.repartition(tasks, by_name(key)) if tasks > 1 else df


def complete(inputs: Sequence[str | Column]) -> Column:
    """True for a row without a NULL or NaN input."""
    ok = F.lit(True)
    for c in inputs:
        ok = ok & by_name(c).isNotNull() & ~F.isnan(by_name(c).cast("double"))
    return ok


def _forward_expression(df: DataFrame, net: Network, inputs, outputs) -> DataFrame:
    work, names, step = df, list(inputs), 0
    full = complete(inputs)
    for layer in net.layers:
        if layer.kind == "dropout":
            continue
        if layer.kind == "dense":
            values = []
            for j in range(layer.weight.shape[1]):
                total = F.lit(0.0)
                for i, name in enumerate(names):
                    total = total + by_name(name) * F.lit(float(layer.weight[i, j]))
                values.append(total + F.lit(float(layer.bias[j])))
        elif layer.kind == "relu":
            values = [F.greatest(by_name(n), F.lit(0.0)) for n in names]
        elif layer.kind == "sigmoid":
            values = [F.lit(1.0) / (F.lit(1.0) + F.exp(-by_name(n))) for n in names]
        else:
            raise ValueError(f"unknown layer type {layer.kind!r}")
        step += 1
        names = [f"__h{step}_{j}" for j in range(len(values))]
        work = work.select(*map(by_name, df.columns), *[v.alias(n) for v, n in zip(values, names)])
    return work.select(*map(by_name, df.columns), *[F.when(full, by_name(n)).alias(o) for n, o in zip(names, outputs)])


def to_matrix(values: pa.Array, width: int, dtype="float64") -> np.ndarray:
    """An Arrow list column of fixed width as a matrix."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), width).astype(dtype, copy=False)


def to_lists(matrix: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """One list per row, NULL where `missing`."""
    rows, width = matrix.shape
    ends = np.arange(0, (rows + 1) * width, width, dtype=np.int32)
    ends = pa.array(ends, mask=None if missing is None else np.append(missing, False))
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(matrix, dtype=np.float64).ravel()))


def _mask(rows: np.ndarray, width: int, rate: float, salt: int) -> np.ndarray:
    """Inverted-dropout factors from a 64-bit mix of row hash and unit number."""
    units = np.arange(width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    x = rows.astype(np.uint64)[:, None] ^ units[None, :]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    return np.where(u >= rate, 1.0 / (1.0 - rate), 0.0)


def _forward_batches(df, net: Network, inputs, outputs, dtype, mc_dropout, key, seed) -> DataFrame:
    if mc_dropout and key is None:
        raise ValueError("active dropout needs the row key")
    width = len(inputs)
    plan = [
        (
            layer.kind,
            layer.rate,
            None if layer.weight is None else layer.weight.astype(dtype),
            None if layer.bias is None else layer.bias.astype(dtype),
        )
        for layer in net.layers
    ]
    shared = df.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, hashes in batches:
            x = to_matrix(values, width, dtype)
            missing = np.isnan(x).any(axis=1)
            for number, (kind, rate, weight, bias) in enumerate(shared.value):
                if kind == "dense":
                    x = x @ weight + bias
                elif kind == "relu":
                    x = np.maximum(x, 0)
                elif kind == "sigmoid":
                    x = 1.0 / (1.0 + np.exp(-x))
                elif kind == "dropout":
                    if mc_dropout:
                        rows = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
                        x = x * _mask(rows, x.shape[1], rate, number + 1)
                else:
                    raise ValueError(f"unknown layer type {kind!r}")
            yield to_lists(x, missing)

    forward = F.arrow_udf(run, "array<double>")
    hashes = F.xxhash64(F.lit(seed), by_name(key)) if mc_dropout else F.lit(0).cast("bigint")
    vector = F.array(*[by_name(c).cast("double") for c in inputs])
    work = df.withColumn("__out", forward(vector, hashes))
    return work.select(*map(by_name, df.columns), *[F.col("__out")[j].alias(o) for j, o in enumerate(outputs)])


def forward_relational(
    df: DataFrame, table: DataFrame, layers: Sequence[Layer], inputs: Sequence[str], outputs: Sequence[str], key: str | None = None
) -> DataFrame:
    """Forward pass with the weights as a distributed table of WEIGHTS_SCHEMA.

    Every input number meets all rows, so weights are repeated over salts of the row key. Without a unique, non-NULL
    `key` the rows are numbered and stored first.
    """
    given = df
    if key is None:
        key = "__forward_row"
        df = materialize(df.withColumn(key, F.monotonically_increasing_id()))
    rows, df = df, df.where(complete(inputs))
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = [F.struct(F.lit(i).alias("i"), by_name(c).cast("double").alias("a")) for i, c in enumerate(inputs)]
    values = df.select(by_name(key), F.explode(F.array(*cells)).alias("cell")).select(by_name(key), "cell.*")
    ones = df.select(by_name(key), F.lit(-1).alias("i"), F.lit(1.0).alias("a"))
    for layer in layers:
        if layer.kind == "dense":
            salted = table.where(F.col("layer") == layer.name).select(
                F.col("in_i").alias("i"), "out_j", "w", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
            )
            fed = values.unionByName(ones).withColumn("salt", F.pmod(F.xxhash64(by_name(key)), F.lit(salts)).cast("int"))
            values = (
                fed.join(salted, ["i", "salt"])
                .groupBy(by_name(key), F.col("out_j").alias("i"))
                .agg(F.sum(F.col("a") * F.col("w")).alias("a"))
            )
        elif layer.kind == "relu":
            values = values.withColumn("a", F.greatest("a", F.lit(0.0)))
        elif layer.kind == "sigmoid":
            values = values.withColumn("a", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("a"))))
    wide = values.groupBy(by_name(key)).agg(*[F.max(F.when(F.col("i") == j, F.col("a"))).alias(o) for j, o in enumerate(outputs)])
    return rows.join(wide, key, "left").select(*map(by_name, given.columns), *map(by_name, outputs))
