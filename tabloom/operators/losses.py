"""Discriminator scores and the losses defined on them, as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name
from .network import Network, dense_forward, spread
from .ranking import auc


def score_realness(
    real: DataFrame, generated: DataFrame, net: Network, columns: Sequence[str], key: str, **forward
) -> DataFrame:
    """(key, label, score): discriminator output over `columns` (data, then conditions if any); label 1 = real."""
    both = real.select(by_name(key), F.lit(1).alias("label"), *map(by_name, columns)).unionByName(
        generated.select(by_name(key), F.lit(0).alias("label"), *map(by_name, columns))
    )
    return dense_forward(spread(both, net, key), net, list(columns), ["score"], **forward).select(by_name(key), "label", "score")


def realness_auc(scored: DataFrame) -> DataFrame:
    """AUC of sigmoid(score); the sigmoid keeps the order, so the score itself is ranked."""
    return auc(scored, "label", "score")


def softplus(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def _mean(label: int, value: Column) -> Column:
    return F.avg(F.when(F.col("label") == label, value))


def bce_loss(scored: DataFrame, halved: bool = False) -> DataFrame:
    """Cross-entropy losses; `halved` halves the discriminator's, as the paired networks do."""
    d = _mean(1, softplus(-F.col("score"))) + _mean(0, softplus(F.col("score")))
    return scored.agg((d / 2.0 if halved else d).alias("disc_loss"), _mean(0, softplus(-F.col("score"))).alias("gen_loss"))


def lsgan_loss(scored: DataFrame) -> DataFrame:
    real, fake = F.pow(F.col("score") - 1.0, 2.0), F.pow(F.col("score"), 2.0)
    return scored.agg(((_mean(1, real) + _mean(0, fake)) / 2.0).alias("disc_loss"), _mean(0, real).alias("gen_loss"))


def critic_gap(scored: DataFrame) -> DataFrame:
    return scored.agg(
        (_mean(0, F.col("score")) - _mean(1, F.col("score"))).alias("disc_loss"),
        (-_mean(0, F.col("score"))).alias("gen_loss"),
    )


def _mean_gap(df: DataFrame, cols: Sequence[str], others: Sequence[str], name: str) -> DataFrame:
    gap = sum((F.abs(by_name(c) - by_name(o)) for c, o in zip(cols, others)), F.lit(0.0))
    return df.agg((F.avg(gap) / len(cols)).alias(name))  # rows with a NULL on either side are left out


def _one_side(df: DataFrame, nets: Sequence[Network], cols: Sequence[str], name: str, **forward) -> DataFrame:
    """Mean |x - nets(x)| over all cells."""
    work, names = df.select(*map(by_name, cols)), list(cols)
    for step, net in enumerate(nets):
        out = [f"__s{step}_{j}" for j in range(net.outputs)]
        work, names = dense_forward(work, net, names, out, **forward), out
    return _mean_gap(work, cols, names, name)


def cycle_error(a: DataFrame, b: DataFrame, a_to_b: Network, b_to_a: Network, a_cols, b_cols, **forward) -> DataFrame:
    """mean |A - G_BA(G_AB(A))| + mean |B - G_AB(G_BA(B))|."""
    left = _one_side(a, [a_to_b, b_to_a], a_cols, "a_error", **forward)
    right = _one_side(b, [b_to_a, a_to_b], b_cols, "b_error", **forward)
    return _add_sides(left, right, "cycle_error")


def identity_error(a: DataFrame, b: DataFrame, a_to_b: Network, b_to_a: Network, a_cols, b_cols, **forward) -> DataFrame:
    """mean |A - G_BA(A)| + mean |B - G_AB(B)|; both domains need the same number of columns."""
    left = _one_side(a, [b_to_a], a_cols, "a_error", **forward)
    right = _one_side(b, [a_to_b], b_cols, "b_error", **forward)
    return _add_sides(left, right, "identity_error")


def _add_sides(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Both sides are single rows."""
    pair = left.withColumnRenamed("a_error", "v").unionByName(right.withColumnRenamed("b_error", "v"))
    return pair.agg(F.sum("v").alias(name))


def cycle_total(adversarial: DataFrame, cycle: DataFrame, identity: DataFrame, cycle_lambd: float) -> DataFrame:
    """Generator loss of the paired networks: adversarial + lambda * cycle + identity, each a single row."""
    parts = [
        adversarial.select(F.col("gen_loss").alias("v")),
        cycle.select((F.col("cycle_error") * F.lit(cycle_lambd)).alias("v")),
        identity.select(F.col("identity_error").alias("v")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(F.sum("v").alias("cycle_total"))
