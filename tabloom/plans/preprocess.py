"""Raw typed table to scaled table with fitted statistics."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import by_name
from ..functions.materialize import materialize
from ..operators.boxcox import boxcox_fit_known, boxcox_transform, transformed_median
from ..operators.impute import impute_values
from ..functions.selection import Profile
from ..operators.missing import special_fit_known, special_transform
from ..operators.onehot import onehot_fit, onehot_transform
from ..operators.scaler import scaled_median, scaler_fit, scaler_transform
from ..operators.splits import splitcap_fit, splitcap_transform
from ..operators.target import center_target
from ..sources.roles import Roles, derive_scaled_roles, write_role_header
from ..sources.stats import ColumnStats, load_stats, save_stats
from ..sources.tables import write_shuffled

STEPS = ("onehot", "special", "splitcap", "boxcox", "scaler")


@dataclass
class Preprocessed:
    table: DataFrame
    roles: Roles
    stats: dict[str, ColumnStats]


def preprocess(
    train: DataFrame,
    header: Roles,
    boxcox: ColumnStats | None = None,
    dump: DataFrame | None = None,
    frequencies: str = "majority",
    resolution: float | None = None,
    checkpoint_input: bool = False,
) -> Preprocessed:
    """Centre the target, one-hot, flag special values, optionally cap at tree splits, Box-Cox, scale, fill medians.

    Given `boxcox` statistics are applied instead of fitted, so lambdas can be edited between runs.
    Every fit reads the source through the projections before it; nothing is written in between. A later fit takes
    over what an earlier one knows of a column, so all fits together need about six scans.
    `checkpoint_input` writes the header's columns once first, for a source that is itself a join.
    """
    train = train.select(*[by_name(c) for c in header.names if c in train.columns])
    if checkpoint_input:
        train = materialize(train)
    numerical = header.numerical
    stats = {"onehot": onehot_fit(train, header.categorical, header.key)}
    table = center_target(train, header.targets)
    table, onehot = onehot_transform(table, stats["onehot"])
    stats["special"], known, pairs = special_fit_known(train, numerical, frequencies)
    table, missing, frequent = special_transform(table, stats["special"], numerical)
    if dump is not None:
        stats["splitcap"] = splitcap_fit(dump, header.of("N", "C", "G"), numerical)
        table = splitcap_transform(table, stats["splitcap"])
    medians = None
    if boxcox:
        stats["boxcox"] = boxcox
    else:
        # what is known of a column holds until a step changes it
        changed = set(numerical) if dump is not None else {c for c in numerical if "highfreq_column" in stats["special"].columns[c]}
        known = Profile(known.rows, *[{c: v for c, v in part.items() if c not in changed} for part in (known.count, known.low, known.high, known.mean, known.std, known.grids)])
        pairs = {c: p for c, p in pairs.items() if dump is None}  # those of special_fit leave the frequent value out
        stats["boxcox"], pairs = boxcox_fit_known(table, numerical, resolution=resolution, known=known, pairs=pairs)
        medians = {c: transformed_median(stats["boxcox"].columns[c], pairs.get(c)) for c in numerical}
    table = boxcox_transform(table, stats["boxcox"], numerical)
    stats["scaler"] = scaler_fit(table, numerical, medians)
    table = scaler_transform(table, stats["scaler"], numerical)
    middle = {c: scaled_median(stats["scaler"].columns[c]) for c in numerical}
    table = impute_values(table, {c: m for c, m in middle.items() if m is not None})
    roles = derive_scaled_roles(table.columns, numerical, onehot, missing, frequent, header.targets)
    return Preprocessed(table, roles, stats)


def write_preprocessed(spark: SparkSession, done: Preprocessed, folder: str, key: str, seed=0) -> None:
    """Shuffled scaled CSV, its role header and one statistics file per step."""
    write_shuffled(done.table, f"{folder}/scaled", key, seed)
    write_role_header(spark, done.roles, f"{folder}/scaled_header")
    for step, stats in done.stats.items():
        save_stats(spark, stats, f"{folder}/stats/{step}")


def read_stats(spark: SparkSession, folder: str, steps: Sequence[str] = ("onehot", "special", "boxcox", "scaler")) -> dict[str, ColumnStats]:
    return {step: load_stats(spark, f"{folder}/stats/{step}") for step in steps}
