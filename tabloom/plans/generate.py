"""Choice of the checkpoint and conditional generation from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.generate import generate_conditional
from ..operators.network import Network
from ..sources.roles import Roles
from ..sources.tables import count_rows
from ..sources.training_log import best_checkpoint, checkpoint_iterations, parse_training_log


def choose_iteration(log_lines: DataFrame, files: DataFrame, line: str = "value", name: str = "path") -> int:
    best = best_checkpoint(parse_training_log(log_lines, line), checkpoint_iterations(files, name)).first()
    if best is None:
        raise ValueError("no logged iteration has a checkpoint")
    return best["iter"]


def generate(
    scaled: DataFrame,
    roles: Roles,
    load: Callable[[int], Network],
    noise: int,
    order: list[str],
    rows: int = 0,
    using_iter: int = 0,
    log_lines: DataFrame | None = None,
    files: DataFrame | None = None,
    how: str = "as_train",
    seed=0,
    **forward,
) -> DataFrame:
    """`rows` scaled rows (0: as many as the table has) from the network of `using_iter` (0: the best logged one).

    `load` gives the network saved at an iteration.
    """
    iteration = using_iter or choose_iteration(log_lines, files)
    rows = count_rows(scaled, rows)
    return generate_conditional(
        scaled, load(iteration), roles.numerical, roles.conditions, order, rows, noise, seed, how, **forward
    )
