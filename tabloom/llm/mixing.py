"""Documents sampled so that token shares meet target marginals, by iterative proportional fitting in DataFrame functions.

Documents are summed up by cell (one value of every margin). Raking scales the cells' weights to the targets of one
margin after the other until all hold. A cell's weight over its tokens, divided by the largest such ratio, is the
probability with which each of its documents is kept, so the tokens kept have the target shares in expectation and no
document is repeated. The smallest, most up-weighted cell thus sets how much is kept. With a `size`, a share of all tokens, the
ratios are scaled until that share is kept in expectation; cells whose probability would pass 1 are kept whole, and what they
lack of their target goes to the others. The draw depends on seed and key only.

Defined results: a null margin value is a value of its own, ``(none)``. A null or empty text has no tokens; a cell without
tokens has probability 0. Rows with the same key share their draw. An empty table gives no rows. Values that targets do
not name get no weight.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.materialize import materialize
from ..functions.rng import uniform

NONE = "(none)"
WORD = r"[^ \t\n\x0B\f\r]+"
SWEEPS = 10
TEMPER = 0.9
BROADCAST_CELLS = 20_000


def topic(text: Column) -> Column:
    """A coarse topic by the shape of the text."""
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    return (
        F.when(F.regexp_count(text, F.lit(r"\|")) * 40 > n, "table")
        .when(F.regexp_count(text, F.lit(r"[0-9]")) * 20 > n, "figures")
        .when(n < 600, "note")
        .when(n < 3000, "article")
        .otherwise("book")
    )


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cell_columns(margins: Mapping[str, Column]) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit(NONE)).alias(f"__{m}") for m, c in margins.items()]


def rake(cells: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame], temper: float, sweeps: int) -> DataFrame:
    """`cells` (__margin..., tokens) with `weight`: the raked tokens, which sum to 1."""
    for m in margins:
        if m in targets:
            goal = targets[m].select(F.col("value").cast("string").alias(f"__{m}"), F.col("share").cast("double").alias(f"__to_{m}"))
        else:
            goal = cells.groupBy(f"__{m}").agg(F.pow(F.sum("tokens").cast("double"), temper).alias(f"__to_{m}"))
        goal = goal.join(cells.select(f"__{m}").distinct(), f"__{m}", "left_semi")
        total = goal.agg(F.sum(f"__to_{m}").alias("__all"))  # one row
        goal = goal.join(F.broadcast(total)).select(f"__{m}", F.try_divide(f"__to_{m}", "__all").alias(f"__to_{m}"))
        cells = cells.join(goal, f"__{m}", "left").fillna(0.0, [f"__to_{m}"])
    cells = materialize(cells.withColumn("weight", F.col("tokens").cast("double")))
    for _ in range(sweeps):
        for m in margins:
            now = cells.groupBy(f"__{m}").agg(F.sum("weight").alias("__now"))
            scaled = F.coalesce(F.try_divide(F.col("weight") * F.col(f"__to_{m}"), F.col("__now")), F.lit(0.0))
            cells = materialize(cells.join(now, f"__{m}").withColumn("weight", scaled).drop("__now"))
    return cells


def scale(ratio: DataFrame, size: float) -> float:
    """The factor s with sum(tokens * min(1, s * ratio)) = `size` of all tokens; if all that have weight are fewer, one that keeps them."""
    goal = size * float(ratio.agg(F.sum("tokens")).first()[0] or 0)
    s = 0.0
    while True:  # cells only ever become whole, so this ends
        whole = F.col("__ratio") * F.lit(s) >= 1
        kept, rest = ratio.agg(F.sum(F.when(whole, F.col("tokens"))), F.sum(F.when(~whole, F.col("tokens") * F.col("__ratio")))).first()
        if not rest or (goal - (kept or 0)) / rest <= s * (1 + 1e-12):
            return s
        s = (goal - (kept or 0)) / rest


def mix(
    docs: DataFrame,
    margins: Mapping[str, Column],
    key: str = "doc_id",
    text: str = "text",
    targets: Mapping[str, DataFrame] | None = None,
    temper: float = TEMPER,
    sweeps: int = SWEEPS,
    seed: int = 17,
    size: float | None = None,
) -> DataFrame:
    """Each row of `docs` as the struct `doc`, its <margin>..., tokens, cell_weight, probability and kept.

    `targets` has (value, share) per margin; a margin without one gets its own token shares to the power `temper`.
    `size` is the share of all tokens to keep; without one the largest ratio is kept whole and all others in proportion.
    """
    named = docs.select(F.struct("*").alias("doc"), *cell_columns(margins), tokens(F.col(text)).alias("tokens"))
    names = [f"__{m}" for m in margins]
    cells = materialize(named.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    raked = rake(cells, list(margins), targets or {}, temper, sweeps)
    ratio = raked.select(*names, "tokens", F.col("weight").alias("cell_weight"), F.coalesce(F.try_divide("weight", "tokens"), F.lit(0.0)).alias("__ratio"))
    most, count = ratio.agg(F.max("__ratio"), F.count("*")).first()
    kept = F.col("__ratio") / F.lit(most or 1.0) if size is None else F.least(F.lit(1.0), F.col("__ratio") * F.lit(scale(ratio, size)))
    ratio = ratio.withColumn("probability", kept).drop("__ratio", "tokens")
    out = named.join(F.broadcast(ratio) if count <= BROADCAST_CELLS else ratio, names, "left")
    return out.select(
        "doc",
        *[F.col(f"__{m}").alias(m) for m in margins],
        "tokens",
        "cell_weight",
        "probability",
        (uniform(seed, "mix", F.col(f"doc.`{key}`")) < F.col("probability")).alias("kept"),
    )
