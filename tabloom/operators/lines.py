"""Mean margin on the diagonal of assigned against optimal lines."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_name
from ..functions.lookup import lookup
from ..functions.materialize import materialize
from ..functions.order import ordered, row_index

FEW_LINES = 64
TAILS = (0.01, 0.99)
SKETCH_SIZE = 4_096  # of a KLL sketch per cell; it is off by 0.13 % of the cell's rows at most, nearly always
MARGINS = (0.003, 0.05, 1.0)


def snap_lines(df: DataFrame, line: str, optimal: str) -> DataFrame:
    """Replace `line` by the nearest distinct value of `optimal`, the lower one on ties."""
    lines = df.select(by_name(optimal).alias("line")).where(F.col("line").isNotNull()).distinct()
    few = [r["line"] for r in lines.limit(FEW_LINES + 1).collect()]
    if len(few) <= FEW_LINES:
        options = F.array(*[F.lit(v) for v in sorted(few)])
        near = F.array_min(F.transform(options, lambda v: F.struct(F.abs(v - by_name(line)).alias("gap"), v.alias("line"))))
        return df.withColumn(line, F.when(by_name(line).isNotNull(), near["line"]))
    # many lines: number them, and find for each distinct value how many lines lie at or below it
    numbered = row_index(lines, ["line"], "number").select("number", "line")
    values = df.where(by_name(line).isNotNull()).groupBy(by_name(line).alias("value")).agg(F.count("*").alias("n"))
    marks = values.select("value", "n", F.lit(1).alias("asks")).unionByName(
        lines.select(F.col("line").alias("value"), F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("asks"))
    )
    placed = ordered(marks, ["value", "asks"], {"below": F.lit(1) - F.col("asks")}).df.where("asks = 1")
    placed = placed.withColumn("below", F.col("below").cast("bigint"))
    lower = numbered.select(F.col("number").alias("below"), F.col("line").alias("lower"))
    upper = numbered.select((F.col("number") - 1).alias("below"), F.col("line").alias("upper"))
    both = placed.join(lower, "below", "left").join(upper, "below", "left")
    take_upper = F.col("lower").isNull() | ((F.col("upper") - F.col("value")) < (F.col("value") - F.col("lower")))
    near = both.select(F.col("value").alias(line), "n", F.when(take_upper, F.col("upper")).otherwise(F.col("lower")).alias("__near"))
    return lookup(df, near, [line], "n").withColumn(line, F.col("__near")).drop("__near")


def _zones(rows: DataFrame, cell: list[str], margin: float) -> DataFrame:
    """(cell, zone, value, c, s): rows counted and summed per cell, one by one in value only around both percentiles.

    Sketched values `margin` beside each percentile bound zones 0 to 4 in ascending order. In zones 1 and 3 every
    distinct value has its own row, in the others `value` is NULL. A margin of 1 puts every value into zone 1.
    """
    if margin >= 1.0:
        zone = F.lit(1)
    else:
        asked = [min(max(q + d, 0.0), 1.0) for q in TAILS for d in (-margin, margin)]
        sketch = F.kll_sketch_agg_double(F.col("cmv").cast("double"), F.lit(SKETCH_SIZE))
        bounds = rows.groupBy(*cell).agg(F.count("*").alias("n"), sketch.alias("sketch"))
        # a sketch leaves NaN out; without bounds all values of a cell are in zone 1, as in one too small for the margin
        filled = F.when((F.col("n") * margin >= 3) & (F.kll_sketch_get_n_double("sketch") > 0), F.col("sketch"))
        bounds = bounds.select(*cell, "n", F.kll_sketch_get_quantile_double(filled, F.array(*map(F.lit, asked))).alias("at"))
        bounds = materialize(bounds)
        rows = lookup(rows, bounds, cell, "n")
        a, b, c, d = (F.col("at")[i] for i in range(4))
        v = F.col("cmv")
        zone = F.when(F.col("at").isNull(), 1).when(v < a, 0).when(v <= b, 1).when(v < c, 2).when(v <= d, 3).otherwise(4)
    rows = rows.withColumn("zone", zone)
    alone = F.when(F.col("zone").isin(1, 3), F.col("cmv"))
    return rows.groupBy(*cell, "zone", alone.alias("value")).agg(F.count("*").alias("c"), F.sum("cmv").alias("s"))


def _kept(rows: DataFrame, cell: list[str]) -> DataFrame:
    """(cell, c, s): rows strictly between the exact 1st and 99th percentile of their cell, and their sum.

    Two scans, which shuffle only counts: a sketch per cell, then the rows around both percentiles merged per value.
    Should a sketch be further off than its margin, the margin is widened, at last to all values.
    """
    for margin in MARGINS:
        zones = _zones(rows, cell, margin)
        placed = ordered(zones, [*cell, "zone", "value"], {"upto": "c"}).df  # checkpointed there
        sizes = placed.groupBy(*cell).agg(
            F.sum("c").alias("n"), F.min(F.col("upto") - F.col("c")).alias("before"), F.count("*").alias("groups")
        )
        spots = [((F.col("n") - 1) * F.lit(q)) for q in TAILS]
        ranks = [f(at).cast("bigint") for at in spots for f in (F.floor, F.ceil)]
        parts = [(at - F.floor(at)).alias(f"part{i}") for i, at in enumerate(spots)]
        sizes = sizes.select(*cell, "before", "groups", *[r.alias(f"r{i}") for i, r in enumerate(ranks)], *parts)
        cells = sizes.count()
        inside = lookup(placed, sizes, cell, "groups", cells)
        first, last = F.col("upto") - F.col("c") - F.col("before"), F.col("upto") - F.col("before")
        holds = [(first <= F.col(f"r{i}")) & (F.col(f"r{i}") < last) for i in range(4)]
        alone = F.col("zone").isin(1, 3)
        found = inside.groupBy(*cell).agg(
            F.count("*").alias("groups"),
            *[F.max(F.when(h & alone, F.col("value"))).alias(f"v{i}") for i, h in enumerate(holds)],
            F.count_if(~alone & reduce(or_, holds)).alias("missed"),
            F.first("part0").alias("part0"), F.first("part1").alias("part1"),
        )
        limit = [F.col(f"v{i}") + (F.col(f"v{i + 1}") - F.col(f"v{i}")) * F.col(f"part{i // 2}") for i in (0, 2)]
        limits = materialize(found.select(*cell, "groups", "missed", limit[0].alias("p01"), limit[1].alias("p99")))
        if margin >= 1.0 or not limits.agg(F.sum("missed")).first()[0]:
            break
    between = (F.col("value") > F.col("p01")) & (F.col("value") < F.col("p99"))
    kept = lookup(placed, limits.drop("missed"), cell, "groups", cells).where((F.col("zone") == 2) | (F.col("zone").isin(1, 3) & between))
    return kept.groupBy(*cell).agg(F.sum("c").alias("c"), F.sum("s").alias("s"))


def diagonal_cmv(df: DataFrame, final: str, optimal: str, cmv: str, key: str, mode: str = "round") -> DataFrame:
    """Weighted mean of the diagonal cell means, weights the kept rows per optimal line; 0.0 if no row is kept.

    Rows are kept strictly between the 1st and 99th percentile of their (final, optimal) cell.
    Percentiles are exact and found by two scans without a sort of the rows, so a cell of any size is spread over tasks.
    """
    rows = df.select(
        by_name(key).alias("key"), by_name(final).alias("final_line"), by_name(optimal).alias("opt_line"), by_name(cmv).alias("cmv")
    )
    if mode == "round":
        rows = snap_lines(rows, "final_line", "opt_line")
    cell = ["final_line", "opt_line"]
    rows = rows.where(F.col("cmv").isNotNull() & F.col("final_line").isNotNull() & F.col("opt_line").isNotNull())
    per_cell = _kept(rows.select(*cell, "cmv"), cell)
    on_diagonal = F.col("final_line") == F.col("opt_line")
    per_line = per_cell.groupBy("opt_line").agg(
        F.sum("c").alias("counts"), F.max(F.when(on_diagonal, F.col("s") / F.col("c"))).alias("mean")
    )
    hit = F.col("mean").isNotNull()
    value = F.sum(F.when(hit, F.col("mean") * F.col("counts"))) / F.sum(F.when(hit, F.col("counts")))
    return per_line.agg(F.when(F.count("*") == 0, F.lit(0.0)).otherwise(value).alias("diagonal_cmv"))
