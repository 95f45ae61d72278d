"""Metrics that rank or bin predictions; ties are broken by key, ascending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name
from ..functions.order import ordered, row_index


def histogram(df: DataFrame, value: Column, low: float, high: float, bins: int, weight: Column | None = None) -> DataFrame:
    """(bin, n) over equal-width bins; values outside the range fall in the first or last bin, NULL and NaN in none."""
    place = F.floor(F.try_divide(value - F.lit(low), F.lit(high - low)) * F.lit(float(bins)))
    place = F.coalesce(F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0)), F.lit(0))
    total = F.count("*") if weight is None else F.sum(weight)
    return df.where(value.isNotNull() & ~F.isnan(value)).groupBy(place.cast("int").alias("bin")).agg(total.alias("n"))


def jsd(p: DataFrame, q: DataFrame, bin: str = "bin", weight: str = "n") -> DataFrame:
    """Jensen-Shannon divergence of two histograms, natural logarithm; a missing bin counts as 0."""
    both = p.select(bin, by_name(weight).cast("double").alias("p")).join(
        q.select(bin, by_name(weight).cast("double").alias("q")), bin, "full_outer"
    )
    both = both.fillna(0.0, ["p", "q"])
    totals = both.agg(F.sum(F.abs("p")).alias("p"), F.sum(F.abs("q")).alias("q")).first()
    share = {s: F.try_divide(by_name(s), F.lit(totals[s])) for s in ("p", "q")}
    middle = F.lit(0.5) * (share["p"] + share["q"])
    terms = [F.sum(F.when(v > 0, v * F.ln(v / middle)).otherwise(0.0)) for v in share.values()]
    return both.agg((F.lit(0.5) * (terms[0] + terms[1])).alias("jsd"))


def auc(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Area under the ROC curve for 0/1 truth, tied predictions sharing their rank.

    Rows are first merged per distinct prediction, so a frequent score is one row afterwards.
    """
    groups = df.groupBy(by_name(pred).alias("__score")).agg(
        F.sum(F.when(by_name(true) == 1, 1).otherwise(0)).alias("__pos"),
        F.sum(F.when(by_name(true) == 1, 0).otherwise(1)).alias("__neg"),
    )
    placed = ordered(groups, ["__score"], {"__below": "__neg", "__upto": "__pos"})
    pos, neg = placed.totals["__upto"], placed.totals["__below"]
    won = F.sum(F.col("__pos") * (F.col("__below") - F.col("__neg") / 2.0))
    return placed.df.agg((won / F.lit(float(pos) * float(neg) or None).cast("double")).alias("auc"))


def gini_binary(df: DataFrame, true: str, pred: str) -> DataFrame:
    return auc(df, true, pred).select((F.lit(100.0) * (F.lit(2.0) * F.col("auc") - F.lit(1.0))).alias("gini"))


def gini(df: DataFrame, true: str, pred: str, key: str) -> DataFrame:
    """Lorenz area by prediction over the area by truth, both descending.

    The cumulative sums of y sorted by rank add up to sum(y * (n - rank + 1)), so ranks and
    one aggregate suffice. Equal truths are merged first: their order does not matter.
    """
    same = df.groupBy(by_name(true).cast("double").alias("y")).agg(F.count("*").alias("c"))
    by_true = ordered(same, [F.desc("y")], {"upto": "c"})
    n = float(by_true.totals["upto"])
    # sum of (n - rank + 1) over the c ranks that end at `upto`
    weights = F.col("c") * (F.lit(n + 1.0) - F.col("upto")) + F.col("c") * (F.col("c") - 1) / 2.0
    total, area = by_true.df.agg(F.sum(F.col("y") * F.col("c")), F.sum(F.col("y") * weights)).first()
    ranked = row_index(df.select(by_name(key), by_name(true).cast("double").alias("y"), by_name(pred).alias("p")), [F.desc("p"), key])
    by_pred = ranked.agg(F.sum(F.col("y") * (F.lit(n + 1.0) - F.col("row_no"))).alias("area"))
    ones = (n + 1.0) / 2.0
    if not total or ones == area / total:  # no truth, or the same for all rows
        return by_pred.select(F.lit(None).cast("double").alias("gini"))
    return by_pred.select(
        ((F.lit(ones) - F.col("area") / F.lit(total)) / F.lit(ones - area / total)).alias("gini")
    )


def capture_rate(
    df: DataFrame, actual: str, predicted: str, key: str, at: float = 2.0, sample_size: float = 100.0
) -> DataFrame:
    """Percent of all positives ranked before the row whose cumulative weight is nearest to `at` percent.

    Rows with actual 0 weigh 100/sample_size, others 1; the first of equally near rows counts
    and is itself left out.
    """
    rows = df.select(
        key,
        by_name(predicted).alias("p"),
        by_name(actual).cast("double").alias("y"),
        F.when(by_name(actual) == 0, F.lit(100.0 / sample_size)).otherwise(F.lit(1.0)).alias("w"),
    )
    placed = ordered(rows, [F.desc("p"), key], {"upto": "w"})
    target = at / 100.0 * placed.totals["upto"]
    cut = placed.df.agg(F.min(F.struct(F.abs(F.col("upto") - F.lit(target)), "row_no")).alias("cut")).first()["cut"]
    if cut is None:
        return placed.df.agg(F.sum(F.lit(None).cast("double")).alias("capture_rate"))
    cut = cut["row_no"]
    caught = F.coalesce(F.sum(F.when(F.col("row_no") < cut, F.col("y"))), F.lit(0.0))
    return placed.df.agg(F.try_divide(F.lit(100.0) * caught, F.sum("y")).alias("capture_rate"))


def accuracy_index(df: DataFrame, true: str, pred: str, key: str, weight: str | None = None, bins: int = 10) -> DataFrame:
    """1 - sum over bins |sum pred - sum true| / sum over bins |sum true|, bins of equal weight by falling prediction."""
    w = F.lit(1.0) if weight is None else by_name(weight).cast("double")
    rows = df.select(by_name(key), by_name(pred).cast("double").alias("p"), by_name(true).cast("double").alias("y"), w.alias("w"))
    placed = ordered(rows, [F.desc("p"), key], {"upto": "w"})
    place = F.floor(F.try_divide(F.col("upto"), F.lit(float(placed.totals["upto"]))) * F.lit(float(bins))) + 1
    per_bin = placed.df.groupBy(F.least(place, F.lit(bins)).alias("bin")).agg(
        F.sum(F.col("p") * F.col("w")).alias("p"), F.sum(F.col("y") * F.col("w")).alias("y")
    )
    size = F.sum(F.abs("y"))
    return per_bin.agg(
        (F.lit(1.0) - F.sum(F.abs(F.col("p") - F.col("y"))) / F.when(size != 0, size)).alias("accuracy_index")
    )
