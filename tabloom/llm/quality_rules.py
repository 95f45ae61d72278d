"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a test over text features. On a bounded sample of rows the operator measures what each rule costs and how
much it rejects, and tests the rules in the order of rejection per cost: a document that fails an early rule never
computes the features of the later ones. The order changes the work, not the verdict, because a document is kept
exactly if no rule fails.

Defined results: a null or empty text has no words, so every count is 0 and the rule on few words rejects it.
Repeated rows give repeated results, an empty table an empty result. Columns of the input are carried only if asked
for, so names cannot clash.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACES = r"[ \t\n\x0B\f\r]+"
NOT_SPACE = r"[^ \t\n\x0B\f\r]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
SAMPLE_ROWS = 1000  # about so many rows that costs and rejections are measured on


@dataclass(frozen=True)
class Rule:
    """`fails` is an SQL condition over the features that `needs` names."""

    name: str
    needs: tuple[str, ...]
    fails: str


DEFAULT_RULES = (
    Rule("few_words", ("n_words",), "n_words < 20"),
    Rule("repeats", ("n_words", "n_repeat_words"), "n_repeat_words * 100 > n_words * 30"),
    Rule("symbols", ("n_words", "n_symbols"), "n_symbols * 2 > n_words"),
    Rule("lines", ("n_lines", "n_dup_lines"), "n_dup_lines > 3 AND n_dup_lines * 100 > n_lines * 30"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars > n_words * 15 OR word_chars < n_words * 2"),
    Rule("capitals", ("word_chars", "n_capitals"), "n_capitals * 2 > word_chars"),
)

#: feature -> (helper columns it reads, SQL over them)
FEATURES: dict[str, tuple[tuple[str, ...], str]] = {
    "n_words": (("__words",), "bigint(size(__words))"),
    "word_chars": (("__words",), "bigint(length(array_join(__words, '')))"),
    "n_symbols": ((), f"bigint(regexp_count(__text, r'{SYMBOLS}'))"),
    "n_capitals": ((), "bigint(regexp_count(__text, '[A-Z]'))"),
    "n_lines": (("__lines",), "bigint(size(__lines))"),
    "n_dup_lines": (("__lines",), "bigint(size(__lines) - size(array_distinct(__lines)))"),
    "n_repeat_words": (
        ("__words", "__hashes", "__windows", "__sorted", "__twice"),
        # each start of a repeated window adds the words that the window before it did not cover
        f"CASE WHEN size(__twice) > 1 THEN aggregate(__twice, named_struct('p', -{WINDOW}L, 'n', 0L), "
        f"(a, p) -> named_struct('p', p, 'n', a.n + least({WINDOW}L, p - a.p)), a -> a.n) ELSE 0L END",
    ),
}

#: Helper columns in order. Each is read at least twice by the next ones, so the optimizer keeps it as a column of its own
#: and never moves it into a lambda, where it would be computed once per element.
HELPERS: dict[str, str] = {
    "__words": f"filter(split(__text, r'{SPACES}', -1), w -> w != '')",
    "__lines": f"filter(split(__text, '\\n', -1), l -> l rlike r'{NOT_SPACE}')",
    "__hashes": "transform(__words, w -> xxhash64(w))",
    # one element access per word of a window; slice() inside a lambda would copy the whole array each time
    "__windows": f"CASE WHEN size(__hashes) > {WINDOW} THEN slice(transform(__hashes, (h, i) -> xxhash64(h, "
    + ", ".join(f"get(__hashes, i + {k})" for k in range(1, WINDOW))
    + f")), 1, size(__hashes) - {WINDOW - 1}) ELSE array(0L) END",
    "__sorted": "CASE WHEN size(array_distinct(__windows)) < size(__windows) "
    "THEN sort_array(transform(__windows, (h, i) -> named_struct('h', h, 'p', bigint(i)))) END",
    "__twice": "CASE WHEN __sorted IS NOT NULL THEN sort_array(transform(filter(__sorted, (x, i) -> "
    "coalesce(get(__sorted, i - 1).h = x.h, false) OR coalesce(get(__sorted, i + 1).h = x.h, false)), x -> x.p)) "
    "ELSE array(0L) END",
}


def _add(df: DataFrame, features: list[str], when: Column | None = None) -> DataFrame:
    """The features as columns; `when`: only for rows that hold, null elsewhere."""
    expr = lambda sql: F.expr(sql) if when is None else F.when(when, F.expr(sql))
    need = {h for f in features for h in FEATURES[f][0]}
    for name, made in HELPERS.items():
        if name in need and name not in df.columns:
            df = df.withColumn(name, expr(made))
    new = {f: expr(FEATURES[f][1]) for f in features if f not in df.columns}
    return df.withColumns(new) if new else df


def measure(sample: DataFrame, rules: Sequence[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share of the sample that it rejects), each rule run alone on the sample."""
    out = []
    base = min(_seconds(sample.agg(F.count("__text"))) for _ in range(2))
    for rule in rules:
        df = _add(sample, list(rule.needs))
        df = df.agg(F.avg(F.expr(rule.fails).cast("int")).alias("share"))
        started = time.perf_counter()
        share = df.first()[0] or 0.0
        out.append((rule, max(time.perf_counter() - started - base, 1e-3), float(share)))
    return out


def _seconds(df: DataFrame) -> float:
    started = time.perf_counter()
    df.collect()
    return time.perf_counter() - started


def order_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost, highest first."""
    rules = DEFAULT_RULES if rules is None else rules
    share = min(1.0, sample_rows / max(docs.count(), 1))  # rows stay where they are: no task gathers the sample
    sample = docs.select(F.coalesce(F.col(text), F.lit("")).alias("__text")).sample(share, seed=1).cache()
    try:
        found = measure(sample, rules)
    finally:
        sample.unpersist()
    return [r for r, cost, share in sorted(found, key=lambda x: (-x[2] / x[1], x[0].name))]


def quality_rules(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    rules: Sequence[Rule] | None = None,
    features: list[str] | None = None,
) -> DataFrame:
    """Columns `keep`, `rejected_by` (the first failing rule in cascade order, null if none) and `kept`.

    `features` are computed for every row whatever the cascade decides, and returned as well.
    """
    rules = order_rules(docs, text, rules)
    df = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("__keep"), F.coalesce(F.col(text), F.lit("")).alias("__text")
    )
    if features:
        df = _add(df, features)
    verdict = F.lit(None).cast("string")
    for rule in rules:
        if all(f in df.columns for f in rule.needs):
            step = F.when(F.expr(rule.fails), F.lit(rule.name))
        else:
            alive = F.col("__verdict").isNull()
            df = _add(df.withColumn("__verdict", verdict), list(rule.needs), alive)
            step, verdict = F.when(alive & F.expr(rule.fails), F.lit(rule.name)), F.col("__verdict")
        verdict = F.coalesce(verdict, step)
    return df.withColumn("rejected_by", verdict).select(
        "__keep.*", *(features or []), "rejected_by", F.col("rejected_by").isNull().alias("kept")
    )
