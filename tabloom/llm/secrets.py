"""Secret scan through a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams (``trigram_query``). ``trigram_index`` posts,
for every trigram that some rule asks for, the documents whose lower-cased text contains it; ``candidates`` intersects
the postings per rule, and only those documents are searched with the rule's expression. A rule whose expression forces
no trigram is searched for in every document.

Rows are told apart by their place in the input, so the input must give the same rows in the same order each time it is
read: a stored table, or a checkpoint. A null text counts as empty; empty texts and empty tables have no spans. Only the
columns asked for are carried, under one struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as _sre, _parser

from pyspark.sql import Column, DataFrame, functions as F

MAX_STRINGS = 128  # alternatives of one literal run; a longer list gives no constraint


@dataclass(frozen=True)
class Rule:
    """A match of `pattern` counts if its `group` has `least` characters or more; the span is the whole match."""

    kind: str
    pattern: str
    group: int
    least: int


#: Fixed patterns of the three base kinds.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    Rule("hex", r"([0-9a-f]+)", 1, 24),
)
#: Well-known public token formats.
MORE_RULES = (
    Rule("forge", r"(gh[opsu]_[A-Za-z0-9]+)", 1, 40),
    Rule("chat", r"(xox[abps]-[A-Za-z0-9-]+)", 1, 15),
    Rule("maps", r"(AIza[A-Za-z0-9_-]+)", 1, 39),
    Rule("webtoken", r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1, 30),
    Rule("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1),
    Rule("login", r"(://[A-Za-z0-9._~-]+:[A-Za-z0-9._~-]+@)", 1, 1),
)
RULES = BASE_RULES + MORE_RULES

Clause = list[frozenset[str]]  # any of the sets, all trigrams of that set


def _trigrams(s: str) -> frozenset[str]:
    s = s.lower()
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that must all hold for a text to match; none if the pattern forces no trigram.

    Literal runs are expanded into the strings they can be (small classes and optional parts included); a part that
    can be too much ends the run, and the run becomes a clause if each of its strings has a trigram.
    """
    clauses: list[Clause] = []

    def strings(tree) -> list[str] | None:
        """All strings that a part can be, or None if there are too many."""
        found = [""]
        for op, arg in tree:
            if op is _sre.LITERAL:
                options = [chr(arg)]
            elif op is _sre.IN:
                options = in_class(arg)
            elif op is _sre.SUBPATTERN:
                options = strings(arg[-1])
            elif op is _sre.BRANCH:
                each = [strings(x) for x in arg[1]]
                options = None if None in each else [s for x in each for s in x]
            elif op in (_sre.MAX_REPEAT, _sre.MIN_REPEAT) and arg[1] is not _sre.MAXREPEAT and arg[1] <= 4:
                once = strings(arg[2])
                options = once and ["".join(p) for n in range(arg[0], arg[1] + 1) for p in product(once, repeat=n)]
            else:
                options = None
            if options is None or len(found) * len(options) > MAX_STRINGS:
                return None
            found = [a + b for a in found for b in options]
        return found

    def in_class(parts) -> list[str] | None:
        found = []
        for op, arg in parts:
            if op is _sre.LITERAL:
                found.append(chr(arg))
            elif op is _sre.RANGE and arg[1] - arg[0] < 4:
                found += map(chr, range(arg[0], arg[1] + 1))
            else:
                return None
        return found

    def close(run: list[str]) -> list[str]:
        sets = {_trigrams(s) for s in run}
        if all(sets):
            clauses.append([s for s in sets if not any(o < s for o in sets)])  # a weaker alternative makes others needless
        return [""]

    def walk(tree, run: list[str]) -> list[str]:
        for item in tree:
            op, arg = item
            options = strings([item])
            if options is not None and len(run) * len(options) <= MAX_STRINGS:
                run = [a + b for a in run for b in options]
            elif op is _sre.SUBPATTERN:
                run = walk(arg[-1], run)
            elif op in (_sre.MAX_REPEAT, _sre.MIN_REPEAT) and arg[0] > 0:
                close(walk(arg[2], run))
                run = [""]
            else:
                run = close(run)
                run = options if options is not None and len(options) <= MAX_STRINGS else [""]
        return run

    close(walk(_parser.parse(pattern), [""]))
    return clauses


def trigram_index(rows: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings (trigram, __row) of `rows` (__row, __text)."""
    low = F.lower(F.coalesce("__text", F.lit("")))
    held = F.filter(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in sorted(trigrams)]), lambda t: t.isNotNull())
    return rows.select("__row", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """(__row, kinds): documents whose postings satisfy the query of each of these kinds."""
    spark = index.sparkSession
    asked = [(kind, c, a, t, len(s)) for kind, q in queries.items() for c, clause in enumerate(q) for a, s in enumerate(clause) for t in s]
    # as large as the rules, whatever the input
    wanted = spark.createDataFrame(asked, "kind string, clause int, alternative int, trigram string, size int")
    clauses = F.create_map(*[F.lit(x) for kind, q in queries.items() for x in (kind, len(q))])
    return (
        index.join(F.broadcast(wanted), "trigram")
        .groupBy("__row", "kind", "clause", "alternative")
        .agg(F.count("*").alias("n"), F.first("size").alias("size"))
        .where("n = size")
        .groupBy("__row", "kind")
        .agg(F.size(F.collect_set("clause")).alias("met"))
        .where(F.col("met") == clauses[F.col("kind")])
        .groupBy("__row")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def match_spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, number, stop, kind) for one rule, in code points, stop exclusive."""
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("value"),
    )
    empty = F.array().cast("array<struct<start:bigint,number:int,stop:bigint,kind:string>>")

    def step(seen: Column, part: Column) -> Column:
        start = seen["at"] + F.length(part["gap"])
        stop = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), stop.alias("stop"), F.lit(rule.kind).alias("kind"))
        more = F.when(F.length(part["value"]) >= rule.least, F.concat(seen["found"], F.array(span))).otherwise(seen["found"])
        return F.struct(stop.alias("at"), more.alias("found"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("found"))
    found = F.aggregate(parts, first, step, lambda seen: seen["found"])
    return F.when(F.length(F.regexp_substr(text, F.lit(rule.pattern))) > 0, found).otherwise(empty)


def find_secrets(
    docs: DataFrame, keep: Sequence[str | Column], text: str = "text", rules: Sequence[Rule] = RULES, with_text: bool = False, name: str = "spans"
) -> DataFrame:
    """Columns `keep`, and `name`: array of (start, number, stop, kind) by start, then place in `rules`.

    `with_text` adds the column `text` without sending it twice.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    rows = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.struct(*keep).alias("__keep"),
        F.col(text).cast("string").alias("__text"),
    )
    value = F.coalesce("__text", F.lit(""))
    if queries:
        trigrams = {t for q in queries.values() for clause in q for s in clause for t in s}
        found = candidates(trigram_index(rows.select("__row", "__text"), trigrams), queries)
        rows = rows.join(found, "__row", "left")
    spans = [
        F.when(F.array_contains("kinds", r.kind), match_spans(value, r, i)) if r.kind in queries else match_spans(value, r, i)
        for i, r in enumerate(rules)
    ]
    empty = F.array().cast("array<struct<start:bigint,number:int,stop:bigint,kind:string>>")
    every = F.sort_array(F.concat(*[F.coalesce(s, empty) for s in spans]))
    return rows.select("__keep.*", *([F.col("__text").alias(text)] if with_text else []), every.alias(name))


def digest(spans: Column) -> Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span (overlapping ones as one) replaced by `mark`."""

    def step(seen: Column, s: Column) -> Column:
        gap = F.substring(text, (seen["at"] + 1).cast("int"), F.greatest(s["start"] - seen["at"], F.lit(0)).cast("int"))
        out = F.when(s["start"] >= seen["at"], F.concat(seen["out"], gap, F.lit(mark))).otherwise(seen["out"])
        return F.struct(F.greatest(seen["at"], s["stop"]).alias("at"), out.alias("out"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, first, step, lambda seen: F.concat(seen["out"], F.substring(text, (seen["at"] + 1).cast("int"), F.lit(1 << 30))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
