"""Conversations brought into the form `system? (user assistant)*` by the cheapest edits, with an audit of them.

The rows are range-sorted by conversation and turn. Within a task each row becomes one symbol, the class of its role and its
first fault, and equal consecutive symbols are collapsed into runs. The cost to go, one number per state of the form, is
carried from the end over each run by binary powers of the symbol's min-plus transition, which are computed once. The
choices are then unrolled from the front through the same powers: the cheapest edit whose initial comes first in ASCII.

A conversation that lies wholly inside a task and has at most BLOCK_ROWS rows is finished there. The others, which may be
as long as they like, are cut into blocks; marks of rows seen in an earlier block are found by an aggregate over blocks, and
only the symbols, one byte a row, meet per conversation: as many bytes as the audit has. Texts stay in their blocks.

Defined results: a null role or text is one space. Rows go by turn, null first, and rows of one turn by role, then by the
text's first 32 characters, then by its digest; repeated rows are duplicates. Roles whose first letter is not s, u or a are
never kept. Null keys are one conversation. Other columns are not read, so names cannot clash. No rows: no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name
from .stores import stored

BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 22
WHITE = " \t\n\x0b\x0c\r"
END_MARKS = ".!?"

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3  # costs; CUT is that of a truncated row that stays
FAR = 1 << 60

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant (or nothing more needed).
NEXT = (2, 2, 3, 2)  # by a user or an assistant, whichever the form asks for
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
TO_GO = (0, 2 * INSERT, INSERT, 0)
MUST_GO = "x"  # symbol of a row that has to be deleted; others are s, u, a or o, upper case if truncated
MADE = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}


def symbol(role: str, must_go: bool, cut: bool) -> str:
    if must_go:
        return MUST_GO
    kind = role[:1] if role[:1] in KEPT else "o"
    return kind.upper() if cut else kind


def row_edits(of: str) -> list[list[tuple[str, int, int]]]:
    """Per state the edits (initial, cost, state after) of one row with this symbol, by initial."""
    out = []
    for state in range(4):
        some = [("D", DELETE, state)]
        if of != MUST_GO:
            extra = CUT if of.isupper() else 0
            after = KEPT.get(of.lower(), {}).get(state)
            some += [("K", extra, after)] if after is not None else []
            some.append(("R", REROLE + extra, NEXT[state]))
        out.append(some)
    return out


def times(a, b):
    """Min-plus product of two matrices."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def applied(m, v):
    return tuple(min(m[i][k] + v[k] for k in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(of: str, k: int):
    """The transition over 2^k rows with this symbol, insertions before each row included."""
    if k:
        half = power(of, k - 1)
        return times(half, half)
    free = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    for _ in range(4):
        for i in range(4):
            for j in range(4):
                free[i][NEXT[j]] = min(free[i][NEXT[j]], free[i][j] + INSERT)
    row = [[FAR] * 4 for _ in range(4)]
    for state, some in enumerate(row_edits(of)):
        for _, cost, after in some:
            row[state][after] = min(row[state][after], cost)
    return times(free, row)


def level(v):
    """Costs to go above the least of them; choices depend on differences only."""
    least = min(v)
    return tuple(x - least for x in v)


@lru_cache(maxsize=1 << 14)
def unrolled(of: str, k: int, state: int, after) -> tuple[str, int]:
    """(initials, state at the end) of the best edits of 2^k rows, given the costs to go after them."""
    if k:
        first, state = unrolled(of, k - 1, state, level(applied(power(of, k - 1), after)))
        second, state = unrolled(of, k - 1, state, after)
        return first + second, state
    before, out = applied(power(of, 0), after), ""
    while True:
        choices = [(x, c, s, after[s]) for x, c, s in row_edits(of)[state]] + [("I", INSERT, NEXT[state], before[NEXT[state]])]
        letter, state = min((x, s) for x, c, s, rest in choices if c + rest == before[state])
        out += letter
        if letter != "I":
            return out, state


def solve(runs: list[tuple[str, int]]) -> tuple[int, list[str]]:
    """(cost, initials per run and those at the end) for runs of equal symbols."""
    parts = []  # (run, symbol, k): each run in powers of two, of 4096 rows at most
    for n, (of, length) in enumerate(runs):
        while length:
            k = min(length.bit_length() - 1, 12)
            parts.append((n, of, k))
            length -= 1 << k
    v, behind = TO_GO, []
    for _, of, k in reversed(parts):
        behind.append(level(v))
        v = applied(power(of, k), v)
    state, out = 0, [[] for _ in runs]
    for (n, of, k), after in zip(parts, reversed(behind)):
        letters, state = unrolled(of, k, state, after)
        out[n].append(letters)
    return v[0], ["".join(x) for x in out] + ["I" * (TO_GO[state] // INSERT)]


def edited(rows: list[tuple[str, str]], letters: str, state: int = 0) -> list[dict]:
    """The repaired rows, given the edits of `rows` (role, text) and the state before them."""
    out, at = [], iter(rows)
    for letter in letters:
        role, text = next(at) if letter != "I" else ("", "")
        if letter == "D":
            continue
        state = KEPT[role[:1]][state] if letter == "K" else NEXT[state]
        out.append({"role": role if letter == "K" else MADE[state], "text": text})
    return out


def state_after(rows: list[str], letters: str, state: int) -> int:
    """The state behind the edits of rows with these symbols."""
    at = iter(rows)
    for letter in letters:
        of = next(at) if letter != "I" else ""
        if letter == "K":
            state = KEPT[of.lower()][state]
        elif letter != "D":
            state = NEXT[state]
    return state


def faults(rows: list[tuple[str, str, str]], seen: set) -> tuple[str, list[int]]:
    """(symbols, [blank, duplicate, truncated, illegal]) of rows (role, text, last character); `seen` tells of earlier rows."""
    symbols, counts, before = [], [0, 0, 0, 0], None
    for role, text, last in rows:
        mark = (role, text)
        blank, twice = not last, mark in seen
        cut = not blank and not twice and last not in END_MARKS
        seen.add(mark)
        symbols.append(symbol(role, blank or twice, cut))
        for i, x in enumerate((blank, twice and not blank, cut, before is not None and before + role[:1] not in LEGAL)):
            counts[i] += x
        before = role[:1]
    return "".join(symbols), counts


def runs_of(symbols: str) -> list[tuple[str, int]]:
    return [(of, sum(1 for _ in same)) for of, same in groupby(symbols)]


def _turns(turns: list) -> tuple:
    """(least, largest, number of different) turns of sorted rows, without nulls."""
    some = [t for t in turns if t is not None]
    return (some[0], some[-1], sum(a != b for a, b in zip(some, some[1:])) + 1) if some else (None, None, 0)


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_BLOCK = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("last", pa.string())]))
_SOLVED = [("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()), ("audit", pa.string()), ("repaired", _ROWS)]
_SOLVED_SQL = f"gaps long, {', '.join(f'{c} long' for c in _COUNTS)}, cost long, audit string, repaired array<struct<role string, text string>>"
_TURNS = [("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())]
_TURNS_SQL = "low long, high long, turns long"


def _out(rows: list[dict], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))


def _batched(rows: Iterator[dict], fields: list) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, each with `chars` characters of text."""
    held, chars = [], 0
    for row in rows:
        chars += row.pop("chars")
        held.append(row)
        if chars > BLOCK_CHARS or len(held) >= 1000:
            yield _out(held, fields)
            held, chars = [], 0
    if held:
        yield _out(held, fields)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that end inside the task, solved; the others in blocks with their place in the order."""
    place = TaskContext.get().partitionId() << 33
    kind = None

    def finished(key, rows, turns, chars):
        symbols, counts = faults(rows, set())
        cost, letters = solve(runs_of(symbols))
        low, high, different = _turns(turns)
        audit = "".join(letters)
        return {
            "key": key, "piece": -1, "gaps": high - low + 1 - different if different else 0, **dict(zip(_COUNTS, counts)),
            "cost": cost, "audit": audit, "repaired": edited([r[:2] for r in rows], audit), "chars": chars,
        }

    def block(key, rows, turns, chars):
        nonlocal place
        place += 1
        return {"key": key, "piece": place, **dict(zip(("low", "high", "turns"), _turns(turns))), "block": [dict(zip(("role", "text", "last"), r)) for r in rows], "chars": chars}

    def results():
        nonlocal kind
        key, rows, turns, chars, opened, first, any_yet = None, [], [], 0, False, True, False
        for b in batches:
            kind = b.schema.field("key").type
            for k, turn, *row in zip(*[b.column(c).to_pylist() for c in ("key", "turn", "role", "text", "last")]):
                if any_yet and k != key:
                    if rows:
                        yield (block if opened or first else finished)(key, rows, turns, chars)
                    rows, turns, chars, opened, first = [], [], 0, False, False
                key, any_yet = k, True
                rows.append(tuple(row))
                turns.append(turn)
                chars += len(row[1])
                if len(rows) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                    yield block(key, rows, turns, chars)
                    rows, turns, chars, opened = [], [], 0, True
        if rows:
            yield block(key, rows, turns, chars)

    it = results()
    head = next(it, None)
    if head is not None:
        fields = [("key", kind), ("piece", pa.int64()), *_SOLVED, *_TURNS, ("block", _BLOCK)]

        def all_of():
            yield head
            yield from it

        yield from _batched(all_of(), fields)


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols and counts of each block; `seen` has the marks of rows in earlier blocks."""
    for b in batches:
        rows = []
        for r in b.to_pylist():
            earlier = set(r["seen"] or ())
            block = [(x["role"], x["text"], x["last"]) for x in r["block"]]
            seen = {x[:2] for x in block if mark(*x[:2]) in earlier} if earlier else set()
            symbols, counts = faults(block, seen)
            rows.append({"key": r["key"], "piece": r["piece"], "symbols": symbols, **dict(zip(_COUNTS, counts)),
                         "first": block[0][0][:1], "last": block[-1][0][:1], **{c: r[c] for c, _ in _TURNS}})
        yield _out(rows, [("key", b.schema.field("key").type), ("piece", pa.int64()), ("symbols", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("first", pa.string()), ("last", pa.string()), *_TURNS])


def _joined(table: pa.Table) -> pa.Table:
    """All blocks of one conversation: the edits of each, with the totals in the first."""
    parts = table.sort_by("piece").to_pylist()
    cost, letters = solve(runs_of("".join(p["symbols"] for p in parts)))
    audit, at, state, out = "".join(letters), 0, 0, []
    illegal = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
    some = [p for p in parts if p["turns"]]
    different = sum(p["turns"] for p in some) - sum(a["high"] == b["low"] for a, b in zip(some, some[1:]))
    gaps = some[-1]["high"] - some[0]["low"] + 1 - different if some else 0
    for n, p in enumerate(parts):
        stop, left = at, len(p["symbols"])
        while left:
            left -= audit[stop] != "I"
            stop += 1
        if n == len(parts) - 1:
            stop = len(audit)
        out.append({"key": p["key"], "piece": p["piece"], "gaps": 0 if n else gaps, **{c: p[c] for c in _COUNTS}, "cost": 0 if n else cost, "audit": audit[at:stop], "state": state})
        state = state_after(p["symbols"], audit[at:stop], state)
        at = stop
    out[0]["illegal"] += illegal
    fields = [("key", table.schema.field("key").type), ("piece", pa.int64()), *_SOLVED[:-1], ("state", pa.int32())]
    return pa.Table.from_pylist(out, schema=pa.schema(fields))


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        done = [edited([(x["role"], x["text"]) for x in r["block"]], r["audit"], r["state"]) for r in b.select(["block", "audit", "state"]).to_pylist()]
        kept = [f[0] for f in [("key", None), ("piece", None), *_SOLVED[:-1]]]
        yield pa.record_batch([*[b.column(c) for c in kept], pa.array(done, _ROWS)], [*kept, "repaired"])


def mark(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _mark(row: Column) -> Column:
    return F.md5(F.concat(F.length(row["role"]).cast("string"), F.lit(":"), row["role"], row["text"]))


@dataclass
class Repair:
    """`pieces` has (key, piece, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired), in order of `piece`
    within a conversation; almost all conversations are one piece, with number -1. Sums over pieces are the conversation's."""

    pieces: DataFrame

    def rows(self) -> DataFrame:
        """The repaired rows as (key, piece, position, role, text)."""
        return self.pieces.select("key", "piece", F.posexplode("repaired").alias("position", "row")).select("key", "piece", "position", "row.*")

    def summary(self) -> DataFrame:
        """One row per conversation: faults, cost and audit of its edits."""
        sums = ["gaps", *_COUNTS, "cost"]
        whole = self.pieces.where("piece < 0").select("key", *sums, "audit")
        parts = self.pieces.where("piece >= 0").groupBy("key").agg(
            *[F.sum(c).alias(c) for c in sums], F.sort_array(F.collect_list(F.struct("piece", "audit"))).alias("audits")
        )
        return whole.unionByName(parts.select("key", *sums, F.array_join("audits.audit", "").alias("audit")))

    def digests(self) -> DataFrame:
        """(key, repaired_sha256) of the lines `role:text`. A digest reads its conversation in order, piece by piece."""
        lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
        rows = self.pieces.select("key", "piece", lines.alias("lines"), F.size("repaired").alias("n"))
        whole = rows.where("piece < 0").select("key", F.sha2("lines", 256).alias("repaired_sha256"))
        kind = dict(rows.dtypes)["key"]
        parts = rows.where("piece >= 0").repartition("key").sortWithinPartitions("key", "piece")
        return whole.unionByName(parts.mapInArrow(_hashed, f"key {kind}, repaired_sha256 string"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest, empty, kind = None, None, True, None
    out = lambda: pa.record_batch([pa.array([key], kind), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])
    for b in batches:
        kind = b.schema.field("key").type
        for k, lines, n in zip(*[b.column(c).to_pylist() for c in ("key", "lines", "n")]):
            if digest is not None and k != key:
                yield out()
                digest = None
            if digest is None:
                key, digest, empty = k, hashlib.sha256(), True
            if n:
                digest.update((b"" if empty else b"\n") + lines.encode())
                empty = False
    if digest is not None:
        yield out()


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest repair of every conversation."""
    string = lambda c: F.coalesce(by_name(c).cast("string"), F.lit(" "))
    plain = rows.select(by_name(key).alias("key"), by_name(turn).cast("long").alias("turn"), string(role).alias("role"), string(text).alias("text"))
    plain = plain.select("*", F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1).alias("last"))
    # equal rows may lie on either side of a bound: they are interchangeable
    order = [
        F.asc_nulls_first("key"), F.asc_nulls_first("turn"), F.col("role"), F.substring("text", 1, 32), F.md5("text"),
        F.monotonically_increasing_id(),
    ]
    placed = plain.select("*", *[x.alias(f"order{i}") for i, x in enumerate(order[3:])])
    order = [*order[:3], *[F.col(f"order{i}") for i in range(3)]]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "turn", "role", "text", "last")
    kind = dict(plain.dtypes)["key"]
    schema = f"key {kind}, piece long, {_SOLVED_SQL}, {_TURNS_SQL}, block array<struct<role string, text string, last string>>"
    first = stored(ranged.mapInArrow(_first_pass, schema))
    columns = ["key", "piece", *[f[0] for f in _SOLVED]]
    whole, blocks = first.where("piece < 0").select(*columns), first.where("piece >= 0")
    # marks that an earlier block has too; each block lists a mark once
    marks = blocks.select("key", "piece", F.explode(F.array_distinct(F.transform("block", _mark))).alias("mark"))
    firsts = marks.groupBy("key", "mark").agg(F.min("piece").alias("least"), F.count("*").alias("n")).where("n > 1")
    again = marks.alias("m").join(firsts.alias("f"), [F.col("m.key").eqNullSafe(F.col("f.key")), F.col("m.mark") == F.col("f.mark"), F.col("m.piece") > F.col("f.least")])
    seen = again.groupBy("m.piece").agg(F.collect_list("m.mark").alias("seen"))
    marked = blocks.select("key", "piece", *[c for c, _ in _TURNS], "block").join(seen, "piece", "left")
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    found = marked.select("key", "piece", *[c for c, _ in _TURNS], "block", "seen").mapInArrow(
        _symbols, f"key {kind}, piece long, symbols string, {counts}, first string, last string, {_TURNS_SQL}"
    )
    solved = found.groupBy("key").applyInArrow(_joined, f"key {kind}, piece long, {_SOLVED_SQL.rsplit(', repaired', 1)[0]}, state int")
    edits = blocks.select("piece", "block").join(solved, "piece").mapInArrow(_rewritten, f"key {kind}, piece long, {_SOLVED_SQL}")
    return Repair(whole.unionByName(stored(edits)))
