import hashlib
import itertools
import random
import re
import zlib

import pytest

from tabloom.llm import conversations as cv
from tabloom.llm.queries import damaged, op12_conversation_repair

FORM = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, piece int, key string, block string"
NOTHING = hashlib.sha256(b"").hexdigest()


def kind(role, text, seen):
    if not re.search(r"[^\x20\x09-\x0D]", text):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "" if re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] in ".!?" else "truncated"


def best(rows):
    """Forward over rows: per state of the form the least (cost, audit) and its lines."""

    def after(state, c):
        out = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("3", "u"): "2", ("2", "a"): "3"}
        return out.get((state, c))

    def grow(table, state, value):
        if state is not None and (state not in table or value[:2] < table[state][:2]):
            table[state] = value

    def inserts(table):
        for _ in range(4):
            for state, (c, a, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    grow(table, after(state, role[0]), (c + 3, a + "I", (*lines, role + ":")))

    now, seen = {"0": (0, "", ())}, set()
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        fault = kind(role, text, seen)
        seen.add((role, text))
        counts.update({fault: counts[fault] + 1} if fault else {})
        inserts(now)
        then = {}
        for state, (c, a, lines) in now.items():
            grow(then, state, (c + 4, a + "D", lines))
            if fault in ("", "truncated"):
                extra = 3 if fault else 0
                grow(then, after(state, role[:1]), (c + extra, a + "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    grow(then, after(state, new[0]), (c + 3 + extra, a + "R", (*lines, f"{new}:{text}")))
        now = then
    inserts(now)
    done = min(now[s][:2] + (now[s][2],) for s in ("0", "3") if s in now)
    return counts, done


def brute(rows):
    """Per conversation the query's row, from rows after damage (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.md5(r[2].encode()).hexdigest()))
        counts, (cost, audit, lines) = best([r[1:] for r in mine])
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def hurt(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if x is None else x for x in (role, text))
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if n == 0:
            continue
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out += [(conv, turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return out


def made(seed, convs, longest, roles=("system", "user", "assistant", "user", "assistant", "tool", "sage", ""), texts=6):
    rng = random.Random(seed)
    said = ["Yes.", "No", "Why?\n ", " ", "", "It is. It", *[f"line {i}!" for i in range(texts)]]
    return [(c, t * rng.choice((1, 1, 1, 2)), rng.choice(roles), rng.choice(said)) for c in range(convs) for t in range(rng.randint(1, longest))]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "k", "b") for r in rows], SCHEMA).repartition(parts)


def found(repair):
    digests = dict(repair.digests().collect())
    return {r[0]: (*r[1:], digests[r[0]]) for r in repair.summary().collect()}


def test_exhaustive_on_short_conversations():
    """All edit sequences of all conversations of up to three symbols."""
    for symbols in itertools.chain.from_iterable(itertools.product("suaoSUAOx", repeat=n) for n in range(4)):
        spread = lambda d: [(o + i, (c + 3 * len(i), a + "I" * len(i))) for o, (c, a) in d for i in ("", "u", "a", "ua", "au")]
        states = [("", (0, ""))]
        for of in symbols:
            states = [
                (o + add, (c + cost, a + x))
                for o, (c, a) in spread(states)
                for add, cost, x in [("", 4, "D")] + ([] if of == "x" else [(of.lower(), 3 * of.isupper(), "K"), ("u", 3 + 3 * of.isupper(), "R"), ("a", 3 + 3 * of.isupper(), "R")])
            ]
            least = {}
            for o, v in states:
                if re.fullmatch("s?(ua)*u?", o) and v < least.get(o, (99, "")):
                    least[o] = v
            states = list(least.items())
        want = min(v for o, v in spread(states) if FORM.fullmatch(o))
        cost, letters = cv.solve(cv.runs_of("".join(symbols)))
        assert (cost, "".join(letters)) == want, symbols


def test_long_runs_equal_row_by_row():
    rng = random.Random(4)
    for _ in range(40):
        runs = [(rng.choice("suaoSUAOx"), rng.choice((1, 2, 3, 7, 100, 5000))) for _ in range(rng.randint(1, 6))]
        singles = [(of, 1) for of, n in runs for _ in range(n)]
        one, many = cv.solve(runs), cv.solve(singles)
        assert (one[0], "".join(one[1])) == (many[0], "".join(many[1]))


@pytest.mark.parametrize("block", [3, 4096])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cv, "BLOCK_ROWS", block)
    rows = made(1, 60, 14) + [(100, None, None, None), (100, None, "user", "a."), (100, 3, "user", None), (None, 1, "user", "x."), (None, 2, "assistant", "y.")]
    rows += [(200, 1, "user", "same.")] * 50 + [(201, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(60)] + [(202, 1, "user", "long " * 50_000 + ".")]
    repair = cv.repair(frame(spark, rows))
    assert found(repair) == brute(rows)
    out = {}
    for r in sorted(repair.rows().collect(), key=lambda r: (r.piece, r.position)):
        out.setdefault(r.key, []).append(f"{r.role}:{r.text}")
    digests = dict(repair.digests().collect())
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in out.items()} == {k: v for k, v in digests.items() if v != NOTHING}


def test_the_query_with_its_damage(spark, tmp_path):
    rows = made(7, 300, 9) + [(500, 48, "user", "gone?"), (None, None, None, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    out = op12_conversation_repair(spark, str(tmp_path))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = {c: (0, 0, 0, 0, 0, 0, "", NOTHING) for c in {r[0] for r in rows}} | brute(hurt(rows))
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want
    assert damaged(frame(spark, rows)).count() == len(hurt(rows))


def test_empty_table(spark):
    repair = cv.repair(frame(spark, []))
    assert repair.summary().collect() == [] and repair.digests().collect() == [] and repair.rows().collect() == []
