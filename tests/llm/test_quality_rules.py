import random
import re
from itertools import permutations

from tabloom.llm.quality_rules import DEFAULT_RULES, quality_rules

WANTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def brute(text):
    t = text or ""
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", t) if w]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(8)}
    lines = [x for x in t.split("\n") if re.search("[^ \t\x0b\f\r]", x)]
    f = dict(
        n_words=len(words), word_chars=sum(map(len, words)), n_symbols=len(re.findall("[#*$%&|<>]", t)), n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=len(covered), n_lines=len(lines), n_capitals=len(re.findall("[A-Z]", t)),
    )
    n = len(words)
    bad = n < 20 or 100 * len(covered) > 30 * n or f["n_symbols"] * 2 > n or f["n_dup_lines"] * 100 > max(len(lines) * 30, 300)
    bad = bad or f["word_chars"] > 15 * n or f["word_chars"] < 2 * n or f["n_capitals"] * 2 > f["word_chars"]
    return f, not bad


def texts():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdé😀") for _ in range(r.randint(1, 8)))
    out = [None, "", " ", "\n\n", "a b c d e f g h", "a b c d e f g h i " * 3, "x " * 25, "line one\nline one\n" * 12, "UPPER CASE " * 15, "a\x0bb c", "w" * 20_000]
    for _ in range(40):
        some = [word() for _ in range(r.randint(1, 60))]
        parts = [" ".join(r.choice(some) for _ in range(r.randint(1, 20))) for _ in range(r.randint(1, 8))]
        parts += [r.choice(parts) for _ in range(r.randint(0, 4))]
        r.shuffle(parts)
        out.append(r.choice(["\n", " ", " # "]).join(parts))
    return out


def test_features_and_verdict(frame):
    given = texts()
    rows = [*enumerate(given), (None, given[12]), (12, given[12])]
    for features in (WANTED, None):
        for r in quality_rules(frame(rows), ["doc_id", "text", "n", "__keep"], features=features).collect():
            f, kept = brute(r.text)
            assert r.kept == kept and (r.rejected_by is None) == kept, r.text
            if features:
                assert {k: r[k] for k in WANTED} == f, r.text
    assert quality_rules(frame(rows).limit(0), ["doc_id"]).count() == 0


def test_order_changes_no_verdict(frame):
    given = frame(list(enumerate(texts()))[:25])
    import tabloom.llm.quality_rules as q

    kept = {r.doc_id: r.kept for r in quality_rules(given, ["doc_id"]).collect()}
    for order in list(permutations(DEFAULT_RULES))[::240]:
        old, q.order_rules = q.order_rules, lambda *a, order=order: list(order)
        try:
            assert {r.doc_id: r.kept for r in quality_rules(given, ["doc_id"]).collect()} == kept
        finally:
            q.order_rules = old
