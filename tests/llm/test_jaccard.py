import random

import numpy as np
import pytest

from tabloom.llm.components import components
from tabloom.llm.jaccard import jaccard_components


def brute(rows, width=5, percent=80):
    sets = []
    for _, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").split("[ \t\n\x0b\f\r]+", low) if x]
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                part[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted((k if k is not None else -1, len(sets[i]), least.get(root(i), -1)) for i, (k, _) in enumerate(rows))


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    boiler = [word() for _ in range(60)]
    out = [None, "", " \n ", "one", "One", "one two three four", "one two three  FOUR", "one two three four five", "a b " * 300]
    for _ in range(25):
        base = [word() for _ in range(r.randint(5, 120))] + (boiler if r.random() < 0.5 else [])
        out.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(copy) // 30))):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy[: r.randint(len(copy) * 9 // 10, len(copy))]))
    return out


@pytest.mark.parametrize("seed,limits", [(1, {}), (2, {}), (1, {"family_docs": 1}), (3, {"family_docs": 2, "family_tokens": 200})])
def test_same_as_all_pairs(frame, seed, limits):
    rows = list(enumerate(texts(seed)))
    rows += [(rows[12][0], rows[12][1]), (None, rows[14][1]), (None, None), (5000, rows[20][1])]
    got = jaccard_components(frame(rows), **limits).collect()
    mine = sorted(tuple(-1 if v is None else v for v in r) for r in got)
    assert mine == brute(rows)


def test_empty_table_and_no_links(frame):
    assert jaccard_components(frame([(1, "x")]).limit(0)).count() == 0
    assert sorted(map(tuple, jaccard_components(frame([(1, "x y"), (2, None)])).collect())) == [(1, 1, 1), (2, 0, 2)]


def test_components_of_chains_and_stars(spark):
    r = random.Random(6)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(r.randint(200, 230), r.randint(200, 230)) for _ in range(20)]
    part = {}
    for a, b in pairs:
        part.setdefault(a, a), part.setdefault(b, b)
    for _ in range(60):
        for a, b in pairs:
            part[a] = part[b] = min(part[a], part[b])
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {k: v for k, v in part.items() if any(k in p and p[0] != p[1] for p in pairs)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
