import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tabloom.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, best=20):
    cut = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    cut = [(i, c, sum(c.values())) for i, c in cut if c]
    n_docs, n_terms = len(cut), sum(n for _, _, n in cut)
    df = Counter(t for _, c, _ in cut for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c, n in cut:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed, count, vocabulary=60):
    rng = random.Random(seed)
    word = lambda: f"w{int(vocabulary * rng.random() ** 2)}"
    return [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(count)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", 2)
    monkeypatch.setattr(lexical, "WIDTH", 3)
    monkeypatch.setattr(lexical, "SHARD_DOCS", 37)


def test_equals_brute_force(spark, frame, small):
    texts = made(1, 300)
    docs = list(enumerate(texts)) + [(900 + i, texts[5]) for i in range(30)]  # ties at the last rank
    docs += [(950, None), (951, ""), (952, " ,;"), (953, "É w1 É"), (None, texts[7]), (954, texts[8]), (954, texts[8])]
    docs += [(955, "w3 " * 40_000), (956, "W1-w2_w3\x00w4 ab1é")]
    items = [(i, t) for i, t in enumerate(made(2, 12))] + [(20, None), (21, "nowhere"), (22, texts[5]), (22, texts[5]), (23, "É w1 w1"), (24, "é\tAB1É"), (None, "w7")]
    benchmark = spark.createDataFrame([(*r, 7, "s") for r in items], "item_id long, text string, key int, score string")
    out = lexical.ranked(frame(docs), benchmark)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(out) == brute(docs, items)


def test_blocks_of_items(spark, frame, small, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    docs, items = list(enumerate(made(3, 100))), list(enumerate(made(4, 9)))
    assert got(lexical.ranked(frame(docs), spark.createDataFrame(items, "item_id long, text string"), best=5)) == brute(docs, items, 5)


def test_empty_tables(spark, frame):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(frame([]), items).collect() == []
    assert lexical.ranked(frame([(1, "a")]), items.where("false")).collect() == []


def test_range_maxima():
    rng = np.random.default_rng(5)
    df = np.array([1, 7, 64, 3])
    docs = np.concatenate([np.sort(rng.choice(80, n, False)) for n in df])
    impact = rng.integers(1, 30, len(docs))
    shard = lexical.Postings(np.arange(4), df, docs, impact, 80)
    for t, a, b in [(t, a, b) for t in range(4) for a in range(0, 81, 5) for b in range(a, 81, 7)]:
        x, y = shard.seek(np.array([t, t]), np.array([a, b]))
        inside = [(i, d) for i, d in zip(impact[shard.starts[t] : shard.starts[t + 1]], docs[shard.starts[t] : shard.starts[t + 1]]) if a <= d < b]
        top, doc = shard.top(np.array([x]), np.array([y]))
        assert top[0] == max((i for i, _ in inside), default=0)
        assert (top[0], doc[0]) in inside or not inside


def test_intervals_below_the_limit_are_never_scored():
    docs = np.arange(5000)
    impact = np.where(docs < 40, 1000, 1)
    shard = lexical.Postings(np.arange(1), np.array([5000]), docs, impact, 5000)
    best = lexical.Best(20)
    assert lexical.search(shard, np.array([0]), np.array([1]), best, list(range(5000))) < 600
    assert [r[2] for r in best.rows] == list(range(20))
