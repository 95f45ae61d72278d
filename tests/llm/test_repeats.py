import random

import numpy as np
import pytest

from tabloom.llm.repeats import Phrases, remove_repeats


def brute(texts, size):
    raws = [(t or "").encode() for t in texts]
    count = {}
    for b in raws:
        for i in range(len(b) - size + 1):
            count[b[i : i + size]] = count.get(b[i : i + size], 0) + 1
    out = []
    for b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = [i for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((len(b), sum(gone), len(runs), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéfgh") for _ in range(r.randint(1, 7)))
    passage = [" ".join(word() for _ in range(r.randint(5, 40))) for _ in range(8)]
    out = [None, "", " ", "a" * 300, "a" * 41, "ab" * 100, "x" * 39]
    for _ in range(60):
        parts = [r.choice(passage) if r.random() < 0.4 else " ".join(word() for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 6))]
        t = " ".join(parts)
        out.append(t)
        if r.random() < 0.3:
            at = r.randrange(len(t))
            out.append(t[:at] + r.choice("xyz") + t[at + 1 :])
        if r.random() < 0.2:
            out += [t] * r.randint(1, 3)
    return out


@pytest.mark.parametrize("seed,size,hot", [(1, 40, 20_000), (2, 40, 1), (3, 200, 20_000), (4, 200, 0)])
def test_same_as_all_windows(frame, seed, size, hot):
    given = texts(seed)
    got = {r.doc_id: r for r in remove_repeats(frame(enumerate(given)), size=size, hot=hot).collect()}
    for i, (n, gone, spans, kept) in enumerate(brute(given, size)):
        r = got[i]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.starts), bytes(r.kept)) == (n, gone, spans, kept), given[i]


def test_repeated_rows_null_keys_and_empty_table(frame):
    t = " ".join(f"w{i}" for i in range(100))
    out = remove_repeats(frame([(1, t), (1, t), (None, "z" + t), (None, None)])).collect()
    kept = sorted((r.doc_id or 0, r.n_bytes, bytes(r.kept)) for r in out)
    assert kept == [(0, 0, b""), (0, len(t) + 1, b"z"), (1, len(t), b""), (1, len(t), b"")]
    assert remove_repeats(frame([(1, "x")]).limit(0)).count() == 0


def test_triggers_depend_on_the_window_alone():
    r = random.Random(5)
    window = bytes(r.choice(b"abc ") for _ in range(200))
    places = set()
    for n in (0, 1, 50, 300):
        data = bytes(r.choice(b"abc ") for _ in range(n)) + window + b"tail" * 60
        p = Phrases(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        own = np.flatnonzero((p.first <= n) & (n <= p.last))
        assert len(own) == 1
        places.add(int(p.place[own[0]]) - n)
    assert len(places) == 1
