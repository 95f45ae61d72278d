from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from tabloom.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        left = ids.count(top) - 1
        for i in ids:
            kept = i == top and left >= 0
            out.append((i, top, len(ids), kept, sha256(t.encode()).hexdigest()))
            left = -1 if kept else left
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ROWS = (
    [(i, "a copy") for i in range(40)]
    + [(100, None), (101, ""), (102, " "), (103, "A copy"), (104, "a copy ")]
    + [(200, "twice"), (200, "twice"), (None, "no id"), (None, "no id"), (None, "with one"), (7000, "with one")]
    + [(300, "x" * 300_000), (301, "x" * 300_000), (302, "x" * 299_999 + "y"), (303, "é\u0000ß"), (304, "é")]
)


def test_equals_brute_force(frame):
    out = exact_dedup.copies(frame(ROWS), salts=3)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got(out) == brute(ROWS)


def test_colliding_digests_are_told_apart_by_text(frame):
    out = exact_dedup.copies(frame(ROWS), digest=lambda t: F.length(t) % 3, salts=2)
    assert got(out) == brute(ROWS)


def test_large_groups_beside_many_small_ones(spark, frame, monkeypatch):
    monkeypatch.setattr("tabloom.functions.lookup.BROADCAST_ROWS", 2)
    assert got(exact_dedup.copies(frame(ROWS), salts=4)) == brute(ROWS)


def test_survivors_keep_all_columns(spark, frame, tmp_path):
    df = frame(ROWS)
    df.write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    out = exact_dedup.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text or "") for r in out.collect()), key=repr) == sorted(((r[0], t or "") for r, t in [
        (b, next(t for i, t in ROWS if sha256((t or "").encode()).hexdigest() == b[4])) for b in brute(ROWS) if b[3]
    ]), key=repr)


def test_empty_table(frame):
    assert exact_dedup.copies(frame([])).collect() == []


def test_no_python_and_no_window_in_the_plan(frame):
    plan = exact_dedup.copies(frame(ROWS))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Window", "Cartesian", "NestedLoop"))
