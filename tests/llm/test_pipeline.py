"""Each stage of the pipeline against a plain version of it, on a small folder of tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tabloom.llm import classifier, mixing
from tabloom.llm.secrets import RULES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `__place` int, spans string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    good = "the of and into with green house river garden morning quiet stone paper window bread".split()
    rows, labels = [], []
    for i in range(90):
        text = " ".join(r.choice(good) for _ in range(r.randint(30, 80))) if i % 4 else "BUY!! NOW!! " * r.randint(8, 30)
        if i % 7 == 1:
            text += " password = hunter" + str(i) * 3
        rows.append((i, text, r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", None]), len(text), 1, "s"))
        if i % 3 == 0 or i % 4 == 1:
            labels.append((i, int(i % 4 > 0), 0))
    for i in range(12):
        source = rows[4 * i + 1]
        rows.append((200 + i, source[1] + (" extra" if i % 2 else ""), *source[2:]))
    rows += [(300, None, "en", "a", 0, 1, "s"), (301, "", "en", "b", 0, 1, "s"), (None, rows[2][1], "en", "a", 5, 1, "s"), rows[2], rows[2]]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def shingle_set(text):
    w = re.split("[ \t\n\x0b\f\r]+", text.strip().lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_stages(spark, folder):
    documents = docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for n, (name, stage) in enumerate(cp.STAGES):
        path = f"{folder}/stage{n}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == documents.columns or n == 4, name
        kept.append([r.asDict() for r in docs.collect()])
    start = [r.asDict() for r in documents.collect()]

    labels = spark.read.parquet(f"{folder}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = classifier.fit(documents, labels, label="quality")
    good = classifier.score(documents, model, [F.struct("*").alias("d")]).where("score >= 0.3").select("d.*")
    order = lambda rows: sorted(rows, key=repr)
    assert order(kept[0]) == order(r.asDict() for r in good.collect())
    assert all(r["text"] for r in kept[0]) and len(kept[0]) < len(start)

    sets = [shingle_set(r["text"]) for r in kept[0]]
    part = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if part[i] != part[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    groups = {}
    for r, p in zip(kept[0], part):
        groups.setdefault(p, []).append(r)
    firsts = [min((r["doc_id"] is not None, r["doc_id"] or 0) for r in g) for g in groups.values()]
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept[1]) == sorted(firsts)
    assert all(r in kept[0] for r in kept[1])

    clean = {repr(r["doc_id"]): r for r in kept[2]}
    assert len(clean) == len(kept[2]) == len(kept[1])
    for r in kept[1]:
        text = r["text"]
        for rule in RULES[:1]:
            text = re.sub(rule.pattern, lambda m: "[secret]" if len(m.group(2)) >= 6 else m.group(), text)
        assert clean[repr(r["doc_id"])]["text"] == text and clean[repr(r["doc_id"])]["n_chars"] == (len(text) if text != r["text"] else r["n_chars"])

    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic(F.col("text"))}
    third = spark.read.parquet(f"{folder}/stage2")
    drawn = mixing.mix(third, margins).where("kept").select("doc.*")
    assert order(kept[3]) == order(r.asDict() for r in drawn.collect()) and kept[3]

    assert {r["doc_id"] for r in kept[4]} == {r["doc_id"] for r in kept[3]}
    for r in kept[3]:
        pieces = sorted((p for p in kept[4] if p["doc_id"] == r["doc_id"]), key=lambda p: p["start"])
        assert sum(p["length"] for p in pieces) == pieces[0]["doc_tokens"] == sum(len(p["ids"]) for p in pieces) // 4


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_run_stores_every_stage(spark, folder, monkeypatch):
    plans = []

    def watched(stage):
        def run(spark, docs, sf_dir):
            plans.append(docs._jdf.queryExecution().analyzed().toString())
            return stage(spark, docs, sf_dir)

        return run

    many = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for n, (_, stage) in enumerate(cp.STAGES):
            stage(spark, docs, folder).write.parquet(f"{folder}/alone{n}")
            docs = spark.read.parquet(f"{folder}/alone{n}")
        monkeypatch.setattr(cp, "STAGES", [(name, watched(stage)) for name, stage in cp.STAGES])
        pieces = cp.run(spark, folder).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(plans) == 5 and all(p.startswith("Relation ") and p.count("\n") <= 1 for p in plans)
    whole = lambda rows: {repr(k): sorted((p["start"], bytes(p["ids"])) for p in rows if p["doc_id"] == k) for k in {p["doc_id"] for p in rows}}
    text = lambda found: {k: b"".join(ids for _, ids in v) for k, v in found.items()}
    assert text(whole(pieces)) == text(whole(docs.collect())) and pieces
