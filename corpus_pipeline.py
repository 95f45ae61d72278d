"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, with the columns of documents; the last returns the pieces of the sequences.
Between two stages the documents are written as Parquet and read again, as stages number rows by their place in the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm import classifier, jaccard, mixing, packing, secrets
from tabloom.llm.stores import stored

QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. One document in five is never learnt from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    labels = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = classifier.fit(docs, labels, label="quality")
    scored = classifier.score(docs, model, [F.struct("*").alias("doc")])
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, the first of rows that share it."""
    placed = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("place"))
    keyed = placed.select(F.struct("doc.doc_id", "place").alias("key"), "doc.text")
    groups = jaccard.jaccard_components(keyed, key="key")
    firsts = groups.where(F.col("key") == F.col("component_id")).select("key.place")
    return placed.join(firsts, "place", "left_semi").select("doc.*")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret."""
    rest = F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("rest")
    found = secrets.find_secrets(docs, [rest], with_text=True)
    found = found.withColumn("text", secrets.redact(F.col("text"), F.col("spans")))
    changed = {"text": F.col("text"), "n_chars": F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("rest.n_chars"))}
    return found.select(*[changed.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares by source, language and topic are tempered."""
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic(F.col("text"))}
    return mixing.mix(docs, margins).where("kept").select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scan", redacted),
    ("source mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # the classifier is trained, which SQL cannot state; tests/llm checks each stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, stored(docs) if n else docs, sf_dir)
    return docs
