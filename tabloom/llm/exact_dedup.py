"""Exact duplicates among documents, with DataFrame functions only.

Equal texts are combined three times, each time with the whole text in the grouping key: rows of one input partition first
(the map side of the first aggregate), then the rows of a digest that share a salt, then the winners of all salts. A text
that a third of all rows share thus never meets in one task: it is one row per partition, then one row per salt.

Only the digest, the winner and the size are kept of each group. Rows find their group by digest, which says as much as
the text, since the last combine has seen each digest with one text only. Should a digest stand for several texts, the rows
are looked up by digest and whole text instead. Groups that hold more than a thousandth of all rows are broadcast for that
(there are fewer than a thousand), the others are joined by shuffle.

Defined results: a null text is empty, and so equal to the empty one. Of equal texts the row with the largest key stays;
null keys are the smallest; of rows that share text and key, the first in the input stays. No other column is read, so
names cannot clash. An empty table gives no rows. Texts of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name
from ..functions.lookup import lookup
from .stores import stored

SALTS = 64


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _grouped(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column], salts: int) -> DataFrame:
    """Rows as (place, key, digest, sha, keep_id, group_size, first): `first` is the place of the row that stays."""
    content = F.coalesce(by_name(text).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("place"), by_name(key).alias("key"), content.alias("content"))
    rows = rows.select("*", digest(F.col("content")).alias("digest"))
    salt = F.pmod(F.xxhash64("place"), F.lit(salts)).alias("salt")
    local = rows.groupBy("digest", salt, "content").agg(F.max("key").alias("keep_id"), F.count("*").alias("group_size"))
    whole = local.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    light = stored(rows.select("place", "key", "digest", sha256(F.col("content")).alias("sha")))
    groups, keys = stored(whole.drop("content")), ["digest"]
    if not groups.groupBy("digest").count().where("count > 1").isEmpty():
        light = rows.select("*", sha256(F.col("content")).alias("sha"))
        groups, keys = stored(whole), ["digest", "content"]
    firsts = light.groupBy(*keys, "key").agg(F.min("place").alias("first")).alias("f")
    same = [F.col(f"g.{k}") == F.col(f"f.{k}") for k in keys] + [F.col("g.keep_id").eqNullSafe(F.col("f.key"))]
    winners = groups.alias("g").join(firsts, same).select("g.*", "f.first", F.col("g.group_size").alias("weight"))
    return lookup(light, winners, keys, "weight", groups.count()).drop("content")


def copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = SALTS
) -> DataFrame:
    """One row per document: (key, keep_id, group_size, kept, text_sha256)."""
    found = _grouped(docs, key, text, digest, salts)
    return found.select(
        F.col("key").alias(key), "keep_id", "group_size", (F.col("place") == F.col("first")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = SALTS
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. `docs` must be a stored table, as rows are found again by place."""
    stay = _grouped(docs, key, text, digest, salts).where("place = first").select("place")
    placed = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("place"))
    return placed.join(stay, "place", "left_semi").select("doc.*")
