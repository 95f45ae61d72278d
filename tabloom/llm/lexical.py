"""Ranked lexical search: best-first over document intervals, bounded by range maxima of the posting lists.

Documents are dealt into shards as they are read. A shard holds one posting list for each term that any item asks for, and
a sparse table over the lists: the place of the largest impact in any run of 2^k postings. A search starts with the
interval of all documents of the shard. The bound of an interval is the sum, over the item's terms, of the largest impact
inside it, each found with two entries of the table. The intervals with the highest bounds are split at the document of
their largest weighted impact, which is scored; intervals of a few documents are scored whole. An interval whose bound is
below the lowest of the best scores so far is dropped; that limit is carried from shard to shard of a task. Only a task's
best per item are ranked across tasks.

Items are served in blocks of at most BLOCK_TERMS terms (one longer item is a block of its own), and only the block's terms
and weights are sent to the tasks. Counts of documents and terms, and document frequencies, cover all documents. Terms are
compared by 64-bit hashes. All scores are 64-bit integers.

Defined results: null or empty texts have no terms; an item without terms, or none that any document holds, gets no rows.
Equal scores go by ascending key, null first; rows that share a key and a score are interchangeable. Repeated items are
answered one by one. Only key and text are read, so names cannot clash. An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import by_name
from ..functions.order import ordered
from .stores import stored
from .texts import slices, text_bytes, word_hashes, words

BEST = 20
BLOCK_TERMS = 500_000
SHARD_DOCS = 4096
SHARD_POSTINGS = 1 << 19  # a shard ends with the document that reaches either number
SHARDS_PER_TASK = 4
LEAF = 32  # documents of an interval that is scored whole
WIDTH = 256  # intervals taken at once

#: Bytes between terms: [\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F].
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all terms of all texts, first term of each text and the total); only A-Z are lower-cased."""
    data, offsets = text_bytes(texts)
    starts, stops, bounds = words(data, offsets, _BETWEEN)
    return word_hashes(data, starts, stops, between=_BETWEEN), bounds


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        hashes, bounds = terms(part.column("text"))
        some = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(bounds, bounds[1:])]
        yield pa.record_batch(
            [
                part.column("item"),
                part.column("item_id"),
                pa.array([len(t) for t, _ in some], pa.int64()),
                pa.array([t.view(np.int64) for t, _ in some], pa.list_(pa.int64())),
                pa.array([c for _, c in some], pa.list_(pa.int64())),
            ],
            ["item", "item_id", "size", "terms", "counts"],
        )


class _Shard:
    """Documents and their (term, frequency) pairs, collected until the shard is full."""

    def __init__(self):
        self.keys, self.sizes, self.parts, self.postings = [], [], [], 0

    def add(self, key, size: int, found: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((np.full(len(found), len(self.keys)), found, counts))
        self.keys.append(key)
        self.sizes.append(size)
        self.postings += len(found)

    def full(self) -> bool:
        return len(self.keys) >= SHARD_DOCS or self.postings >= SHARD_POSTINGS

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        docs, found, counts = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((docs, found))
        listed, starts, df = np.unique(found[order], return_index=True, return_counts=True)
        one = lambda values, t: pa.array([values], pa.list_(t))
        return pa.record_batch(
            [
                one(self.keys, kind),
                one(np.array(self.sizes), pa.int64()),
                one(listed, pa.int32()),
                one(df, pa.int64()),
                one(docs[order], pa.int32()),
                one(counts[order], pa.int64()),
            ],
            ["keys", "sizes", "terms", "df", "docs", "tf"],
        )


def _index(vocabulary: np.ndarray):
    """Shards over the sorted 64-bit terms in `vocabulary`; a term is its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, kind = _Shard(), None
        for part in slices(batches, "text"):
            kind = part.schema.field("key").type
            hashes, bounds = terms(part.column("text"))
            place = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
            known = vocabulary[place] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
            for key, a, b in zip(part.column("key").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                if a < b:  # others are in neither count
                    shard.add(key, b - a, *np.unique(place[a:b][known[a:b]], return_counts=True))
                    if shard.full():
                        yield shard.batch(kind)
                        shard = _Shard()
        if shard.keys:
            yield shard.batch(kind)

    return run


class Postings:
    """The posting lists of a shard, one after the other, with a sparse table of range maxima."""

    def __init__(self, listed: np.ndarray, df: np.ndarray, docs: np.ndarray, impact: np.ndarray, size: int):
        self.listed, self.impact, self.docs, self.size = listed, impact, docs, size
        self.starts = np.concatenate([[0], np.cumsum(df)])
        self.keyed = np.repeat(np.arange(len(listed), dtype=np.int64), df) * (size + 1) + docs
        longest = int(df.max()) if len(df) else 1
        levels = [np.arange(len(docs), dtype=np.int32)]
        for k in range(1, longest.bit_length()):
            half, below = 1 << (k - 1), levels[-1]
            left, right = below[:-half], below[half:]
            best = np.where(impact[left] >= impact[right], left, right)
            levels.append(np.concatenate([best, below[len(best) :]]))  # the rest is never asked for
        self.table = np.stack(levels)

    def seek(self, lists: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """For each list and document, the place of the first posting at or behind the document."""
        return np.searchsorted(self.keyed, lists * (self.size + 1) + docs)

    def top(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest impact, its document) of the postings [a, b); 0 and -1 where there are none."""
        some = b > a
        level = np.frexp(np.maximum(b - a, 1).astype(np.float64))[1] - 1
        x = self.table[level, np.where(some, a, 0)]
        y = self.table[level, np.where(some, b - (1 << level), 0)]
        best = np.where(self.impact[x] >= self.impact[y], x, y)
        return np.where(some, self.impact[best], 0), np.where(some, self.docs[best], -1)


class Best:
    """The best documents of one item so far."""

    def __init__(self, count: int):
        self.count, self.rows, self.limit = count, [], 1

    def add(self, scores: np.ndarray, docs: np.ndarray, keys: list) -> None:
        fit = scores >= self.limit
        scores, docs = scores[fit], docs[fit]
        if not len(scores):
            return
        if len(scores) > self.count:  # more than `count` equal scores may have to be told apart by key
            least = np.partition(scores, -self.count)[-self.count]
            scores, docs = scores[scores >= least], docs[scores >= least]
        self.rows += [(-s, keys[d] is not None, keys[d]) for s, d in zip(scores.tolist(), docs.tolist())]
        self.rows = sorted(self.rows)[: self.count]
        if len(self.rows) == self.count:
            self.limit = max(-self.rows[-1][0], 1)


def search(shard: Postings, lists: np.ndarray, weights: np.ndarray, best: Best, keys: list) -> int:
    """Adds to `best` the shard's documents for the posting lists with these weights; returns how many it scored."""
    scored = 0

    def bounds(a, b):
        impact, docs = shard.top(a, b)
        weighted = impact * weights
        return weighted.sum(1), docs[np.arange(len(docs)), weighted.argmax(1)]

    lo, hi = np.zeros(1, np.int64), np.full(1, shard.size, np.int64)
    a, b = shard.starts[lists][None, :], shard.starts[lists + 1][None, :]
    bound, pivot = bounds(a, b)
    while True:
        live = np.flatnonzero(bound >= best.limit)
        if not len(live):
            return scored
        order = live[np.argsort(-bound[live], kind="stable")]
        taken, rest = order[:WIDTH], order[WIDTH:]
        small = hi[taken] - lo[taken] <= LEAF
        leaf, split = taken[small], taken[~small]
        # intervals of a few documents: all their postings, summed per document
        at = pivot[split]
        first, last = a[leaf], b[leaf]
        if len(split):
            seek_lists = np.broadcast_to(lists, (len(split), len(lists)))
            mid = shard.seek(seek_lists, at[:, None])
            beyond = shard.seek(seek_lists, at[:, None] + 1)
            first, last = np.concatenate([first, mid]), np.concatenate([last, beyond])
        sizes = last - first
        total = int(sizes.sum())
        flat = np.repeat(first.ravel() - np.concatenate([[0], np.cumsum(sizes.ravel())[:-1]]), sizes.ravel()) + np.arange(total)
        worth = np.repeat(np.broadcast_to(weights, sizes.shape).ravel(), sizes.ravel()) * shard.impact[flat]
        docs, where = np.unique(shard.docs[flat], return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, where, worth)
        scored += len(docs)
        best.add(sums, docs, keys)
        # the parts on both sides of the split documents
        lo = np.concatenate([lo[rest], lo[split], at + 1])
        hi = np.concatenate([hi[rest], at, hi[split]])
        if len(split):
            new_a, new_b = np.concatenate([a[split], beyond]), np.concatenate([mid, b[split]])
            new_bound, new_pivot = bounds(new_a, new_b)
            a, b = np.concatenate([a[rest], new_a]), np.concatenate([b[rest], new_b])
            bound, pivot = np.concatenate([bound[rest], new_bound]), np.concatenate([pivot[rest], new_pivot])
        else:
            a, b, bound, pivot = a[rest], b[rest], bound[rest], pivot[rest]


def _searched(items: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, count: int):
    """Shards to a task's best documents per item; `items` are (item, its terms, how often each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = [Best(count) for _ in items], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in batch.schema.names}
                kind = row["keys"].type
                sizes = row["sizes"].to_numpy()
                listed, docs, tf = (row[c].to_numpy() for c in ("terms", "docs", "tf"))
                if not len(listed):
                    continue
                m = 75 + (25 * sizes * n_docs) // n_terms
                shard = Postings(listed, row["df"].to_numpy(), docs, (1_000_000_000 * tf) // (1000 * tf + 12 * m[docs]), len(sizes))
                keys = row["keys"].to_pylist()
                for found, (_, asked, often) in zip(best, items):
                    at = np.minimum(np.searchsorted(listed, asked), len(listed) - 1)
                    held = listed[at] == asked
                    if held.any():
                        search(shard, at[held], weight[asked[held]] * often[held], found, keys)
        rows = [(item, key, -score) for (item, _, _), found in zip(items, best) for score, _, key in found.rows]
        if rows:
            item, key, score = zip(*rows)
            yield pa.record_batch([pa.array(item, pa.int64()), pa.array(key, kind), pa.array(score, pa.int64())], ["item", "key", "score"])

    return run


def _block(docs: DataFrame, items: DataFrame, count: int) -> DataFrame:
    """(item, key, score): the best of each task for the items of one block, which are few enough to hold."""
    rows = [(r.item, np.array(r.terms, np.int64).view(np.uint64), np.array(r.counts, np.int64)) for r in items.collect()]
    vocabulary = np.unique(np.concatenate([t for _, t, _ in rows])) if rows else np.zeros(0, np.uint64)
    kind = dict(docs.dtypes)["key"]
    index = stored(
        docs.mapInArrow(_index(vocabulary), f"keys array<{kind}>, sizes array<long>, terms array<int>, df array<long>, docs array<int>, tf array<long>")
    )
    sums = index.agg(F.sum(F.size("sizes")), F.sum(F.expr("aggregate(sizes, 0L, (s, x) -> s + x)"))).first()
    n_docs, n_terms = sums[0] or 0, sums[1] or 1
    held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df")).collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for term, df in held:
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    asked = [(item, np.searchsorted(vocabulary, t), c) for item, t, c in rows]
    index = index.repartition(max(1, index.count() // SHARDS_PER_TASK))  # the work of a shard is not in its bytes
    return index.mapInArrow(_searched(asked, weight, n_docs, n_terms, count), f"item long, key {kind}, score long")


def ranked(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", best: int = BEST
) -> DataFrame:
    """(item, rank, key, score): the `best` documents of each item with a score above 0, highest first."""
    docs = docs.select(by_name(key).alias("key"), by_name(text).cast("string").alias("text"))
    rows = items.select(F.monotonically_increasing_id().alias("item"), by_name(item).alias("item_id"), by_name(item_text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["item_id"]
    asked = stored(rows.mapInArrow(_item_terms, f"item long, item_id {kind}, size long, terms array<long>, counts array<long>"))
    total = asked.agg(F.sum("size")).first()[0] or 0
    if total > BLOCK_TERMS:
        line = ordered(asked.select("item", "size"), ["item"], sums={"stop": "size"}).df
        blocks = line.select("item", F.floor((F.col("stop") - F.col("size")) / BLOCK_TERMS).cast("long").alias("block"))
        asked = stored(asked.join(blocks, "item"))
        parts = [asked.where(F.col("block") == r.block) for r in asked.select("block").distinct().collect()]
    else:
        parts = [asked]
    found = None
    for part in parts:
        one = _block(docs, part, best)
        found = one if found is None else found.unionByName(one)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    top = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best)
    names = asked.select("item", F.col("item_id"))
    return names.join(top, "item").select(F.col("item_id").alias(item), "rank", F.col("key").alias(key), "score")
