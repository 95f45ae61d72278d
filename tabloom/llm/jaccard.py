"""Documents whose sets of five-word shingles overlap: an exact Jaccard join under several global token orders.

Two sets with Jaccard similarity t or more share a token among the first ``n - ceil(t n) + 1`` tokens of each, under any
order of all tokens. Every order here puts tokens that fewer documents have first and breaks ties by a different hash. A pair
must share a prefix token under each order before its sets are compared.

How it runs:

1. Equal sets are one class. A small sketch of token frequencies finds the frequent tokens.
2. Fingerprints of the other tokens are dealt by value and counted; those of two or more documents go back to theirs. A
   token of one document comes first in every order and matches nothing, so a document goes on only if at least t of its
   set is shared with others, and only its shared tokens are carried.
3. Documents that share a prefix token under the first order form families (by the least member of each token, so a
   common token costs as many edges as it has documents).
4. A family that fits in a task is joined there. The documents of a larger one are compared with the leaders of their
   tokens first; then only pairs across the components found are compared.

Pairs inside a component that is already connected are never listed, so a group of copies costs work by its size.

Defined results: words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased. A text of fewer words than a shingle is one shingle;
an empty, blank or null text has an empty set, is linked with nothing and is its own component. Repeated rows are
linked. The component is the smallest non-null key in it. An empty table gives no rows. Only the key is carried, so
names cannot clash. The input must give the same rows in the same order each time it is read. Class ids are 64-bit
hashes of the sets, fingerprints the leading 56 bits of token hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .stores import stored
from .texts import mix, shingle_sets, slices
from .tokens import release_encoders

BIN_BITS = 18  # token frequencies are sketched in so many bins, whatever the corpus
SEGMENTS = 64
BUCKET_TOKENS = 1 << 19  # fingerprints counted in one group of a task, about
FAMILY_DOCS = 4096  # a larger family is not joined in one task
FAMILY_TOKENS = 1 << 22
TASK_PAIRS = 2_000  # comparisons with one leader in one group
ORDERS = (0x1B873593CC9E2D51, 0x85EBCA6B27D4EB2F, 0x2545F4914F6CDD1D)
UNIT_BITS = 12  # so many low bits of a row's number tell documents of one unit apart
PRINT_BYTES = 7  # of a fingerprint, the leading ones of its 64-bit hash


def class_of(tokens: np.ndarray) -> int:
    """64-bit hash of a set, as a signed integer."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(tokens))
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def prefix(prints: np.ndarray, ranks: np.ndarray, n: int, order: int, percent: int) -> np.ndarray:
    """The shared tokens in the prefix of a set of `n`: what the tokens of one document leave, by rank, then hash."""
    size = prefix_size(n, percent) - (n - len(prints))
    if size <= 0:
        return prints[:0]
    place = (ranks.astype(np.uint64) << np.uint64(58)) | (mix(prints ^ np.uint64(order)) >> np.uint64(6))
    return prints[np.argpartition(place, size - 1)[:size]]


def _pack(prints: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(prints.astype("<u8")[:, None].view(np.uint8)[:, :width]).tobytes()


def _unpack(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _steps(docs: np.ndarray) -> bytes:
    """Ascending integers as differences, which compress well."""
    return np.diff(docs, prepend=0).astype("<u4").tobytes()


def _unsteps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64))


def _groups(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, stop) of each run of equal sorted keys."""
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(keys)]):
        yield int(keys[a]), a, b


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        bins = np.zeros(1 << BIN_BITS, np.int64)
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), width)
            for tokens in sets:
                np.add.at(bins, (tokens >> np.uint64(64 - BIN_BITS)).astype(np.int64), 1)
            nothing = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield pa.record_batch(
                [
                    part.column("row"),
                    part.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                    *nothing,
                ],
                ["row", "key", "n", "id", "segment", "bins"],
            )
            key = part.schema.field("key").type
        if bins.any():
            each = bins.reshape(SEGMENTS, -1)
            yield pa.record_batch(
                [
                    pa.nulls(SEGMENTS, pa.int64()),
                    pa.nulls(SEGMENTS, key),
                    pa.nulls(SEGMENTS, pa.int64()),
                    pa.nulls(SEGMENTS, pa.int64()),
                    pa.array(range(SEGMENTS), pa.int32()),
                    pa.array([np.minimum(x, 2**31 - 1).astype(np.int32).tobytes() for x in each], pa.binary()),
                ],
                ["row", "key", "n", "id", "segment", "bins"],
            )

    return run


def _sum_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.frombuffer(raw, np.int32).astype(np.int64)
            total[segment] = total[segment] + found if segment in total else found
    if total:
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["segment", "bins"])


def frequency_levels(signatures: DataFrame) -> tuple[np.ndarray, int]:
    """One small level per bin: 0 up to twice the mean load, then one more for each doubling. Also all tokens' number."""
    parts = signatures.where("segment IS NOT NULL").select("segment", "bins")
    rows = parts.repartition("segment").mapInArrow(_sum_bins, "segment int, bins binary").collect()  # fixed size
    bins = np.zeros((SEGMENTS, (1 << BIN_BITS) // SEGMENTS), np.int64)
    for segment, raw in rows:
        bins[segment] = np.frombuffer(raw, np.int64)
    mean = max(bins.sum() / bins.size, 1.0)
    return np.clip(np.floor(np.log2(np.maximum(bins.ravel() / mean, 1.0))), 0, 30).astype(np.uint8), int(bins.sum())


ENTRIES = "bucket int, unit long, docs binary, prints binary, ranks binary"
_BINARY = pa.binary()


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = pa.int32(), pa.int64(), _BINARY, _BINARY, _BINARY
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "unit", "docs", "prints", "ranks"])


def _fingerprints(width: int, levels: np.ndarray, buckets: int, size: int):
    """Fingerprints by bucket; frequent ones at once with their rank (bucket -1); set sizes in place of ranks (bucket -2)."""
    shift = np.uint64(64 - 8 * size)

    def packed(unit: int, docs: list, sets: list) -> pa.RecordBatch:
        doc, token = np.repeat(docs, list(map(len, sets))), np.concatenate(sets)
        level = levels[(token >> np.uint64(64 - BIN_BITS)).astype(np.int64)]
        prints = token >> shift
        bucket = (mix(prints) % np.uint64(buckets)).astype(np.int32)
        bucket[level > 0] = -1
        order = np.argsort(bucket, kind="stable")
        doc, prints, bucket, level = doc[order], prints[order], bucket[order], level[order]
        rows = [
            (k, unit, _steps(doc[a:b]), _pack(prints[a:b], size), (level[a:b] + 32).tobytes() if k < 0 else None)
            for k, a, b in _groups(bucket)
        ]
        counts = np.array(list(map(len, sets)), "<u4")
        return _entries([*rows, (-2, unit, _steps(np.array(docs)), b"", counts.tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        docs, sets, held, unit = [], [], 0, 0
        for part in slices(batches, "text"):
            for row, s in zip(part.column("row").to_pylist(), shingle_sets(part.column("text"), width)):
                if not len(s) or (own := class_of(s)) in seen:
                    continue
                seen.add(own)
                if held > 1 << 20 or held and row >> UNIT_BITS != unit:
                    yield packed(unit, docs, sets)
                    docs, sets, held = [], [], 0
                unit = row >> UNIT_BITS
                docs.append(row & ((1 << UNIT_BITS) - 1))
                sets.append(s)
                held += len(s)
        if held:
            yield packed(unit, docs, sets)

    return run


def _counted(size: int):
    """Of one bucket: the fingerprints of two or more documents, ranked by the logarithm of their number."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.select(_NO_ENTRIES.column_names)
        docs = [_unsteps(x.as_py()) for x in table.column("docs")]
        unit = np.repeat(table.column("unit").to_numpy(), list(map(len, docs)))
        doc = np.concatenate(docs)
        prints = _unpack(b"".join(x.as_py() for x in table.column("prints")), size)
        order = np.argsort(prints, kind="stable")
        ordered = prints[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        many = np.diff(np.append(np.flatnonzero(new), len(new)))
        count = np.empty(len(prints), np.int64)
        count[order] = np.repeat(many, many)
        keep = count > 1
        unit, doc, prints, rank = unit[keep], doc[keep], prints[keep], np.log2(count[keep]).astype(np.uint8)
        order = np.lexsort((doc, unit))
        unit, doc, prints, rank = unit[order], doc[order], prints[order], rank[order]
        rows = [(0, u, _steps(doc[a:b]), _pack(prints[a:b], size), rank[a:b].tobytes()) for u, a, b in _groups(unit)]
        return pa.Table.from_batches([_entries(rows)]) if rows else _NO_ENTRIES

    return run


_NO_ENTRIES = pa.table(
    {"bucket": pa.array([], pa.int32()), "unit": pa.array([], pa.int64()), **{c: pa.array([], _BINARY) for c in ("docs", "prints", "ranks")}}
)


def _assembled(size: int, percent: int):
    """Of one unit of consecutive rows: the documents with enough shared tokens, with those tokens."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sizes: dict[int, int] = {}
        doc, prints, ranks = [], [], []
        for bucket, d, p, r in zip(*[table.column(c).to_pylist() for c in ("bucket", "docs", "prints", "ranks")]):
            if bucket == -2:
                sizes |= zip(_unsteps(d).tolist(), np.frombuffer(r, "<u4").tolist())
            else:
                doc.append(_unsteps(d))
                prints.append(_unpack(p, size))
                ranks.append(np.frombuffer(r, np.uint8))
        rows = []
        if doc:
            doc, prints, ranks = map(np.concatenate, (doc, prints, ranks))
            order = np.lexsort((prints, doc))
            doc, prints, ranks = doc[order], prints[order], ranks[order]
            base = key[0].as_py() << UNIT_BITS
            rows = [
                (base | d, sizes[d], prints[a:b].tobytes(), ranks[a:b].tobytes())
                for d, a, b in _groups(doc)
                if 100 * (b - a) >= percent * sizes[d]
            ]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = pa.int64(), pa.int64(), _BINARY, _BINARY
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "n", "prints", "ranks"])

    return run


def _first_prefix(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own, n, p, r in zip(*[b.column(c).to_pylist() for c in ("id", "n", "prints", "ranks")]):
                found = prefix(np.frombuffer(p, "<u8"), np.frombuffer(r, np.uint8), n, ORDERS[0], percent)
                if len(found):
                    each = len(found)
                    columns = [pa.array(found.view(np.int64)), pa.array(np.full(each, own)), pa.array(np.full(each, n))]
                    yield pa.record_batch(columns, ["token", "id", "n"])

    return run


def _postings(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(start of each token's list, lists of set numbers, the sets as token numbers)."""
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    order = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[order], np.arange(len(tokens) + 1))
    return starts, owner[order], np.split(place, np.cumsum(list(map(len, sets)))[:-1])


def _hits(postings: tuple, x: int, count: int) -> np.ndarray:
    """How many tokens set `x` shares with each set."""
    starts, owners, sets = postings
    lists = [owners[starts[t] : starts[t + 1]] for t in sets[x]]
    return np.bincount(np.concatenate(lists), minlength=count) if lists else np.zeros(count, np.int64)


def _family(percent: int):
    """Joins one family: (a, b) ties each document to the least class of its component."""

    def run(table: pa.Table) -> pa.Table:
        ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
        order = np.lexsort((ids, n))
        ids, n, count = ids[order], n[order], len(ids)
        prints = [np.frombuffer(table.column("prints")[i].as_py(), "<u8") for i in order.tolist()]
        ranks = [np.frombuffer(table.column("ranks")[i].as_py(), np.uint8) for i in order.tolist()]
        filters = [_postings([prefix(p, r, k, o, percent) for p, r, k in zip(prints, ranks, n.tolist())]) for o in ORDERS]
        whole = _postings(prints)
        part = np.arange(count)
        for x in range(count):
            near = (part != part[x]) & (percent * n <= 100 * n[x])
            near[:x] = False  # sorted by size: each pair once, from the smaller set
            for f in filters:
                if near.any():
                    near &= _hits(f, x, count) > 0
            found = np.flatnonzero(near)
            if not len(found):
                continue
            both = _hits(whole, x, count)[found]
            for y in found[100 * both >= percent * (n[x] + n[found] - both)].tolist():
                if part[x] != part[y]:
                    low, high = sorted((part[x], part[y]))
                    part[part == high] = low
        least = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(least, part, ids)
        return pa.table({"a": pa.array(least[part]), "b": pa.array(ids)})

    return run


def _compare(percent: int):
    """The sets that link with one leader's."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lead = key[0].as_py()
        ids, n = table.column("id").to_pylist(), table.column("n").to_pylist()
        read = lambda i: (np.frombuffer(table.column("prints")[i].as_py(), "<u8"), np.frombuffer(table.column("ranks")[i].as_py(), np.uint8))
        at = ids.index(lead)
        a, ranks = read(at)
        first = [prefix(a, ranks, n[at], o, percent) for o in ORDERS]
        found = []
        for i, own in enumerate(ids):
            if own == lead:
                continue
            b, ranks = read(i)
            if all(len(np.intersect1d(f, prefix(b, ranks, n[i], o, percent), assume_unique=True)) for f, o in zip(first, ORDERS)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (n[at] + n[i] - both):
                    found.append(own)
        return pa.table({"a": pa.array([lead] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return run


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link; `a` leads, and its comparisons are dealt over groups of a bounded size."""
    tasks = F.ceil(F.col("n") / F.lit(TASK_PAIRS)).cast("long")
    dealt = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")), "a").select(
        F.col("a").alias("lead"), "b", F.pmod(F.xxhash64("b"), tasks).cast("int").alias("salt")
    )
    places = dealt.select("lead", "salt", F.col("b").alias("id")).unionByName(
        dealt.select("lead", "salt", F.col("lead").alias("id")).distinct()
    )
    return places.join(sets, "id").groupBy("lead", "salt").applyInArrow(_compare(percent), "a long, b long")


def _large_families(sets: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """(a, b) for families that no single task joins: leaders first, then what lies across components."""
    near = F.expr(f"100L * least(n, m) >= {percent}L * greatest(n, m)")
    leads = postings.groupBy("token").agg(F.min(F.struct("n", "id")).alias("lead"))
    pairs = postings.join(leads, "token").withColumn("m", F.col("lead.n")).where(near & (F.col("id") != F.col("lead.id")))
    pairs = stored(pairs.select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct())
    links = stored(_verified(sets, pairs, percent))
    part = stored(components(links))
    held = stored(postings.join(part, "id", "left").withColumn("component", F.coalesce("component", "id")))
    mixed = held.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    held = held.join(mixed, "token")
    x = held.select("token", "n", F.col("id").alias("a"), F.col("component").alias("one"))
    y = held.select("token", F.col("n").alias("m"), F.col("id").alias("b"), F.col("component").alias("other"))
    cross = x.join(y, "token").where(near & (F.col("one") != F.col("other")) & (F.col("a") < F.col("b"))).select("a", "b").distinct()
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return links.unionByName(_verified(sets, stored(cross.join(known, ["a", "b"], "left_anti")), percent))


def jaccard_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    family_docs: int = FAMILY_DOCS,
    family_tokens: int = FAMILY_TOKENS,
) -> DataFrame:
    """(key, n_shingles, component_id) for every row of `docs`."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]
    signatures = stored(rows.mapInArrow(_signatures(width), f"row long, key {kind}, n long, id long, segment int, bins binary"))
    levels, tokens = frequency_levels(signatures)
    signatures = signatures.where("segment IS NULL").select("row", "key", "n", "id")
    classes = signatures.where("id IS NOT NULL").groupBy("id").agg(F.min("row").alias("row"), F.min("key").alias("key"))

    size = PRINT_BYTES
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), tokens // BUCKET_TOKENS)
    entries = rows.select("row", "text").mapInArrow(_fingerprints(width, levels, buckets, size), ENTRIES)
    # frequent tokens and sizes pass through a group of their own; only the others are counted
    entries = entries.withColumn("place", F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(-1 - F.col("unit")))
    back = entries.groupBy("place").applyInArrow(_counted(size), ENTRIES)
    shared = back.groupBy("unit").applyInArrow(_assembled(size, percent), "row long, n long, prints binary, ranks binary")
    sets = stored(shared.join(classes.select("row", "id"), "row").drop("row"))

    postings = sets.select("id", "n", "prints", "ranks").mapInArrow(_first_prefix(percent), "token long, id long, n long")
    postings = stored(postings)
    leads = postings.groupBy("token").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last")
    edges = postings.join(leads, "token").where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    families = stored(components(edges))
    sets = stored(sets.join(families, "id"))
    counts = sets.groupBy("component").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"))
    large = stored(counts.where((F.col("docs") > family_docs) | (F.col("tokens") > family_tokens)).select("component"))
    part = sets.join(large, "component", "left_anti").groupBy("component").applyInArrow(_family(percent), "a long, b long")
    part = part.select(F.col("a").alias("component"), F.col("b").alias("id"))
    if not large.isEmpty():
        rest = sets.join(large, "component").drop("component")
        part = part.unionByName(components(_large_families(rest, postings.join(rest.select("id"), "id"), percent)).select("component", "id"))

    named = stored(classes.select("id", "key").join(part, "id", "left").withColumn("component", F.coalesce("component", "id")))
    least = named.groupBy("component").agg(F.min("key").alias("least"))
    named = named.join(least, "component").select("id", "least")
    out = signatures.join(named, "id", "left")
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("least")).alias("component_id"),
    )
