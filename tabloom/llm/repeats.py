"""Removes every byte inside a long string that occurs more than once in the corpus, by prefix-free parsing.

Strings are the `size`-byte windows of the texts. A rolling hash over `GRAM` bytes triggers where it is least among `REACH`
consecutive places; triggers cut the texts into phrases, and each window belongs to the first trigger that is least in it. Which one that
is depends on the window's bytes alone, so equal windows meet at equal triggers.

1. Parse: per trigger one fingerprint of the bytes that all its windows share and one of the bytes that they cover
   together. A trigger whose shared bytes occur once has no repeated window; if the covered bytes occur again, all its
   windows are repeated. Nothing else leaves a text, so a long copy costs two numbers per phrase.
2. Triggers that are neither, where copies begin and end, send their surroundings, and of equal surroundings one
   copy. In a task, the strings before the triggers (the phrases' suffixes, read backwards) and those after them (the parse
   from there) are each brought into suffix order with the lengths that neighbours have in common. A window is a suffix of
   a phrase and a start of the parse, so its place in corpus order is a pair of places, and it is repeated if two triggers
   share the pair. A trigger with very many different surroundings is compared in parts, each among those that agree in
   what its windows have in common.
3. The repeated windows go back to their texts.

Texts that occur more than once are repeated as a whole; one of each per input partition is parsed. Defined results:
bytes are UTF-8; a null text is empty; a text shorter than a window keeps all its bytes. Repeated rows each lose what is repeated. An
empty table gives no rows. Only the key is carried, so names cannot clash. The input must give the same rows in the same
order each time it is read. Equality of strings is equality of 64-bit hashes or of the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .stores import stored
from .texts import mix, powers, slices, text_bytes

SIZE = 200
GRAM = 8
REACH = 80
ROW_BITS = 33  # of monotonically_increasing_id, below the partition
BUCKET_TRIGGERS = 1 << 20  # in one group of a task, about
BUCKET_CONTEXTS = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

HOT_TRIGGERS = 20_000  # equal triggers with other surroundings than these are compared in parts
PART_WINDOWS = 10  # windows of a trigger in a part

OPEN, ALL, ALL_SENT = 1, 2, 3  # state of a trigger: to be compared; all windows repeated; the same, and takes part in comparisons
HOT = 16  # added to the state of a trigger that is compared in parts
COPY = 9  # state of a text


class Phrases:
    """Triggers of some texts: place, first and last window start, text number and rank in its text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int = SIZE):
        self.data, self.size = data, size
        self.reach = min(REACH, size - GRAM)
        count = len(data)
        empty = np.zeros(0, np.int64)
        self.place = self.first = self.last = self.text = self.rank = empty
        if count < size:
            return
        grams = np.ndarray((count - GRAM + 1,), "<u8", np.ascontiguousarray(data), strides=(1,))
        bits = np.uint64(32)  # the same for every text, so that ties are the same; of equal hashes the first place counts
        keys = ((mix(grams.astype(np.uint64)) >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
        least, span = keys, 1
        while span * 2 <= self.reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < self.reach:
            least = np.minimum(least[: len(least) - (self.reach - span)], least[self.reach - span :])
        starts = np.arange(min(len(least), count - size + 1))
        text = np.searchsorted(offsets, starts, side="right") - 1
        starts = starts[starts + size <= offsets[text + 1]]
        if not len(starts):
            return
        text = np.searchsorted(offsets, starts, side="right") - 1
        place = (least[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
        self.place, self.text, self.first = place[new], text[new], starts[new]
        self.last = starts[np.append(new[1:], len(starts)) - 1]
        self.rank = np.arange(len(new)) - np.searchsorted(self.text, self.text)

    def prepare(self) -> None:
        values = mix(np.arange(1, 257, dtype=np.uint64))[self.data]
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(_BASE, len(values)), dtype=np.uint64)])
            self.back = powers(_INVERSE, len(values) + 1)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def shared(self) -> np.ndarray:
        """Hash of the bytes after each trigger that all its windows have, whatever their place."""
        return self.hashes(self.place, self.place + self.size - self.reach + 1)

    def covered(self) -> np.ndarray:
        """Hash of the bytes that the windows of each trigger cover together."""
        return self.hashes(self.first, self.last + self.size)


def _steps(x: np.ndarray) -> bytes:
    return np.diff(x, prepend=0).astype("<i4").tobytes()


def _unsteps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i4").astype(np.int64))


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(keys)]):
        yield int(keys[a]), a, b


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


_B = pa.binary()
ENTRIES = "place long, unit long, docs binary, ranks binary, shared binary, covered binary, states binary"
_ENTRY = [x.split()[0] for x in ENTRIES.split(", ")], [pa.int64(), pa.int64(), _B, _B, _B, _B, _B]


def _parse(size: int, buckets: int):
    """Fingerprints of the triggers by bucket; of equal ones in a part of an input partition the first only, marked as several.

    The others are known to be repeated and go straight to their partition (place below 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[tuple] = []
        unit, count = 0, 0

        def flush() -> pa.RecordBatch:
            doc, rank, shared, covered = map(np.concatenate, zip(*held))
            order = np.lexsort((rank, doc, covered, shared))
            same = np.zeros(len(order), bool)
            same[1:] = (shared[order][1:] == shared[order][:-1]) & (covered[order][1:] == covered[order][:-1])
            several = np.zeros(len(order), np.uint8)
            several[:-1] = ~same[:-1] & same[1:]
            state, later = np.empty(len(order), np.uint8), np.empty(len(order), bool)
            state[order], later[order] = several, same
            bucket = (mix(shared) % np.uint64(buckets)).astype(np.int64)
            bucket[later] = -1 - unit
            state[later] = ALL
            order = np.argsort(bucket, kind="stable")
            doc, rank, shared, covered, state, bucket = (x[order] for x in (doc, rank, shared, covered, state, bucket))
            rows = []
            for k, a, b in _runs(bucket):
                prints = (shared[a:b].tobytes(), covered[a:b].tobytes()) if k >= 0 else (b"", b"")
                rows.append((k, unit, _steps(doc[a:b]), _steps(rank[a:b]), *prints, state[a:b].tobytes()))
            return _batch(rows, *_ENTRY)

        for part in slices(batches, "text"):
            rows = part.column("row").to_numpy()
            keep = []
            for i, t in enumerate(part.column("text").cast(_B).to_pylist()):
                if t and len(t) >= size and (own := hashlib.blake2b(t, digest_size=16).digest()) not in seen:
                    seen.add(own)
                    keep.append(i)
            if not keep:
                continue
            unit = int(rows[0]) >> ROW_BITS
            p = Phrases(*text_bytes(part.column("text").take(pa.array(keep))), size)
            p.prepare()
            held.append(((rows[keep] & ((1 << ROW_BITS) - 1))[p.text], p.rank, p.shared(), p.covered()))
            count += len(p.rank)
            if count > 1 << 20:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    return run


def _met(hot: int):
    """The state of the triggers of one bucket, sent back by input partition."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return table.select(_ENTRY[0]) if key[0].as_py() < 0 else _states(table, hot)

    return run


def _states(table: pa.Table, hot: int) -> pa.Table:
    docs = [_unsteps(x.as_py()) for x in table.column("docs")]
    unit = np.repeat(table.column("unit").to_numpy(), list(map(len, docs)))
    doc, rank = np.concatenate(docs), np.concatenate([_unsteps(x.as_py()) for x in table.column("ranks")])
    join = lambda name, kind: np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)
    shared, covered, several = join("shared", np.uint64), join("covered", np.uint64), join("states", np.uint8)
    order = np.lexsort((covered, shared))
    unit, doc, rank, shared, covered, several = (x[order] for x in (unit, doc, rank, shared, covered, several))
    group = np.cumsum(np.r_[True, shared[1:] != shared[:-1]]) - 1
    first = np.r_[True, (covered[1:] != covered[:-1]) | (shared[1:] != shared[:-1])]
    kind = np.cumsum(first) - 1
    number = np.bincount(kind, weights=1 + several)[kind]
    singles = np.bincount(group, weights=number == 1)[group]
    kinds = np.bincount(group, weights=first)[group]
    state = np.where(number > 1, ALL, np.where(kinds > 1, OPEN, 0)).astype(np.uint8)
    state[(number > 1) & first & (singles > 0)] = ALL_SENT
    state[np.isin(state, (OPEN, ALL_SENT)) & (kinds > hot)] += HOT
    keep = state > 0
    unit, doc, rank, state = unit[keep], doc[keep], rank[keep], state[keep]
    order = np.lexsort((rank, doc, unit))
    unit, doc, rank, state = unit[order], doc[order], rank[order], state[order]
    rows = [(0, u, _steps(doc[a:b]), _steps(rank[a:b]), b"", b"", state[a:b].tobytes()) for u, a, b in _runs(unit)]
    return pa.Table.from_batches([_batch(rows, *_ENTRY)])


STATES = "row long, kind int, ranks binary, states binary"
_STATE = [x.split()[0] for x in STATES.split(", ")], [pa.int64(), pa.int32(), _B, _B]


def _gathered(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one input partition: the states of each text's triggers."""
    columns = [table.column(c).to_pylist() for c in ("docs", "ranks", "states")]
    doc, rank = (np.concatenate([_unsteps(x) for x in c]) for c in columns[:2])
    state = np.frombuffer(b"".join(columns[2]), np.uint8)
    order = np.lexsort((rank, doc))
    doc, rank, state = doc[order], rank[order], state[order]
    base = key[0].as_py() << ROW_BITS
    rows = [(base | d, 0, rank[a:b].astype("<u4").tobytes(), state[a:b].tobytes()) for d, a, b in _runs(doc)]
    return pa.Table.from_batches([_batch(rows, *_STATE)])


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for part in slices(batches, "text"):
        texts = [pack(t) if t else b"" for t in part.column("text").cast(_B).to_pylist()]
        yield pa.record_batch([part.column("row"), part.column("key"), pa.array(texts, _B)], ["row", "key", "packed"])


def _plain(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw) if raw else b""


CONTEXTS = "bucket int, rows binary, ranks binary, groups binary, states binary, shortest binary, longest binary, before binary, after binary"
_CONTEXT = [x.split()[0] for x in CONTEXTS.split(", ")], [pa.int32(), *[_B] * 8]


def _contexts(size: int, buckets: int):
    """The bytes around triggers that are to be compared, by what their windows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held)]
            bucket = (mix(columns[2]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            columns, bucket = [x[order] for x in columns], bucket[order]
            return _batch([(k, *[np.ascontiguousarray(x[a:b]).tobytes() for x in columns]) for k, a, b in _runs(bucket)], *_CONTEXT)

        for batch in batches:
            for row, raw, marks in zip(*[batch.column(c).to_pylist() for c in ("row", "packed", "marks")]):
                mark = next((m for m in marks if m["kind"] == 0), None)  # also of a copy, which others may match in part
                state = np.frombuffer(mark["states"], np.uint8) if mark else np.zeros(0, np.uint8)
                hot, state = state >= HOT, state % HOT
                sent = np.flatnonzero((state == OPEN) | (state == ALL_SENT))
                if not len(sent):
                    continue
                rank, state = np.frombuffer(mark["ranks"], "<u4")[sent].astype(np.int64), state[sent]
                data = np.frombuffer(_plain(raw), np.uint8)
                p = Phrases(data, np.array([0, len(data)]), size)
                p.prepare()
                group, place = p.shared()[rank], p.place[rank]
                shortest, longest = place - p.last[rank], place - p.first[rank]
                if hot.any():  # a frequent trigger: in parts, each with what the windows of that part have in common
                    sizes = np.where(hot[sent], longest // PART_WINDOWS - shortest // PART_WINDOWS + 1, 1)
                    of = np.repeat(np.arange(len(rank)), sizes)
                    rank, state, group, place, shortest, longest = (x[of] for x in (rank, state, group, place, shortest, longest))
                    part = shortest // PART_WINDOWS + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    split = hot[sent][of]
                    low, high = part * PART_WINDOWS, np.minimum((part + 1) * PART_WINDOWS, p.reach) - 1
                    own = p.hashes(np.where(split, place - low, 0), np.where(split, place - high + size, 0))
                    with np.errstate(over="ignore"):
                        group = np.where(split, mix(group + own + part.astype(np.uint64)), group)
                    shortest, longest = np.where(split, np.maximum(shortest, low), shortest), np.where(split, np.minimum(longest, high), longest)
                wide = np.concatenate([np.zeros(p.reach, np.uint8), data, np.zeros(size, np.uint8)])
                before = wide[(place + p.reach)[:, None] - 1 - np.arange(p.reach)]
                after = wide[(place + p.reach)[:, None] + np.arange(size)]
                each = len(rank)
                held.append(
                    (
                        np.full(each, row), rank.astype("<u4"), group, state.astype(np.uint8), shortest.astype(np.uint8),
                        longest.astype(np.uint8), before, after,
                    )
                )
                count += each
                if count > 1 << 15:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return run


def _suffix_order(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by group, then bytes; how many bytes each has in common with the one before it, -1 in another group)."""
    width = -(-strings.shape[1] // 8) * 8
    wide = np.zeros((len(strings), width), np.uint8)
    wide[:, : strings.shape[1]] = strings
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*[words[:, i] for i in range(words.shape[1] - 1, -1, -1)], group))
    ordered = strings[order]
    differ = ordered[1:] != ordered[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
    common[group[order][1:] != group[order][:-1]] = -1
    return order, np.append(np.array([-1]), common)


def _combined(size: int):
    """Per trigger of one bucket which of its windows are repeated, by how far before the trigger they start."""

    def run(table: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)
        row, rank, group, state = join("rows", "<i8"), join("ranks", "<u4"), join("groups", np.uint64), join("states", np.uint8)
        shortest, longest = join("shortest", np.uint8), join("longest", np.uint8)
        count = len(row)
        before, after = join("before", np.uint8).reshape(count, -1), join("after", np.uint8).reshape(count, -1)
        left, left_common = _suffix_order(group, before)
        right, right_common = _suffix_order(group, after)
        weight = np.where(state == ALL_SENT, 2, 1)
        mask = np.zeros((count, before.shape[1]), bool)
        a, b = np.empty(count, np.int64), np.empty(count, np.int64)
        for back in range(before.shape[1]):
            some = np.flatnonzero((shortest <= back) & (back <= longest))
            if len(some) < 1:
                continue
            a[left] = np.cumsum(left_common < back)
            b[right] = np.cumsum(right_common < size - back)
            _, place = np.unique(a[some] * np.int64(count + 1) + b[some], return_inverse=True)
            mask[some, back] = np.bincount(place, weights=weight[some])[place] > 1
        keep = np.flatnonzero((state == OPEN) & mask.any(axis=1))
        keep = keep[np.lexsort((rank[keep], row[keep]))]
        bits = np.packbits(mask[keep], axis=1)
        rows = [(r, 1, rank[keep][x:y].tobytes(), bits[x:y].tobytes()) for r, x, y in _runs(row[keep])]
        return pa.Table.from_batches([_batch(rows, *_STATE)])

    return run


def removed_bytes(data: np.ndarray, marks: list[dict], size: int) -> np.ndarray:
    """True for each byte of a text that a repeated window covers."""
    edge = np.zeros(len(data) + 1, np.int64)
    if len(data) >= size:
        if any(m["kind"] == COPY for m in marks):
            return np.ones(len(data), bool)
        p = Phrases(data, np.array([0, len(data)]), size)
        starts = []
        for m in marks:
            rank = np.frombuffer(m["ranks"], "<u4").astype(np.int64)
            if m["kind"] == 0:
                rank = rank[np.frombuffer(m["states"], np.uint8) % HOT >= ALL]
                sizes = p.last[rank] - p.first[rank] + 1
                starts.append(np.repeat(p.first[rank] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()))
            else:
                bits = np.unpackbits(np.frombuffer(m["states"], np.uint8).reshape(len(rank), -1), axis=1)
                which, back = np.nonzero(bits)
                starts.append(p.place[rank[which]] - back)
        starts = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + size, -1)
    return np.cumsum(edge)[:-1] > 0


def _finished(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, starts, stops, kept = [], [], [], []
                for raw, marks in zip(part.column("packed").to_pylist(), part.column("marks").to_pylist()):
                    data = np.frombuffer(_plain(raw), np.uint8)
                    out = removed_bytes(data, marks or [], size)
                    step = np.flatnonzero(np.diff(np.r_[False, out, False]))
                    sizes.append(len(data))
                    starts.append(step[::2].tolist())
                    stops.append(step[1::2].tolist())
                    kept.append(data[~out].tobytes())
                arrays = [pa.array(sizes, pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(stops, pa.list_(pa.int64())), pa.array(kept, _B)]
                yield pa.record_batch([part.column("key"), *arrays], ["key", "n_bytes", "starts", "stops", "kept"])

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, hot: int = HOT_TRIGGERS) -> DataFrame:
    """(key, n_bytes, starts, stops, kept): the removed runs of each text and the bytes that remain."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]
    hashed = stored(rows.select("row", F.length(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("n"), F.unhex(F.md5("text")).alias("hash")))
    total = hashed.agg(F.sum("n")).first()[0] or 0
    several = hashed.where(F.col("n") >= size).groupBy("hash").agg(F.count("*").alias("many")).where("many > 1")
    copies = hashed.join(several, "hash").select("row", F.lit(COPY).alias("kind"), F.lit(b"").alias("ranks"), F.lit(b"").alias("states"))

    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    triggers = 2 * total // REACH
    entries = rows.select("row", "text").mapInArrow(_parse(size, max(least, triggers // BUCKET_TRIGGERS)), ENTRIES)
    back = entries.groupBy("place").applyInArrow(_met(hot), ENTRIES)
    states = stored(back.groupBy("unit").applyInArrow(_gathered, STATES).unionByName(copies))

    packed = f"row long, key {kind}, packed binary"
    marks = lambda x: x.groupBy("row").agg(F.collect_list(F.struct("kind", "ranks", "states")).alias("marks"))
    open_texts = rows.mapInArrow(_compressed, packed).drop("key").join(marks(states), "row")
    contexts = open_texts.mapInArrow(_contexts(size, max(least, triggers // 8 // BUCKET_CONTEXTS)), CONTEXTS)
    found = stored(contexts.groupBy("bucket").applyInArrow(_combined(size), STATES))
    whole = rows.mapInArrow(_compressed, packed).join(marks(states.unionByName(found)), "row", "left")
    out = whole.mapInArrow(_finished(size), f"key {kind}, n_bytes long, starts array<long>, stops array<long>, kept binary")
    return out.withColumnRenamed("key", key)
