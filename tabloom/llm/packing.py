"""Documents packed into training sequences along a space-filling curve.

A document's tokens are hashed to a vector, the vector is projected to a few dimensions, and the cell it falls in has a
place on the Hilbert curve. Documents are range-sorted by that place and laid end to end; the line is cut every
`length` tokens. So neighbours in a sequence are alike, and only the last sequence is padded.

The ids are written once. Only keys and lengths are sorted; a running sum over them gives each document its place, and
the ids are joined to it.

Defined results: a null or empty text is the single end id. Ties on the curve go by place in the input, so repeated rows
are packed as often as they occur. An empty table gives no rows. Only the key is carried, so names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.order import ordered
from .stores import stored
from .texts import slices
from .tokens import CHUNK_BYTES, odd_characters, vocabulary_path, worker_encoder

END_ID = 2
LENGTH = 4096
BUCKETS = 256  # dimensions of the hashed vectors
AXES = 4  # dimensions after projection
BITS = 10  # of each axis


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below 2**bits."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the excess work of the inverse walk, from the highest bit down
        low = bit - 1
        for i in range(axes):
            turned = (x[:, i] & bit) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] = np.where(turned, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, i] ^= swap
        bit >>= 1
    for i in range(1, axes):  # Gray code
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[:, axes - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def projection(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, AXES)) / np.sqrt(BUCKETS)


def _encoded(path: str, odd: list[tuple[int, int]]):
    axes = [f"x{i}" for i in range(AXES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, matrix = worker_encoder(path, odd), projection()
        bucket = (np.arange(len(encoder.ends), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.int64) % BUCKETS
        for part in slices(batches, "text", CHUNK_BYTES):
            ids, bounds = encoder.encode(part.column("text"))
            rows, counts = part.num_rows, np.diff(bounds)
            of = np.repeat(np.arange(rows), counts)
            line = np.full(len(ids) + rows, END_ID, encoder.kind)  # each text's ids, then the end id
            line[np.arange(len(ids)) + of] = ids
            vectors = np.bincount(of * BUCKETS + bucket[ids], minlength=rows * BUCKETS).reshape(rows, BUCKETS)
            vectors[:, bucket[END_ID]] += 1
            vectors = np.sqrt(vectors)
            places = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ matrix
            stops = (bounds + np.arange(rows + 1)) * encoder.kind.itemsize
            raw = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(line)])
            yield pa.record_batch(
                [part.column("row"), part.column("key"), pa.array(counts + 1), *map(pa.array, places.T), raw],
                ["row", "key", "n", *axes, "ids"],
            )

    return run


def _placed(center: list[float], spread: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(f"x{i}").to_numpy() for i in range(AXES)])
            share = 1 / (1 + np.exp(-1.7 * (x - center) / spread))  # about the normal distribution function
            cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.record_batch([b.column("row"), b.column("n"), pa.array(hilbert_keys(cells, BITS))], ["row", "n", "place"])

    return run


def _cut(length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, n, first, raw in zip(*[b.column(c).to_pylist() for c in ("key", "n", "first", "ids")]):
                ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                at = 0
                while at < n:
                    sequence, offset = divmod(first + at, length)
                    size = min(length - offset, n - at)
                    piece = ids[at : at + size].tobytes()
                    rows.append((key, at, size, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None))
                    at += size
            for at in range(0, len(rows), 2000):
                columns = list(zip(*rows[at : at + 2000]))
                arrays = [pa.array(columns[0], b.schema.field("key").type), *[pa.array(c, pa.int64()) for c in columns[1:7]], pa.array(columns[7], pa.binary())]
                yield pa.record_batch(arrays, ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids).

    `ids` are the piece's ids as little-endian unsigned 32-bit integers, null unless `with_ids`.
    """
    path = path or vocabulary_path()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]
    axes = [f"x{i}" for i in range(AXES)]
    schema = f"row long, key {kind}, n long, {', '.join(f'{a} double' for a in axes)}, ids binary"
    done = stored(rows.mapInArrow(_encoded(path, odd_characters(path)), schema))
    found = done.agg(*[f(a) for a in axes for f in (F.avg, F.stddev_pop)], F.count("*")).first()
    center = [found[2 * i] or 0.0 for i in range(AXES)]
    spread = [found[2 * i + 1] or 1.0 for i in range(AXES)]
    light = done.select("row", "n", *axes).mapInArrow(_placed(center, spread), "row long, n long, place long")
    line = ordered(light, ["place", "row"], sums={"stop": "n"}).df
    first = line.select("row", (F.col("stop").cast("long") - F.col("n")).alias("first"))
    out = "key {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary".format(kind)
    pieces = done.select("row", "key", "n", "ids").join(first, "row").select("key", "n", "first", "ids")
    return pieces.mapInArrow(_cut(length, with_ids), out).withColumnRenamed("key", key)
