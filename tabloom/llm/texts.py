"""Byte-level text work with numpy, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # texts are handled in slices of about this size, so memory follows the longest text, not the batch

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets); a null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part has about `limit` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        part = offsets[1:] // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(max(count, 1), np.uint64)
    done = 1
    with np.errstate(over="ignore"):
        step = np.uint64(base)
        while done < count:
            out[done : 2 * done] = out[: min(done, count - done)] * step
            done *= 2
            step = step * step
    return out


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, first word of each text and the total) for words [^\\x20\\x09-\\x0D]+, or of the bytes not in `between`; words end with their text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~between[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    first[bounds] |= inside[1:-1][bounds]
    last[bounds - 1] |= inside[1:-1][bounds - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool = True, between: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, A-Z lower-cased if asked for."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = stops - starts
    values = (_LOWER if lower else np.arange(256, dtype=np.uint8))[data].astype(np.uint64) + np.uint64(1)
    values[between[data]] = 0
    values = values[starts[0] :]
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.append(starts[1:], len(data)) - starts)
    with np.errstate(over="ignore"):
        values *= powers(0x9E3779B97F4A7C15, int(place.max()) + 1)[place]
        return mix(np.add.reduceat(values, starts - starts[0]) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its `width`-word shingles; a shorter text is one shingle, an empty one none."""
    n = len(hashes)
    factors = powers(0xC2B2AE3D27D4EB4F, width + 1)[1:]
    with np.errstate(over="ignore"):
        whole = np.zeros(max(n - width + 1, 0), np.uint64)
        for j in range(width):
            whole += hashes[j : n - width + 1 + j] * factors[j] if n >= width else np.zeros(0, np.uint64)
        whole = mix(whole)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                out.append(np.unique(whole[a : b - width + 1]))
            elif b > a:
                part = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(mix(np.array([part], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    data, offsets = text_bytes(texts)
    starts, stops, bounds = words(data, offsets)
    return shingles(word_hashes(data, starts, stops), bounds, width)
