"""Token ids of a public word-piece BPE vocabulary, with a word cache per Python worker."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

from .texts import _LOWER, text_bytes

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 300_000  # per generation; two generations are held
CHUNK_BYTES = 1 << 20  # of text that is cut into units at once

#: The split pattern of the vocabulary file (fixed).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BLANK, _LETTER, _DIGIT, _SYMBOL, _HIGH = range(5)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[0x80:] = _HIGH


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCache:
    """A dictionary of two generations: when the young one is full it becomes the old one."""

    def __init__(self, limit: int):
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.limit = limit

    def make_room(self) -> None:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}

    def missing(self, words) -> list[bytes]:
        """Those of `words`, none of which is in the young generation, that the old one lacks too; the others move to the young one."""
        out, get, young = [], self.old.get, self.young
        for w in words:
            if (v := get(w)) is None:
                out.append(w)
            else:
                young[w] = v
        return out


@lru_cache(maxsize=4)
def odd_characters(path: str) -> list[tuple[int, int]]:
    """Ranges of code points that may be split or normalised differently here and by the vocabulary's library.

    The installed Unicode tables differ in age. A code point is odd if it is unassigned to Python, or if its normal form,
    its order among marks or the pieces of a word around it differ. They are found once, on the driver; words with such
    characters go to the library.
    """
    import regex
    from tokenizers import Tokenizer

    whole, split = Tokenizer.from_file(path), regex.compile(SPLIT)
    normal, cut = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
    differs = lambda text: lower(text) != normal(text)
    misplaced = lambda c, marks: any(differs(f"x{c}{m}") or differs(f"x{m}{c}") for m in marks)
    first: dict[int, str] = {}  # of each combining class
    for p in range(0x300, 0x20000):
        first.setdefault(unicodedata.combining(chr(p)), chr(p))
    marks = [m for m in first.values() if not misplaced(m, "\u0301\u0323\u0334")]  # others are too new for the library
    odd = np.zeros(0x110001, bool)
    assigned = []
    for p in range(0x110000):
        if unicodedata.category(chr(p)) == "Cn":
            odd[p] = True
        elif not 0xD800 <= p < 0xE000 and not chr(p).isspace():
            assigned.append(p)
    unsplit = lambda text: [text[i:j] for _, (i, j) in cut(text)] != split.findall(text)
    for at in range(0, len(assigned), 4096):
        part = assigned[at : at + 4096]
        for p in part:
            c = chr(p)
            odd[p] = differs(c) or misplaced(c, marks if unicodedata.combining(c) else "\u0301")
        if unsplit(" ".join(f"q{lower(chr(p))}q" for p in part)):
            for p in part:
                odd[p] |= unsplit(f"q{lower(chr(p))}q")
    edges = np.flatnonzero(np.diff(odd.astype(np.int8), prepend=0))
    del whole, normal, cut, assigned
    release_encoders()
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def lower(text: str) -> str:
    """Composed and lower-cased, each character alone, so a capital sigma never becomes the final form."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def units(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes without blanks, start of each unit there and the total, first unit of each text and the total).

    A unit is a blank-separated word of lower-cased text with a byte beyond ASCII, or a piece of another word: a run of
    letters, one digit, a run of symbols or a contraction.
    """
    kind = _KIND[low]
    word = np.zeros(len(low), bool)  # first bytes of words
    solid = kind != _BLANK
    word[1:] = solid[1:] & ~solid[:-1]
    word[:1] = solid[:1]
    edges = offsets[:-1][offsets[:-1] < len(low)]
    word[edges] |= solid[edges]
    start = solid & (kind == _DIGIT)
    start[1:] |= kind[1:] != kind[:-1]
    start &= solid
    # contractions: an apostrophe that begins a run of symbols
    at = np.flatnonzero((low == 39) & (start | word))
    at = at[at + 1 < len(low)]
    at = at[~word[at + 1]]
    after = np.append(low, [0, 0])
    one = at[np.isin(after[at + 1], list(b"stmd"))]
    two = at[np.isin(after[at + 1].astype(np.int32) * 256 + after[at + 2], [a * 256 + b for a, b in (b"re", b"ve", b"ll")])]
    two = two[~word[two + 2]]
    for places, size in ((one, 2), (two, 3)):
        start[places + 1] = False
        behind = places + size
        behind = behind[behind < len(low)]
        start[behind] = solid[behind]
    if (high := kind == _HIGH).any():  # words that stay whole
        firsts = np.flatnonzero(word)
        foreign = np.add.reduceat(high.astype(np.int32), firsts) > 0 if len(firsts) else np.zeros(0, bool)
        of = np.cumsum(word, dtype=np.int32)
        start &= ~np.append(False, foreign)[of]
    start |= word
    return low[solid], np.append(np.flatnonzero(start[solid]), int(solid.sum())), np.searchsorted(np.flatnonzero(start), offsets)


class WordEncoder:
    """Same ids as the tokenizers library without added special tokens, unit by unit.

    The vocabulary lower-cases, drops white space and never joins across it or across the pieces of its split pattern, so
    a text's ids are those of its units one after the other. Units are told apart in bulk; each different one is looked up
    once per chunk. Words with odd characters go to the library, and so do whole texts with special tokens.
    """

    def __init__(self, path: str, odd: list[tuple[int, int]]):
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.load = lambda: Tokenizer.from_file(path)
        self.bare = self.load()  # for units that are normalised and split already
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.bare.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.odd = np.zeros(0x110000, bool)
        for start, stop in odd:
            self.odd[start:stop] = True
        self.special = [t.content.encode() for t in self.bare.get_added_tokens_decoder().values()]
        self.split = regex.compile(SPLIT)
        self.words = WordCache(CACHE_WORDS)

    @cached_property
    def whole(self):
        """The tokenizer as it is, for the few texts and words that need it."""
        return self.load()

    def _by_library(self, text: bytes) -> np.ndarray:
        return np.array(self.whole.encode(text.decode(errors="replace"), add_special_tokens=False).ids, self.kind)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the total); a null text has none."""
        data, offsets = text_bytes(texts)
        low = _LOWER[data]
        ids, counts = [], np.zeros(len(offsets) - 1, np.int64)
        raw = low.tobytes() if any(s in low.tobytes() for s in self.special) else b""
        first = 0
        while first < len(counts):
            if raw and any(s in raw[offsets[first] : offsets[first + 1]] for s in self.special):
                ids.append(self._by_library(data[offsets[first] : offsets[first + 1]].tobytes()))
                counts[first] = len(ids[-1])
                first += 1
                continue
            stop = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
            stop = first + 1 if raw else max(stop, first + 1)
            for a, b in self._chunks(low, int(offsets[first]), int(offsets[stop])):
                got, per_text = self._encode(low[a:b], np.clip(offsets[first : stop + 1], a, b) - a)
                ids.append(got)
                counts[first:stop] += per_text
            first = stop
        return np.concatenate([np.zeros(0, self.kind), *ids]), np.append(0, np.cumsum(counts))

    def _chunks(self, low: np.ndarray, start: int, stop: int):
        """Parts of about CHUNK_BYTES that end behind a blank; only a single long text has more than one."""
        while stop - start > CHUNK_BYTES:
            blanks = np.flatnonzero(_KIND[low[start + CHUNK_BYTES : stop]] == _BLANK)
            cut = start + CHUNK_BYTES + int(blanks[0]) + 1 if len(blanks) else stop
            yield start, cut
            start = cut
        yield start, stop

    def _encode(self, low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text)."""
        solid, starts, bounds = units(low, offsets)
        if len(starts) < 2:
            return np.zeros(0, self.kind), np.zeros(len(offsets) - 1, np.int64)
        cells = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(solid))])
        cells = cells.dictionary_encode()
        different = cells.dictionary.to_pylist()
        self.words.make_room()
        young = self.words.young
        values = list(map(young.get, different))
        lacking = [i for i, v in enumerate(values) if v is None]
        if lacking:
            if new := self.words.missing([different[i] for i in lacking]):
                self._learn(new)
            for i in lacking:
                values[i] = young[different[i]]
        pool = np.frombuffer(b"".join(values), self.kind)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.kind.itemsize
        place = np.cumsum(sizes) - sizes
        which = cells.indices.to_numpy()
        counts = sizes[which]
        behind = np.cumsum(counts)
        ids = pool[np.repeat(place[which] - behind + counts, counts) + np.arange(behind[-1])]
        return ids, np.diff(np.append(0, behind)[bounds])

    def _learn(self, new: list[bytes]) -> None:
        young, odd = self.words.young, self.odd
        pieces = [w for w in new if w.isascii()]
        foreign = [w for w in new if not w.isascii()]
        if any(odd[ord(c)] for c in set(b" ".join(foreign).decode(errors="replace"))):
            strange = [w for w in foreign if any(odd[ord(c)] for c in w.decode(errors="replace"))]
            for w in strange:
                young[w] = self._by_library(w).tobytes()
            foreign = [w for w in foreign if w not in young]
        texts = lower(b"\n".join(foreign).decode(errors="replace")).split("\n") if foreign else []
        cut = [[t.encode()] if t.isalpha() else [p.encode() for p in self.split.findall(t)] for t in texts]
        self._learn_pieces(pieces)
        self._learn_pieces(self.words.missing({p for parts in cut for p in parts}.difference(young)))
        for w, parts in zip(foreign, cut):
            young[w] = young[parts[0]] if len(parts) == 1 else b"".join(map(young.__getitem__, parts))

    def _learn_pieces(self, new: list[bytes]) -> None:
        young = self.words.young
        for at in range(0, len(new), 512):
            some = new[at : at + 512]
            ids = np.array(self.bare.encode(b"\n".join(some).decode(), add_special_tokens=False).ids, self.kind)
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            if len(stops) != len(some):  # cannot be told apart: one by one
                for p in some:
                    young[p] = self._by_library(p).tobytes()
                continue
            raw, start = ids.tobytes(), 0
            for p, stop in zip(some, stops):
                young[p] = raw[start:stop]
                start = stop


def worker_encoder(path: str, odd: list[tuple[int, int]]) -> WordEncoder:
    """One encoder for the life of a Python worker, which Spark uses for many tasks; `odd` are the vocabulary's odd_characters."""
    held = sys.modules.setdefault("_tabloom_worker", types.ModuleType("_tabloom_worker"))
    encoders = held.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = WordEncoder(path, odd)
    return encoders[path]


def release_encoders() -> None:
    """Gives back what an earlier stage's tasks have left in this Python worker."""
    sys.modules.pop("_tabloom_worker", None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)  # of the GNU C library only
    except (AttributeError, OSError):
        pass
