import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tabloom.llm import tokens
from tabloom.llm.packing import END_ID, hilbert_keys, pack
from tabloom.llm.tokens import WordEncoder, odd_characters, vocabulary_path

TEXTS = [
    None, "", "   ", "The quick brown Fox's tail, isn't it?\n\nYes!", "ΟΔΟΣ οδος İstanbul ﬁne é é", "a\x1cb\x1d c", "x<|endoftext|>y <|startoftext|>",
    "日本語のテキスト 123,456", "　wide blank line", "😀 emoji 👩‍👩‍👧", "word " * 9000, "The quick brown Fox's tail, isn't it?\n\nYes!", "'s 't 'LL don'T",
]


def encoder():
    return WordEncoder(vocabulary_path(), odd_characters(vocabulary_path()))


def ids_of(own, texts):
    ids, bounds = own.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_encoder_gives_the_library_ids(monkeypatch):
    whole, own = Tokenizer.from_file(vocabulary_path()), encoder()
    parts = ["'", "'s", "'re", "'ll", "'d", "'v", "'ve", "a", "s", "LL", "É", "—", "½", "1", "23", ".", "!?", " ", "\n", "\u3000", "\x1c", "<|endoftext|>", "<|ENDOFTEXT|>", "word"]
    rng = random.Random(3)
    texts = [*TEXTS[1:], *["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(4000)]]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(own, texts) == want
    for at in (1, 7, 100):  # long texts in parts, and a cache that hardly holds anything
        monkeypatch.setattr(tokens, "CHUNK_BYTES", at)
        own.words.limit = 3
        assert ids_of(own, texts[:600]) == want[:600]
    assert ids_of(own, [None, "", "x", None]) == [[], [], whole.encode("x", add_special_tokens=False).ids, []]
    assert ids_of(own, []) == []


def test_every_code_point_inside_a_word():
    whole, own = Tokenizer.from_file(vocabulary_path()), encoder()
    assert all(own.odd[p] for p in range(0x110000) if unicodedata.category(chr(p)) == "Cn")  # the library's own work
    points = [p for p in range(0x110000) if unicodedata.category(chr(p)) not in ("Cn", "Cs")]
    for at in range(0, len(points), 4096):
        for form in ("a{}b", "{}", "1{}.", "x{}\u0301"):
            texts = [form.format(chr(p)) for p in points[at : at + 4096]]
            text = " ".join(texts)
            if ids_of(own, [text])[0] != whole.encode(text, add_special_tokens=False).ids:
                assert [hex(ord(t[1])) for t, ids in zip(texts, ids_of(own, texts)) if ids != whole.encode(t, add_special_tokens=False).ids] == []
                raise AssertionError(f"differs in context from {at:x} on")


def test_hilbert_walk_moves_one_step_at_a_time():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_pieces_hold_each_id_once(frame):
    whole = Tokenizer.from_file(vocabulary_path())
    rows = [*enumerate(TEXTS), (None, "no key"), (50, "twice"), (50, "twice")]
    got = pack(frame(rows), length=64, with_ids=True).collect()
    want = sorted([*whole.encode(t or "", add_special_tokens=False).ids, END_ID] for _, t in rows)
    line = b"".join(bytes(r.ids) for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)))
    ids, found = np.frombuffer(line, "<u4"), []
    at = 0
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 64 + r.offset == at and r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        if r.start == 0:
            found.append(ids[at : at + r.doc_tokens].tolist())
        at += r.length
    assert sorted(found) == want
    assert pack(frame([(1, "x")]).limit(0)).count() == 0
