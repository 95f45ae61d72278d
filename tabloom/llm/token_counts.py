"""Token counts by greedy longest match in linear time.

A word is cut from the left into the longest pieces of a vocabulary. The automaton is the vocabulary's trie with a failure
link for each node: the node that stands for what is left of its string once the longest pieces are taken off, and how many
pieces that takes. Walking it reads every byte once and adds up those numbers, so the count is known and no piece is ever built.

Words are [^\\x20\\x09-\\x0D]+ and carry one leading space, as the byte vocabulary writes them. Defined results: a null
or empty text has no words and no tokens; a word with a byte that no piece covers counts as one token. Repeated rows
get repeated counts; an empty table gives no rows. Only the columns asked for are carried.
"""

from __future__ import annotations

import base64
import sys
import types
from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .texts import slices

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_WORDS = 500_000
NONE = -1


class Automaton:
    """Nodes are numbers; `step` has the child of (node, byte) under ``node << 8 | byte``."""

    def __init__(self, pieces: Iterable[bytes]):
        self.step: dict[int, int] = {}
        whole = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                child = self.step.get(node << 8 | b)
                if child is None:
                    child = self.step[node << 8 | b] = len(whole)
                    whole.append(False)
                node = child
            whole[node] = node > 0
        self.fail = [NONE] * len(whole)
        self.pops = [0] * len(whole)
        children: dict[int, list[tuple[int, int]]] = {}
        for place, child in self.step.items():
            children.setdefault(place >> 8, []).append((place & 255, child))
        queue = deque([0])
        while queue:  # by depth, so that links of shorter strings are known
            node = queue.popleft()
            for b, child in children.get(node, ()):
                queue.append(child)
                if whole[child]:
                    self.fail[child], self.pops[child] = 0, 1
                    continue
                at, taken = self.fail[node], self.pops[node]
                while at != NONE and (at << 8 | b) not in self.step:
                    taken += self.pops[at]
                    at = self.fail[at]
                if at != NONE:
                    self.fail[child], self.pops[child] = self.step[at << 8 | b], taken

    def count(self, word: bytes) -> int:
        """Number of pieces; 1 if the word cannot be cut."""
        step, fail, pops = self.step, self.fail, self.pops
        node = total = 0
        for b in word:
            child = step.get(node << 8 | b)
            while child is None:
                if fail[node] == NONE or not node:
                    return 1
                total += pops[node]
                node = fail[node]
                child = step.get(node << 8 | b)
            node = child
        while node:
            if fail[node] == NONE:
                return 1
            total += pops[node]
            node = fail[node]
        return total


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_pieces(path: str) -> list[bytes]:
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def worker_automaton(path: str) -> Automaton:
    """One automaton for the life of a Python worker, which Spark uses for many tasks."""
    held = sys.modules.setdefault("_tabloom_worker", types.ModuleType("_tabloom_worker"))
    made = held.__dict__.setdefault("automata", {})
    if path not in made:
        made[path] = Automaton(read_pieces(path))
    return made[path]


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_automaton(path)
        known: dict[bytes, int] = {}
        for part in slices(batches, "__text"):
            if len(known) > CACHE_WORDS:
                known = {}
            words, tokens = [], []
            for text in part.column("__text").cast(pa.binary()).to_pylist():
                found = (text or b"").split()
                counts = list(map(known.get, found))
                if None in counts:
                    for i, n in enumerate(counts):
                        if n is None:
                            w = found[i]
                            if w not in known:
                                known[w] = automaton.count(b" " + w)
                            counts[i] = known[w]
                words.append(len(found))
                tokens.append(sum(counts))
            yield pa.record_batch([part.column("__keep"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["__keep", "__words", "__tokens"])

    return run


def count_tokens(docs: DataFrame, keep: Sequence[str | Column], text: str = "text", path: str | None = None) -> DataFrame:
    """Columns `keep`, `n_words` and `n_tokens`."""
    rows = docs.select(F.struct(*keep).alias("__keep"), F.col(text).cast("string").alias("__text"))
    kind = rows.schema["__keep"].dataType.simpleString()
    out = rows.mapInArrow(_counted(path or vocabulary_path()), f"__keep {kind}, __words long, __tokens long")
    return out.select("__keep.*", F.col("__words").alias("n_words"), F.col("__tokens").alias("n_tokens"))
