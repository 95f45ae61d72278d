"""Language identification by character models with interpolated Kneser-Ney smoothing.

A text is its runs of letters, lower-cased. Each run is predicted letter by letter, its end included, from the letters
before it. One model per language is fitted on all labelled texts: n-grams of the highest order are counted in the tasks and
summed by Spark; the rest follows from the distinct ones. No n-gram is left out. A small model lies in sorted arrays of n-gram
hashes with one column per language. A larger one stays in tables: the chances of the most frequent n-grams are broadcast,
texts send their other n-grams to a join. The answer is the language of the lowest cross-entropy per symbol. A text whose
cross-entropy is above what the labelled texts of that language have (mean plus so many deviations) is marked as rejected.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected. Ties go to the first
language in alphabetical order. Without any labelled text every answer is ``und``. Repeated rows count as often as they
occur; an empty table gives no rows. Only the columns asked for are carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .stores import stored
from .texts import mix, slices

ORDER = 4
UND = "und"
BROADCAST_CELLS = 4_000_000  # n-grams times languages up to which a model, or the head of a larger one, is broadcast
CALIBRATION_DEVIATIONS = 4.0
CACHE_WORDS = 300_000
SHARPNESS = 8.0  # of the score: how much a nat per symbol counts

_LETTERS = re.compile(r"[^\W\d_]+")
_START, _END = 2, 3
_BITS = 16  # of a symbol in a packed n-gram


def letter_runs(text: str) -> list[str]:
    """Runs of letters; other characters that Unicode counts among those of words, such as fractions, are none."""
    runs = _LETTERS.findall(text.lower())
    if text.isascii() or "".join(runs).isalpha() or not runs:
        return runs
    return [part for run in runs for part in "".join([c if c.isalpha() else " " for c in run]).split()]


def packed_ngrams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram of the highest order per symbol of all words, number of symbols per word); words end with a symbol."""
    pad = chr(_START) * (ORDER - 1)
    joined = "".join([pad + w + chr(_END) for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (codes ^ (codes >> np.uint64(16))) & np.uint64(0xFFFF)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    grams = codes.copy()
    for back in range(1, ORDER):
        grams[back:] |= codes[:-back] << np.uint64(_BITS * back)
    starts = np.cumsum(sizes + ORDER - 1) - sizes
    place = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return grams[place], sizes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, dict[str, int]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            grams, sizes = packed_ngrams(list(counts))
            weight = np.repeat(np.fromiter(counts.values(), np.int64, len(counts)), sizes)
            found, place = np.unique(grams, return_inverse=True)
            total = np.bincount(place, weights=weight).astype(np.int64)
            yield pa.record_batch([pa.array([lang] * len(found)), pa.array(found.view(np.int64)), pa.array(total)], ["lang", "gram", "n"])

    many = 0
    for part in slices(batches, "text"):
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
            counts = held.setdefault(lang, {})
            before = len(counts)
            for w in letter_runs(text or ""):
                counts[w] = counts.get(w, 0) + 1
            many += len(counts) - before
        if many > CACHE_WORDS:
            yield from flush()
            held, many = {}, 0
    yield from flush()


@dataclass
class Model:
    """Per order (1 first): sorted hashes of n-grams with the discounted share per language, and of contexts with what is
    left for the next lower order."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    limits: np.ndarray

    def word_scores(self, words: Sequence[str]) -> np.ndarray:
        """Sum of log probabilities per language, and the number of symbols as the last column."""
        grams, sizes = packed_ngrams(words)
        chance = np.full((len(grams), len(self.languages)), 1.0 / (1 << _BITS))
        for order in range(1, ORDER + 1):
            mask = np.uint64((1 << (_BITS * order)) - 1) if order * _BITS < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
            gram = grams & mask
            context = gram >> np.uint64(_BITS)
            chance = _look(*self.grams[order - 1], mix(gram), 0.0) + _look(*self.contexts[order - 1], mix(context), 1.0) * chance
        starts = np.cumsum(sizes) - sizes
        return np.column_stack([np.add.reduceat(np.log(chance), starts), sizes])


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    out = values[at]
    out[keys[at] != wanted] = missing
    return out


def build_model(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The model from the counts of the highest order (language number, packed n-gram, count)."""
    grams, contexts = [], []
    width = len(languages)
    for order in range(ORDER, 0, -1):
        context = gram >> np.uint64(_BITS)
        kept, left = np.zeros(len(gram)), []
        for k in range(width):
            own = np.flatnonzero(lang == k)
            ones, twos = (n[own] == 1).sum(), (n[own] == 2).sum()
            discount = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
            found, place = np.unique(context[own], return_inverse=True)
            total = np.bincount(place, weights=n[own], minlength=len(found))
            kept[own] = np.maximum(n[own] - discount, 0.0) / np.maximum(total[place], 1)
            taken = np.bincount(place, weights=np.minimum(n[own], discount), minlength=len(found))
            left.append((found, np.full(len(found), k), taken / np.maximum(total, 1)))
        grams.append(_table(gram, lang, kept, width, 0.0))
        contexts.append(_table(*[np.concatenate(x) for x in zip(*left)], width, 1.0) if left else _table(gram[:0], lang[:0], kept[:0], width, 1.0))
        # one order lower, each distinct n-gram counts once for every symbol that comes before it
        mask = np.uint64((1 << (_BITS * (order - 1))) - 1)
        pair = np.unique(np.stack([lang.astype(np.uint64), gram]), axis=1) if len(gram) else np.zeros((2, 0), np.uint64)
        short = np.stack([pair[0], pair[1] & mask])
        found, count = np.unique(short, axis=1, return_counts=True)
        lang, gram, n = found[0].astype(np.int64), found[1], count
    return Model(languages, grams[::-1], contexts[::-1], np.full(width, np.inf))


def _table(keys: np.ndarray, lang: np.ndarray, values: np.ndarray, width: int, missing: float) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(mix(keys), return_inverse=True)
    out = np.full((len(found), width), missing)
    out[place, lang] = values
    return found, out


class Scorer:
    """Scores of words. Two generations of words are kept: when the young one is full it becomes the old one."""

    def __init__(self, model: Model):
        self.model = model
        self.place, self.scores = self._empty()
        self.old = self._empty()

    def _empty(self) -> tuple[dict[str, int], np.ndarray]:
        return {}, np.zeros((1024, len(self.model.languages) + 1))

    def _add(self, words: list[str], scores: np.ndarray) -> None:
        first, stop = len(self.place), len(self.place) + len(words)
        if stop > len(self.scores):
            self.scores = np.concatenate([self.scores[:first], np.zeros((max(stop, 2 * first) - first, self.scores.shape[1]))])
        self.scores[first:stop] = scores
        self.place |= zip(words, range(first, stop))

    def totals(self, runs: list[list[str]]) -> np.ndarray:
        if len(self.place) > CACHE_WORDS:
            self.old, (self.place, self.scores) = (self.place, self.scores), self._empty()
        new = set().union(*runs).difference(self.place)
        known = [w for w in new if w in self.old[0]]
        self._add(known, self.old[1][np.fromiter(map(self.old[0].__getitem__, known), np.int64, len(known))])
        new = list(new.difference(known))
        for at in range(0, len(new), 20_000):
            self._add(new[at : at + 20_000], self.model.word_scores(new[at : at + 20_000]))
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        which = np.fromiter(map(self.place.__getitem__, chain.from_iterable(runs)), np.int64, int(sizes.sum()))
        out = np.zeros((len(runs), self.scores.shape[1]))
        some = np.flatnonzero(sizes)
        if len(some):
            out[some] = np.add.reduceat(self.scores[which], (np.cumsum(sizes) - sizes)[some])
        return out


@dataclass
class Tables:
    """A model too large for one task. Per order (1 first): (key, values) of n-grams and of contexts, as in `Model`."""

    languages: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]
    head: tuple[np.ndarray, np.ndarray]
    limits: np.ndarray

    def chances(self, grams: DataFrame) -> DataFrame:
        """`grams` (gram) with `logs`, the log probability per language."""
        width = len(self.languages)
        out = grams.withColumn("chance", F.array_repeat(F.lit(1.0 / (1 << _BITS)), width))
        for order in range(1, ORDER + 1):
            short = _lower(F.col("gram"), order)
            share = self.grams[order - 1].select(F.col("key").alias("__gram"), F.col("values").alias("__share"))
            left = self.contexts[order - 1].select(F.col("key").alias("__context"), F.col("values").alias("__left"))
            out = out.withColumn("__gram", short).withColumn("__context", F.shiftrightunsigned(short, _BITS))
            out = out.join(share, "__gram", "left").join(left, "__context", "left")
            share, left = (F.coalesce(F.col(c), F.array_repeat(F.lit(x), width)) for c, x in (("__share", 0.0), ("__left", 1.0)))
            backed = F.zip_with(left, "chance", lambda a, b: a * b)
            out = out.select("gram", F.zip_with(share, backed, lambda a, b: a + b).alias("chance"))
        return out.select("gram", F.transform("chance", lambda x: F.log(x)).alias("logs"))


def _lower(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit((1 << (_BITS * order)) - 1))


def build_tables(languages: list[str], counts: DataFrame, cells: int) -> Tables:
    """What `build_model` does, by DataFrame functions, from all counts (lang number, gram, n) of the highest order."""
    width, first = len(languages), counts
    grams, contexts = [], []

    def table(rows: DataFrame, key: str, value: Column, missing: float) -> DataFrame:
        held = F.map_from_entries(F.collect_list(F.struct("lang", value)))
        values = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(missing)))
        return stored(rows.groupBy(F.col(key).alias("key")).agg(held.alias("held")).select("key", values.alias("values")))

    for order in range(ORDER, 0, -1):
        discounts = [0.1] * width
        for k, ones, twos in counts.groupBy("lang").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).collect():
            discounts[k] = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
        discount = F.array(*map(F.lit, discounts))[F.col("lang")]
        level = counts.select("lang", "gram", "n", F.shiftrightunsigned("gram", _BITS).alias("context"), discount.alias("discount"))
        share = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.sum("n").over(Window.partitionBy("lang", "context"))
        grams.append(table(level.withColumn("share", share), "gram", F.col("share"), 0.0))
        left = F.sum(F.least(F.col("n").cast("double"), "discount")) / F.sum("n")
        contexts.append(table(level.groupBy("lang", "context").agg(left.alias("left")), "context", F.col("left"), 1.0))
        # one order lower, each distinct n-gram counts once for every symbol that comes before it
        if order > 1:
            counts = stored(counts.groupBy("lang", _lower(F.col("gram"), order - 1).alias("gram")).agg(F.count("*").alias("n")))
    model = Tables(languages, grams[::-1], contexts[::-1], (np.zeros(0, np.uint64), np.zeros((0, width))), np.full(width, np.inf))
    # the head only saves sending: what it lacks is joined
    often = first.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(cells // width).select("gram")
    found = model.chances(often).toArrow()
    keys = found.column("gram").to_numpy().view(np.uint64)
    logs = found.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, width) if len(keys) else model.head[1]
    order = np.argsort(keys)
    model.head = keys[order], logs[order]
    return model


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", cells: int = BROADCAST_CELLS, limits: bool = True) -> Model | Tables:
    """Fit on every row with a language. `limits` are for rejection; they take a pass of their own, or come with `answer`."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = stored(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())  # a row per language
    if not languages:
        return build_model([], np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    number = (F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1).cast("int")
    counts = counts.select(number.alias("lang"), "gram", "n")
    if counts.select("gram").distinct().count() * len(languages) <= cells:
        found = counts.toArrow()
        own = found.column("lang").to_numpy().astype(np.int64)
        model = build_model(languages, own, found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy())
    else:
        model = build_tables(languages, stored(counts), cells)
    if limits:
        known = rows.select(F.struct("lang").alias("__keep"), F.col("text").alias("__text"))
        _calibrate(model, _entropies(known, model).select("__keep.lang", "entropy"))
    return model


def _calibrate(model: Model | Tables, labelled: DataFrame) -> None:
    """Sets the limits from rows (lang, entropy)."""
    number = F.array_position(F.array(*map(F.lit, model.languages)), F.col("lang")).cast("int")
    own = labelled.where(F.col("entropy").isNotNull() & (number > 0)).select((number - 1).alias("k"), F.get("entropy", number - 1).alias("own"))
    for k, mean, spread in own.groupBy("k").agg(F.avg("own"), F.stddev_pop("own")).collect():  # a row per language
        model.limits[k] = mean + CALIBRATION_DEVIATIONS * max(spread, 0.05)


def _floats(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _sums(model):
    """(__keep, sum of log probabilities per language, number of symbols) with the whole model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for part in slices(batches, "__text"):
            total = scorer.totals([letter_runs(t or "") for t in part.column("__text").to_pylist()])
            yield pa.record_batch([part.column("__keep"), _floats(total[:, :-1]), pa.array(total[:, -1])], ["__keep", "sums", "symbols"])

    return run


def _head_sums(head):
    """As `_sums` over the n-grams of the head, and the distinct other ones of each text with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = head.value
        for part in slices(batches, "__text"):
            sums, symbols, sizes, rest, many = np.zeros((part.num_rows, logs.shape[1])), np.zeros(part.num_rows), [0], [], []
            for i, text in enumerate(part.column("__text").to_pylist()):
                if words := letter_runs(text or ""):
                    found, n = np.unique(packed_ngrams(words)[0], return_counts=True)
                    at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
                    held = keys[at] == found if len(keys) else np.zeros(len(found), bool)
                    sums[i], symbols[i] = n[held] @ logs[at[held]], n.sum()
                    rest.append(found[~held])
                    many.append(n[~held])
                    sizes.append(len(rest[-1]))
                else:
                    sizes.append(0)
            bounds = pa.array(np.cumsum(sizes), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.zeros(0, np.int64), *(y.view(np.int64) for y in x)]))) for x in (rest, many)]
            yield pa.record_batch([part.column("__keep"), _floats(sums), pa.array(symbols), *lists], ["__keep", "sums", "symbols", "rest", "many"])

    return run


def _entropies(rows: DataFrame, model: Model | Tables) -> DataFrame:
    """`rows` (__keep, __text) as (__keep, entropy): cross-entropy per symbol and language; NULL for a text without letters."""
    context = rows.sparkSession.sparkContext
    kind = f"__keep {rows.schema['__keep'].dataType.simpleString()}, sums array<double>, symbols double"
    if isinstance(model, Model):
        out = rows.mapInArrow(_sums(context.broadcast(model)), kind)  # bounded by `cells`
    else:
        held = rows.mapInArrow(_head_sums(context.broadcast(model.head)), f"{kind}, rest array<long>, many array<long>")  # bounded by `cells`
        held = stored(held.withColumn("__row", F.monotonically_increasing_id()))
        asked = held.select("__row", F.explode(F.arrays_zip("rest", "many")).alias("x")).select("__row", "x.rest", "x.many")
        logs = stored(model.chances(asked.select(F.col("rest").alias("gram")).distinct()))
        each = [F.sum(F.col("logs")[k] * F.col("many")) for k in range(len(model.languages))]
        more = asked.join(logs, asked["rest"] == logs["gram"]).groupBy("__row").agg(F.array(*each).alias("more"))
        both = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
        out = held.join(more, "__row", "left").select("__keep", both.alias("sums"), "symbols")
    return out.select("__keep", F.when(F.col("symbols") > 0, F.transform("sums", lambda x: -x / F.col("symbols"))).alias("entropy"))


def _answers(scored: DataFrame, model: Model | Tables) -> DataFrame:
    """Rows (__keep, entropy) as answers."""
    names, limits = (F.array(*map(F.lit, x)) for x in (model.languages, model.limits.tolist()))
    known, low = F.col("entropy").isNotNull(), F.array_min("entropy")
    best = F.array_position(F.col("entropy"), low).cast("int")
    parts = F.aggregate("entropy", F.lit(0.0), lambda seen, x: seen + F.exp((x - low) * -SHARPNESS))
    return scored.select(
        "__keep.*",
        F.when(known, F.element_at(names, best)).otherwise(UND).alias("lang_pred"),
        F.when(known, 1 / parts).otherwise(0.0).alias("score"),
        F.when(known, low > F.element_at(limits, best)).otherwise(True).alias("rejected"),
    )


def identify(docs: DataFrame, model: Model | Tables, keep: Sequence[str | Column], text: str = "text") -> DataFrame:
    """Columns `keep`, `lang_pred`, `score` (share of the best language, 0 to 1) and `rejected`."""
    rows = docs.select(F.struct(*keep).alias("__keep"), F.col(text).cast("string").alias("__text"))
    if not model.languages:
        return rows.select("__keep.*", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    return _answers(_entropies(rows, model), model)


def answer(docs: DataFrame, learnt: Column, keep: Sequence[str | Column], text: str = "text", lang: str = "lang", cells: int = BROADCAST_CELLS) -> DataFrame:
    """As `fit` on the rows of `docs` where `learnt` is true and `identify` on all, but every text is scored once.

    The entropies are stored; the limits are aggregated from those of the learnt rows.
    """
    model = fit(docs.where(learnt), text, lang, cells, limits=False)
    if not model.languages:
        return identify(docs, model, keep, text)
    label = F.when(learnt, F.col(lang).cast("string")).alias("label")
    rows = docs.select(F.struct(F.struct(*keep).alias("kept"), label).alias("__keep"), F.col(text).cast("string").alias("__text"))
    scored = stored(_entropies(rows, model))
    _calibrate(model, scored.select(F.col("__keep.label").alias("lang"), "entropy"))
    return _answers(scored.select(F.col("__keep.kept").alias("__keep"), "entropy"), model)
