import random

import numpy as np
import pytest

from tabloom.llm import language as la

WORDS = {"aa": "lorem ipsum dolor sit amet consectetur".split(), "bb": "zwei drei vier fünf sechs sieben acht".split(), "cc": "один два три четыре пять шесть".split()}


def text(r, lang, n=30):
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(frame):
    r = random.Random(1)
    rows = [(i, text(r, lang), lang) for i, lang in enumerate(list(WORDS) * 15)] + [(900, None, "aa"), (901, "", "bb"), (902, "12 34", "aa"), (903, "noise", None)]
    return la.fit(frame(rows))


def test_held_out_texts_and_odd_ones(frame, model):
    r = random.Random(2)
    rows = [(i, text(r, lang, 8), lang) for i, lang in enumerate(list(WORDS) * 5)]
    odd = [(100, None), (101, ""), (102, "123 !? 45"), (103, "qqq xxx jjj kkk"), (104, text(r, "aa", 20_000))]
    got = {x.doc_id: x for x in la.identify(frame(rows + odd), model, ["doc_id", "lang", "__keep"]).collect()}
    assert all(got[i].lang_pred == lang and not got[i].rejected and 0.5 < got[i].score <= 1 for i, _, lang in rows)
    assert all(got[i].lang_pred == la.UND and got[i].score == 0 and got[i].rejected for i in (100, 101, 102))
    assert got[103].rejected and got[103].lang_pred in WORDS and got[104].lang_pred == "aa"
    assert la.identify(frame(rows).limit(0), model, ["doc_id"]).count() == 0


def test_chances_sum_to_one(model):
    symbols = sorted({c for words in WORDS.values() for w in words for c in w})
    rest = (1 << 16) - len(symbols) - 1  # symbols that no language has, each as likely as any other of them
    for start in ("", "l", "lo", "lore", "zw", "q"):
        at = len(start)
        chances = [np.exp(_steps(model, start + c)[at]) for c in [*symbols, "", "\u0298"]]
        assert np.allclose(sum(chances[:-1]) + rest * chances[-1], 1.0)
        assert np.allclose(model.word_scores([start])[0, :-1], _steps(model, start).sum(axis=0))


def _steps(model, word):
    """Log chance of each symbol of a word, end included."""
    grams, _ = la.packed_ngrams([word])
    chance = np.full((len(grams), len(model.languages)), 1.0 / (1 << 16))
    for order in range(1, la.ORDER + 1):
        mask = np.uint64((1 << (16 * order)) - 1) if order < 4 else np.uint64(2**64 - 1)
        gram = grams & mask
        chance = la._look(*model.grams[order - 1], la.mix(gram), 0.0) + la._look(*model.contexts[order - 1], la.mix(gram >> np.uint64(16)), 1.0) * chance
    return np.log(chance)


def test_counts_of_all_rows_and_no_labels(frame):
    r = random.Random(3)
    rows = [(i, text(r, "aa"), "aa") for i in range(5)]
    one, two = la.fit(frame(rows)), la.fit(frame(rows * 2))
    assert np.array_equal(one.grams[3][0], two.grams[3][0])
    none = la.fit(frame([(1, "abc", None)]))
    assert [x.lang_pred for x in la.identify(frame([(1, "abc")]), none, ["doc_id"]).collect()] == [la.UND]


def test_a_model_in_tables_equals_one_in_arrays(frame, model):
    r = random.Random(1)
    rows = [(i, text(r, lang), lang) for i, lang in enumerate(list(WORDS) * 15)] + [(900, None, "aa"), (901, "", "bb"), (902, "12 34", "aa"), (903, "noise", None)]
    asked = frame(rows + [(950, "qqq xxx jjj lorem"), (951, "один zwei lorem und mehr"), (952, "b" * 70_000)])
    want = {x.doc_id: x for x in la.identify(asked, model, ["doc_id", "__keep"]).collect()}
    for cells in (0, 30):
        large = la.fit(frame(rows), cells=cells)
        assert isinstance(large, la.Tables) and len(large.head[0]) == cells // 3 and np.allclose(large.limits, model.limits)
        got = {x.doc_id: x for x in la.identify(asked, large, ["doc_id", "__keep"]).collect()}
        assert got.keys() == want.keys()
        for i, x in want.items():
            assert got[i].lang_pred == x.lang_pred and got[i].rejected == x.rejected and got[i].score == pytest.approx(x.score, abs=1e-9)


def test_no_ngram_is_dropped(frame):
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(26_000)]
    rows = [(i, " ".join(words[i::40]), "aa") for i in range(40)]
    model = la.fit(frame(rows))
    assert len(model.grams[3][0]) == len(np.unique(la.packed_ngrams(words)[0])) > 100_000


def test_every_language_has_a_limit(frame):
    r = random.Random(5)
    rows = [(i, f"{text(r, 'aa')} {i}", "aa") for i in range(2_200)] + [(5000 + i, text(r, "bb"), "bb") for i in range(2)]
    assert np.isfinite(la.fit(frame(rows)).limits).all()


def test_numbers_are_no_letters(frame, model):
    assert la.letter_runs("a½b ² Ⅷ x① Über") == ["a", "b", "x", "über"]
    got = {x.doc_id: x for x in la.identify(frame([(1, "½ ² Ⅷ ①"), (2, "½ lorem ipsum")]), model, ["doc_id"]).collect()}
    assert (got[1].lang_pred, got[1].score, got[1].rejected) == (la.UND, 0.0, True) and got[2].lang_pred == "aa"


def test_answer_equals_fit_and_identify(frame):
    r = random.Random(7)
    rows = [(i, text(r, lang, 5), lang) for i, lang in enumerate(list(WORDS) * 15)] + [(900, None, "aa"), (901, "½", "bb"), (902, "qqq jjj", None), (None, "zwei", None)]
    docs = frame(rows)
    learnt = la.F.col("doc_id") % 2 == 0
    want = la.identify(docs, la.fit(docs.where(learnt)), ["doc_id", "__keep"]).collect()
    got = la.answer(docs, learnt, ["doc_id", "__keep"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == len(rows)
    assert la.answer(docs.limit(0), learnt, ["doc_id"]).collect() == []


def kneser_ney(words):
    """Chance of a symbol after a context (tuples of symbols), straight from the definition, for one language."""
    from collections import Counter

    counts = {la.ORDER: Counter(tuple((["<"] * 3 + list(w) + [">"])[i - 3 : i + 1]) for w in words for i in range(3, len(w) + 4))}
    for order in range(la.ORDER - 1, 0, -1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    discount = {}
    for order, c in counts.items():
        ones, twos = (sum(v == k for v in c.values()) for k in (1, 2))
        discount[order] = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)

    def chance(gram):
        order = len(gram)
        if not order:
            return 1.0 / (1 << 16)
        after = {g: v for g, v in counts[order].items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return chance(gram[1:])
        d = discount[order]
        return max(counts[order][gram] - d, 0) / total + sum(min(v, d) for v in after.values()) / total * chance(gram[1:])

    return chance


def test_scores_equal_kneser_ney_in_plain_python(frame):
    words = {lang: [w for i in range(4) for w in ws[: 3 + i]] for lang, ws in WORDS.items()}
    model = la.fit(frame([(i, " ".join(ws), lang) for i, (lang, ws) in enumerate(words.items())]))
    for k, lang in enumerate(model.languages):
        chance = kneser_ney(words[lang])
        for w in ("lorem", "dolores", "zwei", "шесть", "q", "vierzig"):
            line = ["<"] * 3 + list(w) + [">"]
            want = sum(np.log(chance(tuple(line[i - 3 : i + 1]))) for i in range(3, len(line)))
            assert model.word_scores([w])[0, k] == pytest.approx(want, rel=1e-12), (lang, w)
