import random

from tabloom.llm.token_counts import Automaton, count_tokens, read_pieces, vocabulary_path


def greedy(word, pieces):
    at = n = 0
    longest = max(map(len, pieces))
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return 1
        at += size
        n += 1
    return n


def test_automaton_counts_the_greedy_pieces():
    r = random.Random(3)
    for _ in range(60):
        pieces = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 15))}
        if r.random() < 0.7:
            pieces |= {b"a", b"b", b"c"}
        automaton = Automaton(pieces)
        for _ in range(80):
            word = bytes(r.choice(b"abcd" if r.random() < 0.1 else b"abc") for _ in range(r.randint(1, 20)))
            assert automaton.count(word) == greedy(word, pieces), (word, pieces)


def test_counts_of_texts(frame, spark):
    pieces = set(read_pieces(vocabulary_path()))
    given = [None, "", " \n\t", "Hello world", "naïve café 数学", "x" * 3000, "Hello\nworld  again", "Hello world"]
    got = {r.doc_id: r for r in count_tokens(frame(enumerate(given)), ["doc_id", "n", "__keep"]).collect()}
    for i, t in enumerate(given):
        words = (t or "").encode().split()
        assert got[i].n_words == len(words) and got[i].n_tokens == sum(greedy(b" " + w, pieces) for w in words)
        assert got[i].n == 9 and got[i]["__keep"] == 3
    assert count_tokens(frame([(1, "x")]).limit(0), ["doc_id"]).count() == 0
