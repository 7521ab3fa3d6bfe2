"""Counting phrases in bounded memory, without Spark."""

import collections
import random

import numpy as np

from sluiceway.llm import collocations


def test_containers_are_measured_only_when_they_may_be_too_many(monkeypatch):
    calls, settle = [], collocations.BurstTrie.settle
    monkeypatch.setattr(collocations.BurstTrie, "settle", lambda self: calls.append(1) or settle(self))
    counter = collocations._Counter(collocations.Mining(entries=4000), 1, 2)
    assert list(counter.count("en", b"a b " * 300)) == [] and list(counter.count("en", b"b c " * 300)) == []
    assert not calls
    assert list(counter.count("en", b"c d " * 900)) == [] and calls  # too many by what was added, few by entries


def test_spilled_runs_add_up_to_all_sequences():
    """Whatever bursts and is spilled: words, pairs and triples, each sequence's runs have its count in all."""
    draw, mining = random.Random(5), collocations.Mining(entries=600, burst=8, slots=4, words=2000)
    texts = [[f"w{int(draw.paretovariate(0.7)) % 400}" for _ in range(draw.randrange(200))] for _ in range(40)]
    counter, got, runs = collocations._Counter(mining, 1, 3), collections.Counter(), 0
    for words in texts:
        for run in counter.count("en", " ".join(words).encode()):
            runs += 1
            for row in run.to_pylist():
                got[row["phrase"]] += row["n"]
        # What is left in memory is bounded, whether it has been measured or not.
        assert sum(t.settle() for t in counter.tries.values()) <= mining.entries
    for run in counter.runs(0, forget=True):
        for row in run.to_pylist():
            got[row["phrase"]] += row["n"]
    want = collections.Counter(" ".join(w[i:i + n]) for w in texts for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert runs and got == want + collections.Counter({"": sum(map(len, texts))})


def test_length_of_codes():
    mining = collocations.Mining()
    codes = np.array([0, 1, (1 << 21) - 1, 1 << 21, 5 << 21 | 7, 1 << 42, (1 << 63) - 1], "int64")
    assert collocations._length(codes, mining).tolist() == [0, 1, 1, 2, 2, 3, 3]


def _run_rows(counter, texts):
    out = [b for lang, text in texts for b in counter.count(lang, text)] + list(counter.runs(0, forget=True))
    return [(r["lang"], r["phrase"], r["n"]) for b in out for r in b.to_pylist()]


def test_words_are_handed_out_once_however_often_sequences_spill():
    draw = random.Random(3)
    texts = [("en", " ".join(f"w{draw.randrange(60)}" for _ in range(300)).encode()) for _ in range(40)]
    rows = _run_rows(collocations._Counter(collocations.Mining(entries=400, burst=8, slots=4), 1, 2), texts)
    assert max(collections.Counter(p for _, p, _ in rows if " " in p).values()) > 1
    words = collections.Counter(w for _, t in texts for w in t.decode().split())
    assert sorted((p, n) for _, p, n in rows if p and " " not in p) == sorted(words.items())


def test_counts_of_words_are_bounded_over_many_languages():
    mining = collocations.Mining(words=200)
    counter, got, most = collocations._Counter(mining, 1, 2), collections.Counter(), 0
    texts = [(f"l{k}", f"a{k % 150} b a{k % 150}".encode()) for k in range(1000)]
    for lang, text in texts:
        for b in counter.count(lang, text):
            got.update({(r["lang"], r["phrase"]): r["n"] for r in b.to_pylist()})
        most = max(most, sum(len(t.words) for t in counter.tries.values()))
    got.update({(r["lang"], r["phrase"]): r["n"] for b in counter.runs(0, forget=True) for r in b.to_pylist()})
    assert most <= 9 * mining.words  # what one block adds comes on top
    want = collections.Counter()
    for lang, text in texts:
        a = text.decode().split()[0]
        want.update({(lang, a): 2, (lang, "b"): 1, (lang, f"{a} b"): 1, (lang, f"b {a}"): 1, (lang, ""): 3})
    assert got == want


def test_tokens_are_words_and_ends_of_pieces():
    for data in (b"", b" ", b"\n", b"\n\n a", b"ab c\td\n\x00 \xc3\xa9\n", b"a", b"  a\nb  ", b"\ta \n\t\n b\n"):
        places, is_word, words = collocations._tokens(data)
        assert words.to_pylist() == data.split()
        found = iter(words.to_pylist())
        assert [next(found) if w else b"." for w in is_word] == data.replace(b"\n", b" . ").split()
        assert [data[p:].split(maxsplit=1)[0] if w else data[p:p + 1] for p, w in zip(places, is_word)] == [x if x != b"." else b"\n" for x in data.replace(b"\n", b" . ").split()]


def test_texts_of_a_language_are_split_together():
    """Words are numbered once a block, so short texts must not be blocks of their own; phrases end where texts do."""
    rows = [("en", b"a b"), ("de", b"x y"), ("en", b"c"), ("en", b"z" * 40), ("de", b"q"), ("en", b"d e f g h i"), ("en", b"last")]
    assert list(collocations._together(iter(rows), 16)) == [("en", b"z" * 40), ("en", b"a b\nc\nd e f g h i"), ("de", b"x y\nq"), ("en", b"last")]
    together, apart = collocations._Counter(collocations.Mining(), 1, 3), collocations._Counter(collocations.Mining(), 1, 3)
    assert sorted(_run_rows(together, collocations._together(iter(rows), 1 << 20))) == sorted(_run_rows(apart, rows))
