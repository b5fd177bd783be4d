"""Count automata against plain dictionaries, collocations against brute force."""

import collections
import random
import re

import numpy as np
import pytest

pytest.importorskip("riftspan.llm")

from odd import DOCUMENTS  # noqa: E402

from riftspan.llm import automata, collocations  # noqa: E402


def random_counts(rng, depth, rows):
    return {tuple(rng.randint(0, 12) for _ in range(depth)): rng.choice([1, 1, 1, 2, 7, 10**12]) for _ in range(rows)}


def built(counts):
    keys = sorted(counts)
    depth = len(keys[0])
    return automata.CountAutomaton.build(np.array(keys).reshape(-1, depth), np.array([counts[k] for k in keys]))


def as_counts(rows, counts):
    keys = [tuple(r) for r in rows.tolist()]
    assert keys == sorted(set(keys))
    return dict(zip(keys, counts.tolist()))


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_automata_hold_counts_unite_and_compose(depth):
    rng = random.Random(depth)
    sets = [random_counts(rng, depth, n) for n in (1, 30, 400)]
    packed = [automata.CountAutomaton.unpacked(built(s).packed()) for s in sets]
    for own, automaton in zip(sets, packed):
        assert as_counts(*automaton.paths()) == own
    total = collections.Counter()
    for own in sets:
        total.update(own)
    assert as_counts(*automata.union(packed)) == total
    asked = {k: 0 for k in [*list(sets[2])[:50], *random_counts(rng, depth, 60)]}
    assert as_counts(*built(asked).composed(packed[2])) == {k: sets[2][k] for k in asked if k in sets[2]}


def test_equal_states_become_one():
    counts = {(a, b, c): 5 + a for a in range(20) for b in range(20) for c in range(20)}
    assert built(counts).arcs() == 60
    none = automata.CountAutomaton.build(np.empty((0, 3), np.int64), np.empty(0, np.int64))
    assert len(none.paths()[0]) == 0 and len(built(counts).composed(none)[0]) == 0


def test_words_round_trip():
    for words in ([], [b""], [b"a", b"", "é漢".encode(), b"x" * 100_000]):
        assert automata.unpack_words(automata.pack_words(words)) == words


def brute(texts, least):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in texts:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {(g, w): a for (g, w), a in f.items() if len(w) > 1 and a >= least}
    out = set()
    for (g, w), a in candidates.items():
        longer = [q for (h, q), b in candidates.items() if h == g and len(q) > len(w) and 100 * b >= 100 * a and any(q[i : i + len(w)] == w for i in range(len(q)))]
        if not longer:
            score, k = min((1000 * a * n[g] // (f[g, w[:k]] * f[g, w[k:]]), k) for k in range(1, len(w)))
            out.add((g, " ".join(w), a, f[g, w[:k]], f[g, w[k:]], n[g], score))
    return out


def some_texts(seed, rows):
    rng = random.Random(seed)
    words = ["a", "An", "the", "é", "x\x01y", "zz", "x", "漢", "i'm", "-"]
    passage = "of this one said that the x x x"
    texts = []
    for _ in range(rows):
        parts = [rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.4:
            parts.append(passage)
        texts.append((rng.choice(["en", "fr", None, "x"]), "".join(parts)))
    return texts + [("en", None), ("en", ""), ("fr", "a x " * 4000), (None, "x" * 20_000)]


def documents(spark, texts):
    return spark.createDataFrame([(1, t, g, *["x"] * 13) for g, t in texts], DOCUMENTS)


@pytest.mark.parametrize("small", [False, True])
def test_collocations_equal_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, messages, ranges and chance hits
        for name, value in {"BLOCK": 300, "HELD": 200, "HELD_WORDS": 8, "SPLIT": 50, "PER_OWNER": 700, "FILTER_BITS": 6}.items():
            monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(collocations, "LEAST_COUNT", 20)
    texts = some_texts(4, 300)
    expected = brute(texts, 20)
    assert any(len(r[1].split()) == 5 for r in expected)
    got = [tuple(r) for r in collocations.collocations(documents(spark, texts).repartition(3)).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_products_beyond_64_bits(spark):
    a = 4_000_000_000_000
    row = spark.range(1).selectExpr(f"{a}L as a", f"{3 * a}L as n", f"{a}L as l", f"{a + 1}L as r")
    text = "(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    assert row.selectExpr(text).first()[0] == 1000 * a * 3 * a // (a * (a + 1))


def test_no_rows(spark):
    assert collocations.collocations(documents(spark, [("en", "x")]).limit(0)).collect() == []
    assert collocations.collocations(documents(spark, [("en", None), (None, " . ")])).collect() == []
