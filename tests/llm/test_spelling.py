"""Spelling variants against a brute-force comparison of all words."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("riftspan.llm")

from odd import documents  # noqa: E402

from riftspan.llm import spelling  # noqa: E402


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]


def brute(texts):
    n = collections.Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}
    letters = sorted({c for w in n for c in w})
    near = {w: {v for v in edits(w, letters) if v != w and v in n} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def found(spark, texts, parts=3):
    rows = spelling.spelling_variants(documents(spark, texts).repartition(parts)).collect()
    got = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows]
    assert len(got) == len(set(got))
    return set(got)


def some_texts(rng, rows):
    parts = ["an", "the", "er", "é", "ß", "ti", "on", "re", "×", "x"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 5))) for _ in range(25)]
    for _ in range(100):  # variants of words and of variants
        words.append(rng.choice(list(edits(rng.choice(words), "anteé"))))
    weights = [2.0 ** rng.randint(0, 8) for _ in words]

    def word():
        w = rng.choices(words, weights)[0]
        return w.title() if rng.random() < 0.2 else w

    return [(rng.choice([None, i, i]), " ".join(word() for _ in range(60))) for i in range(rows)]


@pytest.mark.parametrize("block,together", [(8192, 65_536), (8, 65_536), (1, 40)])
def test_variants_equal_brute_force(spark, monkeypatch, block, together):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TOGETHER", together)
    texts = some_texts(random.Random(5), 120) + [(1, None), (2, ""), (3, "ÉtÉ hÉhé " * 5), (4, ("y" * 3_000 + " ") * 3 + ("y" * 3_001 + " ") * 7)]
    expected = brute(texts)
    assert any(r[1] and r[2] != r[1] for r in expected) and any(r[4] > 3 for r in expected)
    assert found(spark, texts) == expected


def test_no_words_and_no_rows(spark):
    assert found(spark, [(1, None), (2, "a b c")]) == set()
    empty = documents(spark).limit(0)
    assert spelling.spelling_variants(empty).collect() == []


def test_every_pair_meets_in_one_block(monkeypatch):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(5, 7))) for _ in range(600)})
    for groups in (2, 6):
        dealt = spelling.deal_letters(np.ones(spelling.PLACES), groups)
        blocks = collections.defaultdict(list)
        for w in words:
            sums = (spelling.letter_counts([w.encode("latin-1")]) @ dealt)[0]
            blocks[tuple(sums)].append((w, -1))
            for g in range(groups):
                if sums[g]:
                    blocks[tuple(sums - np.eye(groups, dtype=int)[g])].append((w, g))
        pairs = []
        for rows in blocks.values():
            own = [w.encode("latin-1") for w, _ in rows]
            for a, b in spelling.near_in_block(own, np.array([s for _, s in rows]), np.zeros(len(rows), int)):
                pairs += [frozenset((rows[i][0], rows[j][0])) for i, j in zip(a, b)]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {frozenset((w, v)) for w in words for v in edits(w, "abcé") if v in set(words) and v != w}
