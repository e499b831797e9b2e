import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from tripyard.llm import periodic_runs

from .texts import SPACE_WORD, corpus, frame


def brute(words, least=6, power=4):
    """Maximal stretches of equal words q apart, for every q; of equal
    stretches the smallest period."""
    best, n = {}, len(words)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, power * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in best.items()), key=lambda r: (r[0], r[2]))


def expected(doc, text):
    words = SPACE_WORD.findall(text or "")
    n = len(words)
    if doc is not None and n and (h := crc32(str(doc).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(runs), *longest, 1000 * longest[1] // longest[2] if runs else None,
            sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def sample(rng):
    k = rng.randint(1, 4)
    ids = [rng.randrange(k) for _ in range(rng.randint(0, 50))]
    root = [rng.randrange(k) for _ in range(rng.randint(1, 6))]
    return ids[:len(ids) // 2] + (root * 20)[:rng.randint(0, 40)] + ids[len(ids) // 2:]


@pytest.mark.parametrize(("least", "power"), [(6, 4), (2, 2), (9, 3)])
def test_runs_of_random_words(least, power):
    rng = random.Random(least)
    for _ in range(400):
        ids = sample(rng)
        assert periodic_runs.word_runs(ids, least, power) == brute(ids, least, power)
        if len(ids) > 1:
            own = np.unique(ids, return_inverse=True)[1].tolist()
            assert sorted(periodic_runs.runs_of(own, least, power)) == sorted(brute(ids, least, power))


def test_runs_of_fibonacci_words_and_of_long_texts():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic_runs.word_runs(b, 2, 2) == brute(b, 2, 2)
    assert periodic_runs.word_runs([5] * 30_000) == [(0, 30_000, 1)]
    assert periodic_runs.word_runs(list(range(30_000)) * 4) == [(0, 120_000, 30_000)]


def test_common_extensions_and_lyndon_words():
    rng = random.Random(2)
    for _ in range(30):
        ids = [rng.randrange(2) for _ in range(rng.randint(2, 80))]
        n = len(ids)
        tree = periodic_runs.SuffixTree(ids)
        common = periodic_runs.Extensions(tree)
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
        got = common.of(*(np.array(x) for x in zip(*pairs, strict=True)))
        for (i, j), length in zip(pairs, got.tolist(), strict=True):
            assert ids[i:i + length] == ids[j:j + length] and (j + length == n or ids[i + length] != ids[j + length])
        for sign in (1, -1):
            order = sorted(range(n + 1), key=lambda i: [sign * x for x in ids[i:]])
            assert tree.leaves(sign < 0) == order
            lengths = periodic_runs._lyndon_lengths(order, n).tolist()
            is_lyndon = lambda w: all(w < w[i:] for i in range(1, len(w)))
            signed = [sign * x for x in ids]
            assert lengths == [max(e - i for e in range(i + 1, n + 1) if is_lyndon(signed[i:e])) for i in range(n)]


def test_stretches_hold_all_runs_when_cutting_ends_early(monkeypatch):
    monkeypatch.setattr(periodic_runs, "ROUNDS", 1)
    rng = random.Random(9)
    for _ in range(100):
        ids = sample(rng) + [9] + sample(rng)
        assert periodic_runs.word_runs(ids) == brute(ids)


def test_rows_are_those_of_brute_force(spark):
    rng = random.Random(3)
    rows = [(doc, text and text[:10_000]) for doc, text in corpus(4)]  # brute force is quadratic
    rows += [(1000 + i, " ".join("abcd"[x] for x in sample(rng))) for i in range(60)]
    rows += [(2000, "A a " * 9), (2001, "x\x85y " * 7 + " z"), (2002, "\t".join("äöü"[i % 3] for i in range(25))), (None, "la " * 8)]
    got = periodic_runs.digest(periodic_runs.periodic_runs(frame(spark, rows), control=True))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    full = periodic_runs.periodic_runs(frame(spark, [(1, "go la la la la la la la on")])).first()
    assert (full["starts"], full["lengths"], full["periods"], full["collapsed"]) == ([1], [7], [1], "go la on")


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(frame(spark, [])).collect() == []
