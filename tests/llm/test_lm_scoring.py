import zlib
from collections import Counter
from math import exp, log, log10

import numpy as np
import pytest

from tripyard.llm import lm_scoring as lm

from .texts import LONG_PAIRS, SPACE_WORD, corpus, frame, lower


def tokens(text):
    return SPACE_WORD.findall(lower(text or ""))


def counts_of(rows):
    training = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in training for w in tokens(t))
    return c, len(training)


def brute(rows):
    c, ends = counts_of(rows)
    n, v = sum(c.values()) + ends, len(c) + (1 if ends else 0)
    base = lambda k: log10((k + 0.1) / (n + 0.1 * (v + 1)))
    sp = lm._processor(lm.VOCABULARY)
    pieces = np.zeros(sp.vocab_size())
    for w, k in c.items():
        for i in sp.encode(w):
            pieces[i] += k
    lattice = lm.Lattice(lm.VOCABULARY, pieces, ends)
    own = {}
    out = []
    for i, t in rows:
        ws = tokens(t)
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        score = sum(own.setdefault(w, lattice.word(w)) for w in ws) + lattice.end
        out.append((i, held, len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n, sum(base(c[w]) for w in ws) + base(ends), score / log(10)))
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in (r[0], r[2], round(r[5], 4)))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("head", [lm.HEAD, 7, 0])
def test_scores_are_those_of_brute_force_with_and_without_a_head(spark, head):
    rows = corpus(3, 25)
    same(lm.scores(frame(spark, rows), head=head).collect(), brute(rows))


def test_flushes_lose_no_count(spark, monkeypatch):
    rows = corpus(4, 30)
    words = lm.word_counts(frame(spark, rows).selectExpr("coalesce(text, '') AS text", "true AS training"))
    want = Counter(w for _, t in rows for w in tokens(t))
    assert {bytes(r["word"]).decode(): r["c"] for r in words.collect()} == want


def test_the_marginal_is_the_sum_over_all_segmentations():
    sp = lm._processor(lm.VOCABULARY)
    lattice = lm.Lattice(lm.VOCABULARY, np.random.default_rng(1).integers(0, 50, sp.vocab_size()).astype(float), 10)

    def every(text):
        if not text:
            return 1.0
        total = sum(exp(lattice.pieces[text[:k]]) * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in lattice.pieces)
        if text[0] not in lattice.pieces:
            total += exp(sum(lattice.bytes[b] for b in text[0].encode())) * every(text[1:])
        return total

    for word in ("the", "thinking", "été", "中文", "a\U0001F600b", "x"):
        assert lattice.word(word) == pytest.approx(log(every(lm.MARK + word)), rel=1e-9)


def test_probabilities_are_a_distribution():
    sp = lm._processor(lm.VOCABULARY)
    lattice = lm.Lattice(lm.VOCABULARY, np.random.default_rng(1).integers(0, 50, sp.vocab_size()).astype(float), 10)
    held = sum(map(exp, lattice.pieces.values())) + sum(map(exp, lattice.bytes.values())) + exp(lattice.end)
    assert 0.999 < held <= 1  # the rest belongs to control pieces


def test_empty_table(spark):
    assert lm.scores(frame(spark, [])).collect() == []


def test_long_words_that_mirror_each_other_are_different(spark):
    training, held = (next(i for i in range(1000) if (zlib.crc32(str(i).encode()) % 10 == 0) == own) for own in (False, True))
    rows = [(training, " ".join(pair[0] for pair in LONG_PAIRS) + " x"), (held, " ".join(pair[1] for pair in LONG_PAIRS) + " x")]
    got = lm.scores(frame(spark, rows)).collect()
    same(got, brute(rows))
    assert {r["doc_id"]: r["n_known"] for r in got} == {training: 5, held: 2}
