import random
from collections import Counter, defaultdict

import numpy as np
from tripyard.llm import line_dedup
from tripyard.llm.line_dedup import CuckooFilter, LineIndex

from .texts import corpus, frame, lower

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, index_rows=None, min_chars=40, min_docs=5):
    held = defaultdict(set)
    order = lambda i: -(1 << 63) if i is None else i
    key = lambda line: lower(line.strip(SPACE))
    for i, t in rows if index_rows is None else index_rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(order(i))
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == order(i)]
        out[(i, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def as_found(df):
    return Counter(tuple(r) for r in df.collect())


def test_rewriting_is_that_of_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    assert sum(n for _, _, n, _ in want) > 0
    assert as_found(line_dedup.dedup_lines(frame(spark, rows))) == want


def test_exact_join_beyond_the_filter_bound(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    assert as_found(line_dedup.dedup_lines(frame(spark, rows))) == brute(rows)


def test_inserts_and_deletes_are_reversible(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)  # several shards
    rows = corpus(3)
    a, b = rows[:50], rows[50:]
    b = [r for r in b if r[0] not in {i for i, _ in a}]
    first = LineIndex.empty(spark).insert(frame(spark, a))
    both = first.insert(frame(spark, b))
    state = lambda x: (as_found(x.postings), as_found(x.refs))
    assert state(both) == state(LineIndex.empty(spark).insert(frame(spark, a + b)))
    assert as_found(both.rewrite(frame(spark, a + b))) == brute(a + b)
    back = both.delete(frame(spark, b))
    assert state(back) == state(first)
    assert as_found(back.rewrite(frame(spark, a))) == brute(a)
    again = back.insert(frame(spark, b)).insert(frame(spark, b))  # the same documents twice count once
    assert state(again) == state(both)
    hot = {(r["k1"], r["k2"]) for r in again.refs.where("refs >= 5").collect()}
    assert sum(r["n"] for r in again.filters.collect()) == len(hot)


def test_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_a_line_in_a_third_of_all_rows(spark):
    rows = [(i, ("the one line that very many documents have in common\n" if i % 3 == 0 else "") + f"own {i}") for i in range(2000)]
    assert as_found(line_dedup.dedup_lines(frame(spark, rows, 8))) == brute(rows)


def test_cuckoo_filter_holds_deletes_and_rarely_errs():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), 1 << 63, (20_000, 2))
    one = CuckooFilter.holding(keys[:, 0], keys[:, 1])
    assert one.may_hold(keys[:, 0], keys[:, 1]).all()
    others = rng.integers(-(1 << 63), 1 << 63, (20_000, 2))
    assert one.may_hold(others[:, 0], others[:, 1]).mean() < 0.002
    gone = random.Random(1).sample(range(20_000), 10_000)
    assert all(one.delete(*keys[i].tolist()) for i in gone)
    left = np.setdiff1d(np.arange(20_000), gone)
    assert one.may_hold(keys[left, 0], keys[left, 1]).all()
    assert one.may_hold(keys[gone, 0], keys[gone, 1]).mean() < 0.002
    assert (CuckooFilter.from_bytes(one.to_bytes()).table == one.table).all()
