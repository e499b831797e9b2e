import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tripyard.llm import _graph, _tables, ngram_join

from .texts import LONG_PAIRS, SPACE_WORD, corpus, frame, lower, prose, vocabulary


def shingles(text, k):
    w = SPACE_WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return Counter((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_components_are_those_of_brute_force(spark, k, num, den):
    rows = corpus(5)
    got = ngram_join.jaccard_components(frame(spark, rows), k, num, den)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, k, num, den)


def test_chains_of_near_copies_are_one_component(spark):
    rng, words = random.Random(4), vocabulary(4)
    rows, own = [], prose(rng, words, 150).split()
    for i in range(60):  # each differs from the next by little, from the last by much
        rows.append((i, " ".join(own)))
        own = list(own)
        own[(i * 7) % len(own)] = f"new{i}"
    rng.shuffle(rows)
    want = brute(rows, 3, 9, 10)
    assert len({c for _, _, c in want}) < 10
    assert Counter(tuple(r) for r in ngram_join.jaccard_components(frame(spark, rows), 3, 9, 10).collect()) == want


def test_hub_rounds_lose_no_link_in_groups_without_a_centre(spark):
    rng, words = random.Random(6), vocabulary(6)
    rows = []
    for g in range(6):
        base = prose(rng, words, 100).split()
        for _ in range(30):
            own = list(base)
            for _ in range(rng.randint(2, 7)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows) * 3 + g, " ".join(own)))
    assert Counter(tuple(r) for r in ngram_join.jaccard_components(frame(spark, rows), 3, 4, 5).collect()) == brute(rows, 3, 4, 5)


def test_empty_table(spark):
    assert ngram_join.jaccard_components(frame(spark, [])).collect() == []


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(100)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["component"] for r in _graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_long_words_that_mirror_each_other_are_different(spark):
    rows = [(10 * i + j, f"{word} x y z") for i, pair in enumerate(LONG_PAIRS) for j, word in enumerate(pair)]
    got = ngram_join.jaccard_components(frame(spark, rows), 3, 9, 10)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, 3, 9, 10) and len(brute(rows, 3, 9, 10)) == 6


def test_a_large_family_below_the_threshold_makes_few_pairs(spark):
    """Copies of one text that share most words, but not enough of them: each
    is similar to hardly any other, though all share prefix tokens."""
    rng, words = random.Random(8), vocabulary(8)
    base = prose(rng, words, 110).split()
    rows = []
    for i in range(250):
        own = list(base)
        for at in rng.sample(range(110), 6):
            own[at] = f"own{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 250, 10)]
    join = ngram_join.JaccardJoin(frame(spark, rows), 3, 9, 10)
    pairs = []
    verified = join._verified
    join._verified = lambda p: pairs.append(p.count()) or verified(p)
    assert Counter(tuple(r) for r in join.components().collect()) == brute(rows, 3, 9, 10)
    assert sum(pairs) < 4 * len(rows)


def test_parity_bits_differ_in_no_more_places_than_the_sets(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(200):
        both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in rng.integers(0, 200, 3))
        one, two = (ngram_join._parities(np.concatenate([both, own])) for own in (a, b))
        assert sum(int(x).bit_count() for x in (one ^ two).view(np.uint64)) <= len(a) + len(b)


def test_counts_of_a_run_take_no_copies_of_it(monkeypatch):
    run = 1 << 20
    monkeypatch.setattr(ngram_join, "RUN", run)
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 40, 1 << 16).astype(np.uint64) for _ in range(31)] + [rng.integers(0, 9, 1 << 16).astype(np.uint64)]
    want = Counter()
    for lo in (0, 16):  # the runs
        seen = Counter(np.concatenate(sets[lo:lo + 16]).tolist())
        want.update({t: n for t, n in seen.items() if n >= ngram_join.LOCAL_LEAST})
    monkeypatch.setattr(ngram_join, "_sets", lambda batch, k: iter([(np.array([0]), sets[batch.column("at")[0].as_py()].copy(), np.array([0, 1 << 16]))]))
    batches = (pa.RecordBatch.from_pydict({"doc_id": pa.array([i]), "at": pa.array([i])}) for i in range(32))
    got = Counter()
    tracemalloc.start()
    try:
        for out in ngram_join._profiles(3)(batches):
            for token, n in zip(out.column("token").to_pylist(), out.column("n").to_pylist(), strict=True):
                if token is not None:
                    got[token] += n
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == want and got[0] > 1000
    assert peak < 2 * 8 * run  # the run itself takes 8 bytes a token


def test_a_run_is_no_longer_than_its_bound(monkeypatch):
    monkeypatch.setattr(ngram_join, "RUN", 5)
    texts = ["a b c a b c d", "a b", "x", "a b c", "q r s t u v w x y z a b", "a b", "a b", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    rows = [r for out in ngram_join._profiles(2)(iter([batch] * 3)) for r in out.to_pylist()]
    assert [r["n"] for r in rows if r["token"] is None] == [len(shingles(t, 2)) for t in texts] * 3


def test_repeated_tokens():
    for n in range(1, 40):
        tokens = np.random.default_rng(n).integers(0, 12, n).astype(np.uint64)
        want = {t: c for t, c in Counter(tokens.tolist()).items() if c >= ngram_join.LOCAL_LEAST}
        token, count = ngram_join._repeated(tokens)
        assert dict(zip(token.tolist(), count.tolist(), strict=True)) == want and len(token) == len(want)


@pytest.mark.parametrize("links", [0, 12])
def test_only_rows_of_linked_classes_are_joined(spark, monkeypatch, links):
    monkeypatch.setattr(ngram_join, "ROW_BITS", 128)  # some classes only seem linked
    rng = random.Random(links)
    classes = [bytes([i]) * 16 for i in range(60)]
    lists = [(rng.randrange(20), rng.choice(classes), 5, 1, *[0] * len(ngram_join.MAPS), rng.choice(classes)) for _ in range(300)]
    merged = [(c, classes[i % 3]) for i, c in enumerate(classes[:links])]
    schema = "token long, cls binary, n int, pos int, " + ", ".join(f"{m} long" for m in ngram_join.MAPS) + ", hub binary"
    placed = ngram_join._placed(spark.createDataFrame(lists, schema), spark.createDataFrame(merged, "node binary, component binary"))
    of = dict(merged)
    want = Counter((t, c, of.get(c, c), of.get(c, c) != of.get(h, h)) for t, c, *_, h in lists)
    assert Counter((r.token, bytes(r.cls), bytes(r.component), r.outside) for r in placed.collect()) == want
    marked = ngram_join._maybe_in(spark.createDataFrame(lists, schema), "cls", spark.createDataFrame(merged, "node binary, component binary").select("node"), 128, "linked")
    linked = {bytes(r.cls) for r in marked.where("linked").collect()}
    assert {c for _, c, *_ in lists if c in of} <= linked and (links or not linked) and len(linked) < 30


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    """Whole partitions of texts in a batch fill an executor's memory beside the heap."""
    def sizes(k):
        def rows(batches):
            for b in batches:
                yield pa.RecordBatch.from_pylist([{"doc_id": None, "n": b.nbytes, "cls": None, "token": None}], pa.schema(
                    [("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("token", pa.int64())]))
        return rows

    monkeypatch.setattr(ngram_join, "_profiles", sizes)
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 100000) AS text")
    before = spark.conf.get(_tables.BATCH_BOUND, None)
    try:
        spark.conf.unset(_tables.BATCH_BOUND)
        seen = [r["n"] for r in ngram_join.JaccardJoin(docs, 3, 9, 10).profiles.collect()]
        assert sum(seen) >= 40 * 500_000 and max(seen) <= _tables.BATCH_BYTES + 600_000
        spark.conf.set(_tables.BATCH_BOUND, "4MB")  # the session's own bound stays
        seen = [r["n"] for r in ngram_join.JaccardJoin(docs, 3, 9, 10).profiles.collect()]
        assert max(seen) > _tables.BATCH_BYTES + 600_000 and spark.conf.get(_tables.BATCH_BOUND) == "4MB"
    finally:
        spark.conf.unset(_tables.BATCH_BOUND)
        if before is not None:
            spark.conf.set(_tables.BATCH_BOUND, before)


def test_counts_of_a_run_leave_in_small_batches(monkeypatch):
    texts = [" ".join(f"w{i}" for i in range(200_000))] * 2
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2]), "text": pa.array(texts)})
    out = list(ngram_join._profiles(1)(iter([batch])))
    assert max(map(len, out)) <= 1 << 16
    assert Counter(r["n"] for b in out for r in b.to_pylist() if r["token"] is not None) == {2: 200_000}
