import random
from collections import Counter

from tripyard.llm import decontamination as dc

from .texts import ALNUM_WORD, LONG_PAIRS, corpus, frame, lower, prose, vocabulary


def words(text):
    return ALNUM_WORD.findall(lower(text or ""))


def brute(rows, items, size=10):
    windows = [(str(i) if i is not None else "", w[k:k + size]) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - size + 1))]
    out = Counter()
    for doc, text in rows:
        w, hit, own = words(text), set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k:k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    own.add(item)
        out[(doc, len(w), len(hit), tuple(sorted(own)))] += 1
    return out


def as_found(df):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect())


def case():
    rng, vocab = random.Random(8), vocabulary(8, 120)
    items = [(i, prose(rng, vocab, rng.randint(10, 40))) for i in range(12)]
    items += [(20, "short item"), (21, "Zebra"), (22, ""), (23, None), (24, "?!"), (20, "short item"), (None, prose(rng, vocab, 15)),
              (25, "a b " * 20), (26, "été 中文 ß"), (27, items[0][1].upper())]
    rows = [(i, t if len(t or "") < 5000 else t[:5000]) for i, t in corpus(9, 30)]
    for i in range(40):
        own = prose(rng, vocab, rng.randint(5, 80)).split()
        passage = words(rng.choice(items)[1])
        cut = passage[rng.randint(0, 3):][:rng.randint(5, 30)]
        at = rng.randint(0, len(own))
        rows.append((1000 + i, " ".join(own[:at]) + " " + " - ".join(cut).title() + " " + " ".join(own[at:])))
    rows += [(2000, "a b " * 30), (2001, "x short item y zebra"), (2002, "été, 中文 ß!"), (2003, items[0][1] + " " + items[0][1])]
    return rows, items


def test_hits_are_those_of_brute_force(spark):
    rows, items = case()
    got = as_found(dc.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")))
    want = brute(rows, items)
    assert got == want and sum(1 for k in want if k[2]) > 20


def test_many_terms_are_indexed_whole(spark, monkeypatch):
    monkeypatch.setattr(dc, "TERMS", 5)
    rows, items = case()
    assert as_found(dc.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))) == brute(rows, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    assert dc.contamination(frame(spark, []), items).collect() == []
    got = dc.contamination(frame(spark, [(1, "a b c"), (2, None)]), items.limit(0))
    assert as_found(got) == Counter({(1, 3, 0, ()): 1, (2, 0, 0, ()): 1})


def test_proximity(spark):
    rows = [(1, "red x x green blue"), (2, "blue green red"), (3, "red x x x x x green blue"), (4, "red green"), (5, "green blue blue x red green")]
    docs = frame(spark, rows)
    asked = dc.windows_of(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"), window=3)
    queries = asked.selectExpr("window_id AS query", "terms")
    index = dc.PositionalIndex(dc.indexed(docs, queries.selectExpr("explode(terms) AS term", "1 AS need")))
    found = index.proximity(queries, 5).join(index.documents, "row")
    assert {r["doc_id"]: r["starts"] for r in found.collect()} == {1: [0], 2: [0], 5: [0, 1, 2]}


def test_long_words_that_mirror_each_other_are_different(spark):
    items = [(i, pair[0]) for i, pair in enumerate(LONG_PAIRS)]
    rows = [(10 * i + j, f"see {word} there") for i, pair in enumerate(LONG_PAIRS) for j, word in enumerate(pair)]
    found = dc.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert as_found(found) == brute(rows, items) and sum(n for (_, _, hit, _), n in brute(rows, items).items() if hit) == 3
