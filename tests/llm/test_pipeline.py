import corpus_pipeline
import pytest
from tripyard.llm import exact_dedup

from .test_decontamination import brute as hits
from .test_ngram_join import brute as components
from .texts import EXTRA, SCHEMA, corpus, frame, prose, vocabulary

import random

SPACE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents, a third of them labelled, and a benchmark two of them hold."""
    rng, words = random.Random(12), vocabulary(12)
    items = [(i, prose(rng, words, 20)) for i in range(4)]
    rows = corpus(6, 25)
    rows += [(900, prose(rng, words, 30) + " " + items[0][1] + " " + prose(rng, words, 30)), (901, items[1][1])]
    data = [(i, t, "en" if n % 3 == 0 and t else None, None, 0, *EXTRA) for n, (i, t) in enumerate(rows)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(data, SCHEMA).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_against_brute_force_and_the_run(spark, tables):
    folder, items = tables
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = rows_of(docs)
    named = rows_of(out := stages["language_id"](spark, docs, folder))
    assert out.columns == docs.columns
    letters = [r for r in first if any(c.isalpha() for c in r[1] or "")]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    assert order(named) == order(letters)

    left = rows_of(out := stages["exact_dedup"](spark, frame(spark, named), folder))
    texts = [t.translate(SPACE) for _, t in left]
    assert len(texts) == len(set(texts)) and set(texts) == {t.translate(SPACE) for _, t in named}

    kept = rows_of(out := stages["ngram_join"](spark, frame(spark, left), folder))
    assert out.columns == docs.columns
    numbered = [(n, t) for n, (_, t) in enumerate(left)]
    want = {}
    for (n, _, c) in components(numbered, 5, 4, 5):
        want.setdefault(c, []).append(left[n])
    best = [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in want.values()]
    assert order(kept) == order(best)

    clean = rows_of(stages["decontamination"](spark, frame(spark, kept), folder))
    bad = {(k[0]) for k in hits([(n, t) for n, (_, t) in enumerate(kept)], items) if k[2]}
    assert order(clean) == order([r for n, r in enumerate(kept) if n not in bad]) and len(bad) >= 2

    packed = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in packed.where("piece = 0").collect()) == sorted((i is None, i or 0) for i, _ in clean)


def test_empty_tables_pass_through(spark, tables):
    folder, _ = tables
    empty = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.collect() == []
        assert name == "packing" or out.columns == empty.columns


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and exact_dedup.HEAVY <= 256


def test_letterless_texts_go_without_any_labelled_row(spark):
    docs = frame(spark, [(1, "words"), (2, "1 2 3 !"), (3, None), (4, ""), (5, "\u00e9")])
    out = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "")
    assert sorted(rows_of(out)) == [(1, "words"), (5, "\u00e9")] and out.columns == docs.columns


def test_the_first_stage_keeps_what_its_network_tells_from_a_guess(spark, tables, monkeypatch):
    import numpy as np
    from tripyard.llm import language_id

    rows = [(i, "the cat sat on the mat and " * 3) for i in range(6)] + [(10 + i, "el gato come en la casa de ") for i in range(6)]
    data = [(i, t, "en" if i < 6 else "es", None, 0, *EXTRA) for i, t in rows]
    docs = spark.createDataFrame(data, SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert sorted(rows_of(stage(spark, docs, tables[0]))) == sorted(rows)
    net = language_id.ByteNet.fresh(["en", "es"])
    for p in net.parameters():
        p[:] = 0  # every language the same
    monkeypatch.setattr(language_id, "train", lambda labelled: net)
    assert rows_of(stage(spark, docs, tables[0])) == []
    net.last[:] = np.array([3.0, 0.0])
    assert len(rows_of(stage(spark, docs, tables[0]))) == 12


def test_columns_named_like_internal_ones_survive_every_stage(spark, tables):
    folder, _ = tables
    names = ["row_key", "_row_key", "judged", "judged_lang", "judged_score", "_lang_pred", "_sha", "_sha_own", "_id", "_cp",
             "own_sha", "own_size", "own_row", "kept_id", "kept_sha", "cls", "h", "first"]
    docs = spark.createDataFrame([(1, "one two three four five six seven", "en", *names), (2, "uno dos tres cuatro", "es", *names)],
                                 "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        got = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", *names]
        assert sorted(r.doc_id for r in got) == [1, 2] and all([r[n] for n in names] == names for r in got)
