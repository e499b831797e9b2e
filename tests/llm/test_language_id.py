import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripyard.llm import language_id as li

from .texts import EXTRA, SCHEMA, corpus, frame

DATA = "/root/testdata/sf0.01/documents.parquet"


def naive(net, text):
    """Probabilities of one text, byte by byte."""
    raw = li._FOLD[np.frombuffer(text.encode(), np.uint8)]
    total, weight = np.zeros(len(net.languages)), 0
    for lo in range(0, len(raw), li.WINDOW):
        x = np.zeros(li.WINDOW + li._AHEAD, np.uint8)
        part = raw[lo:lo + len(x)]
        x[:len(part)] = part
        pooled = [max(sum(table[j][x[p + j], f] for j in range(w)) for p in range(li.WINDOW))
                  for w, table in zip(li.WIDTHS, net.filters, strict=True) for f in range(li.FILTERS)]
        z = np.maximum(np.array(pooled) + np.concatenate(net.bias), 0) @ net.dense + net.last
        e = np.exp(z - z.max())
        n = min(li.WINDOW, len(raw) - lo)
        total += e / e.sum() * n
        weight += n
    return total / weight


def test_batched_windows_are_those_of_a_byte_loop():
    net = li.ByteNet.fresh(["a", "b", "c"])
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdé ñ\nXYZ09") for _ in range(n)) for n in (1, 3, 189, 190, 191, 192, 193, 195, 400, 1000)]
    raw = [t.encode() for t in texts]
    flat, at = li._laid_out(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    every = li.window_probabilities(net, net.pairs(), flat, at)
    for i, text in enumerate(texts):
        n = np.clip(len(raw[i]) - np.arange(at[i + 1] - at[i]) * li.WINDOW, 0, li.WINDOW)[:, None]
        assert np.allclose((every[at[i]:at[i + 1]] * n).sum(0) / n.sum(), naive(net, text), atol=1e-4)


def test_gradients_are_those_of_finite_differences():
    net = li.ByteNet.fresh(["a", "b", "c"], seed=2)
    rng = np.random.default_rng(3)
    x, y = rng.integers(97, 123, (6, li.WINDOW + li._AHEAD)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    net.filters = [f.astype(np.float64) for f in net.filters]
    net.dense = net.dense.astype(np.float64)

    def loss():
        pooled = np.concatenate([sum(t[j][x[:, j:j + li.WINDOW]] for j in range(w)).max(1) for w, t in zip(li.WIDTHS, net.filters, strict=True)], 1)
        p = li._softmax(np.maximum(pooled + np.concatenate(net.bias), 0) @ net.dense + net.last)
        return -np.log(p[np.arange(6), y]).mean()

    grads = net._gradients(x, y)
    for p, g in ((net.filters[0], grads[0]), (net.filters[2], grads[2]), (net.dense, grads[6])):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, eps = p[at], 1e-5
        p[at] = kept + eps
        up = loss()
        p[at] = kept - eps
        down = loss()
        p[at] = kept
        assert (up - down) / (2 * eps) == pytest.approx(g[at], rel=1e-3)


def test_held_out_accuracy_on_the_given_table(spark):
    docs = spark.read.parquet(DATA)
    got = li.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 250 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in got.collect() if r["held_out"]} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 == 1}


def labelled(spark, rows):
    data = [(i, t, lang, None, 0, *EXTRA) for i, t, lang in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(2)


def test_only_text_decides_and_odd_rows_are_und(spark):
    rng = random.Random(5)
    one, two = ["thing", "with", "the", "edly"], ["ñar", "él", "que", "ción"]
    rows = [(i, " ".join(rng.choice(w) for _ in range(40)), lang) for i in range(120) for w, lang in [((one, "en"), (two, "es"))[i % 2]]]
    rows += [(i, t, None) for i, t in [(500, None), (501, ""), (502, "12 34 !?"), (503, "que ción él"), (None, "the thing with"), (503, "que ción él")]]
    rows += [(600, " ".join(two * 9_000), "en")]  # a wrong label, a long text
    docs = labelled(spark, rows)
    got = {}
    for r in li.identify(docs).collect():
        got.setdefault(r["doc_id"], r)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert got[503]["lang_pred"] == "es" and got[None]["lang_pred"] == "en" and not got[None]["held_out"] and got[600]["lang_pred"] == "es"
    net = li.train(li.labelled_rows(docs))
    kept = li.predict(docs, net, out=("_l", "_s"))
    assert kept.columns == [*docs.columns, "_l", "_s"]
    assert kept.drop("_l", "_s").exceptAll(docs).isEmpty() and docs.exceptAll(kept.drop("_l", "_s")).isEmpty()


def test_nothing_labelled_and_empty_table(spark):
    docs = frame(spark, corpus(1, 3))
    assert {(r["lang_pred"], r["score"]) for r in li.identify(docs).collect()} == {("und", 0.0)}
    assert li.identify(frame(spark, [])).collect() == []
    assert li.training_windows(li.labelled_rows(docs)).agg(F.count("*")).first()[0] == 0


def test_training_writes_no_sample_and_sorts_it(spark, monkeypatch):
    written, seen = [], {}
    monkeypatch.setattr(li, "staged", lambda df, name: written.append(name) or df)
    monkeypatch.setattr(li.ByteNet, "fit", lambda self, windows, labels: seen.update(windows=windows, labels=labels, languages=self.languages))
    rows = [(i, f"{'Wort é' if i % 3 else 'palabra'} {i} " * (i % 50), "dé"[: 1 + i % 2] if i % 3 else "es") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    li.train(li.labelled_rows(docs))
    assert written == ["lang-counts"]
    assert seen["languages"] == ["d", "dé", "es"]
    got = [(int(y), w.tobytes()) for y, w in zip(seen["labels"], seen["windows"], strict=True)]
    assert got == sorted(got) and len({y for y, _ in got}) == 3


def test_results_leave_in_few_files(spark, tmp_path):
    rows = [(i, f"{'the thing' if i % 2 else 'que el'} {i} " * 9, "en" if i % 2 else "es") for i in range(300)] + [(7, None, None), (None, "12", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(40)
    li.identify(docs).write.parquet(str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part-*"))) <= 2
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in rows)
