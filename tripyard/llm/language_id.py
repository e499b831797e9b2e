"""Language identification with a byte convolutional network (numpy).

A text's bytes are cut into windows of ``WINDOW`` bytes, all of them, each read
together with the few bytes that follow, so no byte n-gram is lost. Filters of
widths 2, 3 and 4 run over a window; each filter's maximum passes a ReLU; a
softmax gives the window's language probabilities. A text's probabilities are
the means over its windows, weighted by their bytes.

Training is done in numpy on the driver, from a bounded sample: at most
``SAMPLE_DOCS`` labelled texts, the same number per language in hash order, and
of each at most ``SAMPLE_WINDOWS`` windows spread over the whole text. The
input of a filter is one-hot bytes, so a trained filter is a table by byte; at
scoring, tables of byte pairs halve the lookups.

Defined results: a null, empty or letterless text is ``und`` with score 0; so
is every text where nothing was labelled; a null id is in fold null, which is
a training fold; repeated rows are judged alike; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripyard.llm import _words
from tripyard.llm._tables import fold_of, free_name, ship, small_batches, staged, text_column

UNKNOWN = "und"
WINDOW, WIDTHS, FILTERS = 192, (2, 3, 4), 8
SAMPLE_DOCS, SAMPLE_WINDOWS = 1600, 12
EPOCHS, BATCH, RATE = 4, 128, 0.02
FOLDS, HELD_OUT_FOLD = 3, 1
#: Partitions that results are dealt to before Spark merges or splits them by size.
DEALT = 12
_AHEAD = max(WIDTHS) - 1

#: A-Z as a-z, all digits alike.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48


@dataclass
class ByteNet:
    """filters[k]: (width, 256, FILTERS); bias[k]: (FILTERS,); dense, last: softmax layer."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    dense: np.ndarray
    last: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> ByteNet:
        rng = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        return cls(languages, [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   rng.normal(0, 0.3, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, *self.bias, self.dense, self.last]

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 11) -> None:
        """Adam on the windows' cross-entropy; (n, WINDOW + _AHEAD) bytes."""
        rng = np.random.default_rng(seed)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), BATCH):
                step += 1
                rows = order[lo:lo + BATCH]
                for p, g, (m, v) in zip(self.parameters(), self._gradients(windows[rows], labels[rows]), state, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        pooled, at = [], []
        for w, table in zip(WIDTHS, self.filters, strict=True):
            conv = sum(table[j][x[:, j:j + WINDOW]] for j in range(w))
            where = conv.argmax(axis=1)
            at.append(where)
            pooled.append(np.take_along_axis(conv, where[:, None, :], axis=1)[:, 0])
        raw = np.concatenate(pooled, axis=1) + np.concatenate(self.bias)
        hidden = np.maximum(raw, 0)
        error = _softmax(hidden @ self.dense + self.last)
        error[np.arange(len(y)), y] -= 1
        error /= len(y)
        back = (error @ self.dense.T) * (raw > 0)
        grads, columns = [], np.broadcast_to(np.arange(FILTERS), (len(y), FILTERS))
        for k, (w, table) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            own, g = back[:, k * FILTERS:(k + 1) * FILTERS], np.zeros_like(table)
            for j in range(w):
                np.add.at(g[j], (np.take_along_axis(x, at[k] + j, axis=1), columns), own)
            grads.append(g)
        biases = np.split(back.sum(0), len(WIDTHS))
        return [*grads, *biases, hidden.T @ error, error.sum(0)]

    def pairs(self) -> list[np.ndarray]:
        """Filter tables by byte pair (a row for each pair) for scoring."""
        pair = lambda a, b: np.ascontiguousarray((a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS))
        two, three, four = self.filters
        return [pair(two[0], two[1]), pair(three[0], three[1]), three[2], pair(four[0], four[1]), pair(four[2], four[3])]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _windows(flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of laid-out texts, and which of them end a text: what is
    behind those belongs to another text."""
    ends = np.zeros(first[-1], bool)
    ends[first[1:] - 1] = True
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW + _AHEAD)[::WINDOW], ends


def window_probabilities(net: ByteNet, tables: list[np.ndarray], flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(windows, languages) of laid-out texts. Positions run down the first
    axis, so the maximum over them is taken on contiguous rows."""
    two, three, third, four, fours = tables
    view, ends = _windows(flat, first)
    out = np.empty((len(ends), len(net.languages)), np.float32)
    bias = np.concatenate(net.bias)
    for lo in range(0, len(ends), 128):
        x = view[lo:lo + 128].T.astype(np.intp)
        x[WINDOW:, ends[lo:lo + 128]] = 0
        pair = x[:-1] * 256 + x[1:]
        head = pair[:WINDOW]
        c3 = three.take(head, axis=0)
        c3 += third.take(x[2:WINDOW + 2], axis=0)
        c4 = four.take(head, axis=0)
        c4 += fours.take(pair[2:WINDOW + 2], axis=0)
        pooled = np.concatenate([two.take(head, axis=0).max(axis=0), c3.max(axis=0), c4.max(axis=0)], axis=1)
        out[lo:lo + 128] = _softmax(np.maximum(pooled + bias, 0) @ net.dense + net.last)
    return out


def _laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts at window starts, filled up with zero bytes, and the first window
    of each text (and the number of all)."""
    sizes = np.diff(offsets)
    first = np.concatenate([[0], np.cumsum(np.maximum(1, -(-sizes // WINDOW)))])
    flat = np.zeros(first[-1] * WINDOW + _AHEAD, np.uint8)
    shift = np.repeat(first[:-1] * WINDOW - offsets[:-1], sizes)
    flat[np.arange(len(data)) + shift] = _FOLD[data]
    return flat, first


def training_windows(labelled: DataFrame) -> DataFrame:
    """(lang, window binary) from the sample of ``labelled`` (key, lang, text)."""
    counts = staged(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("held")), "lang-counts")
    each = max(10, SAMPLE_DOCS // max(1, counts.count()))
    order = Window.partitionBy("lang").orderBy("key", "h")
    hashed = labelled.withColumn("h", F.xxhash64("text"))
    # keys are spread evenly: about twice the rows wanted lie below this one, and only those are ranked
    below = F.least(F.lit(1.0), F.lit(2.0 * each + 200) / F.col("held")) * 2.0**64 - 2.0**63
    low = hashed.select("lang", "key", "h").join(F.broadcast(counts), "lang").where(F.col("key").cast("double") <= below)
    first = low.select("lang", "key", "h").withColumn("n", F.row_number().over(order)).where(F.col("n") <= each)
    # keys alone are ranked; the texts of the few chosen ones are read after that
    sample = hashed.join(F.broadcast(first.drop("n").distinct()), ["lang", "key", "h"], "left_semi").dropDuplicates(["lang", "key", "h"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, found = [], []
            for first, data, offsets in _words.chunks(batch.column("text")):
                flat, at = _laid_out(data, offsets)
                view, ends = _windows(flat, at)
                for i in range(len(offsets) - 1):
                    every = np.arange(at[i], at[i + 1])
                    for k in every[np.linspace(0, len(every) - 1, min(len(every), SAMPLE_WINDOWS)).astype(int)]:
                        where.append(first + i)
                        found.append(view[k, :WINDOW].tobytes() + (bytes(_AHEAD) if ends[k] else view[k, WINDOW:].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(where, pa.int64())), pa.array(found, pa.binary())], ["lang", "window"])

    return sample.select("lang", "text").mapInArrow(rows, "lang string, window binary")


def train(labelled: DataFrame) -> ByteNet | None:
    """A network from ``labelled`` (key, lang, text); None without rows."""
    ship(labelled.sparkSession)
    small_batches(labelled.sparkSession)
    # a bounded sample, needed here only: sorted here, without a written table and its files
    found = training_windows(labelled).toArrow().sort_by([("lang", "ascending"), ("window", "ascending")])
    if not len(found):
        return None
    languages, labels = np.unique(found.column("lang").to_numpy(), return_inverse=True)
    windows = np.frombuffer(b"".join(found.column("window").to_pylist()), np.uint8).reshape(len(found), WINDOW + _AHEAD)
    net = ByteNet.fresh(languages.tolist())
    net.fit(windows, labels)
    return net


def predict(docs: DataFrame, net: ByteNet | None, text_col: str = "text", out=("lang_pred", "score")) -> DataFrame:
    """``docs`` with the columns ``out`` (language, score) in place of any of
    these names; all others are kept. Only texts go to Python."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    clean = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c not in out])
    if net is None:
        return clean.withColumns({out[0]: F.lit(UNKNOWN), out[1]: F.lit(0.0)})
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("struct<lang: string, score: double>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        tables, names = own.pairs(), np.array(own.languages, dtype=object)
        for texts in batches:
            best, score = np.empty(len(texts), np.int64), np.empty(len(texts))
            for first, data, offsets in _words.chunks(texts):
                flat, at = _laid_out(data, offsets)
                part = window_probabilities(own, tables, flat, at)
                left = np.repeat(np.diff(offsets), np.diff(at)) - (np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))) * WINDOW
                weight = np.clip(left, 0, WINDOW)[:, None]  # nothing for a window of padding
                mean = np.add.reduceat(part * weight, at[:-1]) / np.maximum(np.add.reduceat(weight, at[:-1]), 1)
                best[first:first + len(mean)] = mean.argmax(axis=1)
                score[first:first + len(mean)] = np.clip(mean.max(axis=1), 0, 1)
            yield pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["lang", "score"])

    # not to be evaluated a second time where a filter on its result is pushed down
    text, judged = clean[f"`{text_col}`"].cast("string"), judged.asNondeterministic()
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    held = free_name(clean, "judged")
    found = clean.withColumn(held, judged(text))
    return found.withColumns({
        out[0]: F.when(has_letter, F.col(f"{held}.lang")).otherwise(F.lit(UNKNOWN)),
        out[1]: F.when(has_letter, F.col(f"{held}.score")).otherwise(F.lit(0.0))}).drop(held)


def labelled_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(key, lang, text) of the training folds, ordered by a hash of the id."""
    fold = F.coalesce(fold_of(docs[id_col], FOLDS), F.lit(0))
    return docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull() & (fold != HELD_OUT_FOLD)).select(
        F.xxhash64(docs[id_col]).alias("key"), docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row. These rows are far
    smaller than the texts: they are rebalanced (with adaptive execution), so
    that not every split of the texts writes a small file of its own."""
    net = train(labelled_rows(docs, id_col, text_col, lang_col))
    held = F.coalesce(fold_of(docs[id_col], FOLDS) == HELD_OUT_FOLD, F.lit(False))
    rows = docs.select(docs[id_col].alias("doc_id"), held.alias("held_out"), docs[text_col].alias("text"))
    return predict(rows, net).select("doc_id", "held_out", "lang_pred", "score").hint("rebalance", DEALT)
