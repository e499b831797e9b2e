"""Language-model scores from a subword lattice over an existing vocabulary.

The pieces are those of a public tokenizer file; nothing is added to them.
Their unigram probabilities come from the corpus: every distinct training word
is segmented once, the pieces are counted by word frequency, and the counts are
smoothed over the vocabulary. A text's probability is the sum over all its
segmentations; no piece spans two words, so it is the product over words of the
word's marginal (forward recursion in log space over the lattice of pieces) and
the probability of the end of the text. Characters without a piece of their own
are spelled in byte pieces.

Words are counted with task-side combination and one shuffle. The most frequent
words, at most ``HEAD`` of them, are broadcast with their counts and marginals
and scored where the texts are read; a text's other words are shuffled as
(row, word, times) and joined with the full word table, so the table may be of
any size and nothing is left out.

Defined results: null text is empty and has the end alone; a null id counts as
training; repeated rows are scored (and counted) each on its own; without
training rows all counts are 0; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from math import exp, log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm import _words
from tripyard.llm._tables import fold_of, most_frequent, ship, staged, text_column

VOCABULARY, MARK = "piece_bpe_32k.model", "▁"
HEAD, FLUSH = 1 << 19, 400_000
FOLDS, SMOOTH, PIECE_SMOOTH = 10, 0.1, 0.5

COUNTS = "h long, word binary, c long"


def _processor(vocabulary: str):
    import sentencepiece

    path = vocabulary
    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(vocabulary)
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words with their counts in training rows (0 where they occur
    in held-out rows only); A-Z lower-cased."""
    keys, words, counts, size = [], [], [], 0

    def folded():
        h, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(back, weights=np.concatenate(counts), minlength=len(h)).astype(np.int64)
        every = [w for part in words for w in part]
        return h, [every[i] for i in first.tolist()], total

    def out(h, own, total):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(own, pa.binary()), pa.array(total)], ["h", "word", "c"])

    for batch in batches:
        training = batch.column("training").to_numpy(zero_copy_only=False)
        for first, data, offsets in _words.chunks(batch.column("text")):
            found = _words.Words(data, offsets, _words.SPACE)
            if not len(found.start):
                continue
            h, at, back = np.unique(found.hashes(), return_index=True, return_inverse=True)
            weight = np.repeat(training[first:first + len(offsets) - 1].astype(np.int64), np.diff(found.first))
            raw = data.tobytes()
            keys.append(h)
            words.append([raw[a:b].lower() for a, b in zip(found.start[at].tolist(), found.end[at].tolist(), strict=True)])
            counts.append(np.bincount(back, weights=weight, minlength=len(h)))
            size += len(h)
            if size > FLUSH:
                h, own, total = folded()
                if len(h) > FLUSH // 2:
                    yield out(h, own, total)
                    keys, words, counts, size = [], [], [], 0
                else:
                    keys, words, counts, size = [h], [own], [total], len(h)
    if keys:
        yield out(*folded())


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, word, c) for every distinct word of ``docs`` (text, training)."""
    ship(docs.sparkSession)
    return docs.select("text", "training").mapInArrow(_count_words, COUNTS).groupBy("h").agg(
        F.min("word").alias("word"), F.sum("c").alias("c"))


def piece_counts(words: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(piece, c): pieces of the words' segmentations, weighted by count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(vocabulary)
        total = np.zeros(sp.vocab_size(), np.int64)
        for batch in batches:
            times = batch.column("c").to_numpy()
            texts = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            for ids, n in zip(sp.encode(texts, num_threads=1), times.tolist(), strict=True):
                for i in ids:
                    total[i] += n
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["piece", "c"])

    ship(words.sparkSession)
    return words.where("c > 0").select("word", "c").mapInArrow(rows, "piece long, c long").groupBy("piece").agg(F.sum("c").alias("c"))


class Lattice:
    """Marginal probabilities of words under unigram piece scores (natural
    logarithms)."""

    def __init__(self, vocabulary: str, counts: np.ndarray, ends: int):
        sp = _processor(vocabulary)
        weight = counts + PIECE_SMOOTH
        total = log(weight.sum() + ends + PIECE_SMOOTH)
        score = np.log(weight) - total
        self.end = log(ends + PIECE_SMOOTH) - total
        self.pieces, self.bytes = {}, {}
        for i in range(sp.vocab_size()):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = float(score[i])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.pieces[sp.id_to_piece(i)] = float(score[i])
        self.longest = max(map(len, self.pieces))

    def word(self, word: str) -> float:
        """log of the sum over all segmentations of the word, its leading mark
        included. forward[j]: the same for the first j characters."""
        text, pieces = MARK + word, self.pieces
        forward = [0.0]
        for j in range(1, len(text) + 1):
            terms = []
            for i in range(max(0, j - self.longest), j):
                score = pieces.get(text[i:j])
                if score is not None:
                    terms.append(forward[i] + score)
            if text[j - 1] not in pieces:
                terms.append(forward[j - 1] + sum(self.bytes[b] for b in text[j - 1].encode()))
            if len(terms) == 1:
                forward.append(terms[0])
            else:
                top = max(terms)
                forward.append(top + log(sum([exp(t - top) for t in terms])))
        return forward[-1]


def _with_marginals(words: DataFrame, lattice) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice.value
        for batch in batches:
            scores = [own.word(w.decode("utf-8", "replace")) / log(10) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), pa.array(scores, pa.float64())], ["h", "c", "marginal"])

    return words.mapInArrow(rows, "h long, c long, marginal double")


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
           held_out_fold: int = 0, vocabulary: str = VOCABULARY, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    ship(spark)
    held = F.coalesce(fold_of(docs[id_col], folds) == held_out_fold, F.lit(False))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                       held.alias("held_out"), (~held).alias("training"), text_column(docs, text_col).alias("text"))
    words = staged(word_counts(rows), "lm-words")
    ends = rows.where("training").count()
    n_words, kinds = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = n_words + ends, kinds + (1 if ends else 0)
    norm = total + SMOOTH * (distinct + 1)

    pieces = np.zeros(_processor(vocabulary).vocab_size(), np.float64)
    for r in piece_counts(words, vocabulary).collect():  # at most the vocabulary
        pieces[r["piece"]] = r["c"]
    lattice = Lattice(vocabulary, pieces, ends)
    table = staged(_with_marginals(words, spark.sparkContext.broadcast(lattice)), "lm-marginals")

    top = most_frequent(table, "c", head).toArrow()
    order = np.argsort(top.column("h").to_numpy())
    shared = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy()[order] for c in ("h", "c", "marginal")))
    end_base = log10((ends + SMOOTH) / norm)
    end_known, end_score = int(ends > 0), lattice.end / log(10)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, marginals = shared.value
        base = np.log10((counts + SMOOTH) / norm)
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "h", "times"]
        for batch in batches:
            where, n, known, bases, own_scores, tail_rows, tail_h, tail_n = [], [], [], [], [], [], [], []
            for first, data, offsets in _words.chunks(batch.column("text")):
                words_ = _words.Words(data, offsets, _words.SPACE)
                h, cut = words_.hashes().view(np.int64), words_.first
                at = np.searchsorted(keys, h)
                at[at == len(keys)] = 0
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                texts = len(offsets) - 1
                row_of = np.repeat(np.arange(texts), np.diff(cut))
                own, at = row_of[hit], at[hit]
                sums = [np.bincount(own, weights=v[at], minlength=texts) for v in (counts > 0, base, marginals)]
                where.append(np.arange(first, first + texts))
                n.append(np.diff(cut) + 1)
                known.append(sums[0] + end_known)
                bases.append(sums[1] + end_base)
                own_scores.append(sums[2] + end_score)
                missed = np.flatnonzero(~hit)
                if len(missed):
                    cuts = np.flatnonzero(np.diff(row_of[missed])) + 1
                    for part in np.split(missed, cuts):
                        u, times = np.unique(h[part], return_counts=True)
                        tail_rows.append(np.full(len(u), first + row_of[part[0]]))
                        tail_h.append(u)
                        tail_n.append(times)
            if not where:
                continue
            take = pa.array(np.concatenate(where))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(take), batch.column("doc_id").take(take), batch.column("held_out").take(take),
                 pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(known).astype(np.int64)),
                 pa.array(np.concatenate(bases)), pa.array(np.concatenate(own_scores)),
                 pa.nulls(len(take), pa.int64()), pa.nulls(len(take), pa.int64())], names)
            if tail_rows:
                take = pa.array(np.concatenate(tail_rows).astype(np.int64))
                none = lambda kind: pa.nulls(len(take), kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(take), none(pa.int64()), none(pa.bool_()), none(pa.int64()), none(pa.int64()),
                     none(pa.float64()), none(pa.float64()), pa.array(np.concatenate(tail_h)),
                     pa.array(np.concatenate(tail_n).astype(np.int64))], names)

    parts = staged(rows.select("row", "doc_id", "held_out", "text").mapInArrow(
        scored, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, h long, times long"), "lm-parts")
    tail = parts.where("h IS NOT NULL").select("row", "h", "times").join(table, "h").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("t_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + SMOOTH) / norm)).alias("t_base"),
        F.sum(F.col("times") * F.col("marginal")).alias("t_score"))
    return parts.where("h IS NULL").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("t_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("t_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("t_score", F.lit(0.0))).alias("score"))
