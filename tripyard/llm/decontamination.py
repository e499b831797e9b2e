"""Benchmark decontamination with a distributed positional inverted index.

The index is a written table: one row per document (its number of words) and
one row per (document, term) with the sorted positions of the term. A term is
the 64-bit hash of a word. Postings are stored for the terms of the test items;
for phrase search only positions inside runs of such terms that are long enough
for one of the term's phrases are stored, as no other position can take part in
a match (``runs``). Test terms up to ``TERMS`` are broadcast to the indexing
tasks; with more of them every word is indexed, with the same matches.

Phrase search starts from the rarest term of each phrase: its postings, moved
back by the term's offset, are the possible starts, and the lists of the other
terms are intersected with them, rarest first, all in Spark expressions.
Proximity search finds spans that hold all terms of a query in any order.

Defined results: null text has no words; an item without words has no windows;
an item shorter than the window is one window; a null id stays null, a null
item id counts as an item named by the empty string; repeated rows are searched
each on its own; empty tables give empty tables or documents without hits;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm import _words
from tripyard.llm._tables import ship, staged, text_column

WINDOW, TERMS = 10, 1 << 20
ENTRY = "row long, doc_id long, n_words int, term long, positions array<int>"


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, window_id, terms): all runs of ``window`` words of each item;
    equal windows share an id, the hash of their terms."""
    ship(items.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, keys, terms = [], [], []
            for i, h in _words.text_rows(batch, "text", _words.NON_ALNUM):
                size = min(window, len(h))
                for k, key in enumerate(_words.grams(h, window).view(np.int64).tolist()):
                    where.append(i)
                    keys.append(key)
                    terms.append(h[k:k + size].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(where, pa.int64())), pa.array(keys, pa.int64()),
                 pa.array(terms, pa.list_(pa.int64()))], ["item_id", "window_id", "terms"])

    source = items.select(F.coalesce(items[id_col].cast("string"), F.lit("")).alias("item_id"), text_column(items, text_col).alias("text"))
    return source.mapInArrow(rows, "item_id string, window_id long, terms array<long>")


def _runs_kept(known: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Positions in runs of known words at least as long as the word needs."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
    length = np.zeros(len(known), np.int64)
    starts, ends = edge[0::2], edge[1::2]
    inside = np.flatnonzero(known)
    length[inside] = np.repeat(ends - starts, ends - starts)
    return known & (length >= need)


def indexed(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of ``docs`` for ``terms`` (term, need): need is the least run
    of indexed words in which a position of the term is of use, 1 for all."""
    spark = docs.sparkSession
    ship(spark)
    found = terms.groupBy("term").agg(F.min("need").alias("need")).orderBy("term").limit(TERMS + 1).toArrow()
    shared = None
    if len(found) <= TERMS:
        shared = spark.sparkContext.broadcast((found.column("term").to_numpy(), found.column("need").to_numpy().astype(np.int64)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_words", "term", "positions"]
        for batch in batches:
            where, counts, term_rows, term_ids, lists = [], [], [], [], []
            for first, data, offsets in _words.chunks(batch.column("text")):
                words = _words.Words(data, offsets, _words.NON_ALNUM)
                h, cut = words.hashes().view(np.int64), words.first
                if shared is None:
                    known, need = np.ones(len(h), bool), np.ones(len(h), np.int64)
                else:
                    keys, least = shared.value
                    at = np.searchsorted(keys, h)
                    at[at == len(keys)] = 0
                    known = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                    need = least[at] if len(keys) else np.ones(len(h), np.int64)
                for i in range(len(offsets) - 1):
                    lo, hi = cut[i], cut[i + 1]
                    where.append(first + i)
                    counts.append(hi - lo)
                    if not known[lo:hi].any():
                        continue
                    kept = np.flatnonzero(_runs_kept(known[lo:hi], need[lo:hi]))
                    if not len(kept):
                        continue
                    own = h[lo:hi][kept]
                    order = np.argsort(own, kind="stable")
                    own, kept = own[order], kept[order].astype(np.int32)
                    cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
                    term_ids.append(own[np.concatenate([[0], cuts])])
                    lists += np.split(kept, cuts)
                    term_rows += [first + i] * (len(cuts) + 1)
            docs_take, terms_take = pa.array(where, pa.int64()), pa.array(term_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(docs_take), batch.column("doc_id").take(docs_take), pa.array(counts, pa.int32()),
                 pa.nulls(len(where), pa.int64()), pa.nulls(len(where), pa.list_(pa.int32()))], names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(terms_take), batch.column("doc_id").take(terms_take), pa.nulls(len(term_rows), pa.int32()),
                 pa.array(np.concatenate(term_ids) if term_ids else [], pa.int64()), pa.array(lists, pa.list_(pa.int32()))], names)

    source = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                         text_column(docs, text_col).alias("text"))
    return staged(source.mapInArrow(rows, ENTRY), "positional-index")


@dataclass(frozen=True)
class PositionalIndex:
    entries: DataFrame

    @staticmethod
    def for_windows(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PositionalIndex:
        terms = windows.select(F.explode("terms").alias("term"), F.size("terms").alias("need"))
        return PositionalIndex(indexed(docs, terms, id_col, text_col))

    @property
    def documents(self) -> DataFrame:
        return self.entries.where("term IS NULL").select("row", "doc_id", "n_words")

    @property
    def postings(self) -> DataFrame:
        return self.entries.where("term IS NOT NULL").select("row", "term", "positions")

    def _by_rarity(self, queries: DataFrame) -> DataFrame:
        """(query, terms): (df, term, offset) of each query, rarest first;
        queries with a term that no document has are gone."""
        spread = queries.select("query", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
        df = self.postings.join(spread.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        return (spread.join(df, "term").groupBy("query", "n")
                .agg(F.sort_array(F.collect_list(F.struct("df", "term", "offset"))).alias("terms"))
                .where(F.size("terms") == F.col("n")).select("query", "terms"))

    def _candidates(self, queries: DataFrame, start) -> DataFrame:
        """(row, asked): per document the queries whose rarest term it has,
        each with that term's list, and its postings of all terms asked for."""
        first = queries.withColumn("term", F.col("terms")[0]["term"]).join(self.postings, "term")
        asked = first.select("row", F.struct("query", "terms", start.alias("starts")).alias("q")).where("size(q.starts) > 0")
        return asked.groupBy("row").agg(F.collect_list("q").alias("asked"))

    def phrases(self, queries: DataFrame) -> DataFrame:
        """Exact matches of ``queries`` (query, terms): (row, query, length,
        starts), all starts of the phrase in the document."""
        ranked = staged(self._by_rarity(queries.dropDuplicates(["query"])), "phrase-terms")
        start = F.filter(F.transform("positions", lambda p: p - F.col("terms")[0]["offset"]), lambda p: p >= 0)
        asked = self._candidates(ranked, start)
        held = self._lists(asked)
        found = F.transform("asked", lambda q: F.struct(
            q["query"].alias("query"), F.size(q["terms"]).alias("length"),
            F.aggregate(F.slice(q["terms"], F.lit(2), F.size(q["terms"])), q["starts"], lambda left, t: F.when(
                F.size(left) == 0, left).otherwise(F.array_intersect(left, F.transform(
                    F.coalesce(F.try_element_at("held", t["term"]), F.array().cast("array<int>")), lambda p: p - t["offset"])))).alias("starts")))
        return asked.join(held, "row").select("row", F.inline(F.filter(found, lambda m: F.size(m["starts"]) > 0)))

    def proximity(self, queries: DataFrame, span: int) -> DataFrame:
        """Spans of at most ``span`` words that hold every term of a query, in
        any order: (row, query, starts), the first words of such spans. The
        index must hold all positions of the terms (``need`` 1)."""
        distinct = queries.dropDuplicates(["query"]).select("query", F.array_distinct("terms").alias("terms"))
        ranked = staged(self._by_rarity(distinct), "proximity-terms")
        asked = self._candidates(ranked, F.col("positions"))
        held = self._lists(asked)
        at = lambda t: F.coalesce(F.try_element_at("held", t["term"]), F.array().cast("array<int>"))
        starts = lambda q: F.array_sort(F.array_distinct(F.filter(
            F.flatten(F.transform(q["terms"], at)),
            lambda s: F.forall(q["terms"], lambda t: F.exists(at(t), lambda p: (p >= s) & (p < s + span))))))
        found = F.transform("asked", lambda q: F.struct(q["query"].alias("query"), starts(q).alias("starts")))
        return asked.join(held, "row").select("row", F.inline(F.filter(found, lambda m: F.size(m["starts"]) > 0)))

    def _lists(self, asked: DataFrame) -> DataFrame:
        """(row, held): the postings of the documents asked about, by term."""
        own = self.postings.join(asked.select("row"), "row", "left_semi")
        return own.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("held"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurrence of an
    item's window), items (sorted ids), spans (start, end) of the hits."""
    windows = staged(windows_of(items, item_id, item_text, window), "windows")
    index = PositionalIndex.for_windows(docs, windows, id_col, text_col)
    matches = staged(index.phrases(windows.select(F.col("window_id").alias("query"), "terms")), "phrase-matches")
    span = F.transform("starts", lambda s: F.struct(s.alias("start"), (s + F.col("length")).alias("end")))
    spans = matches.groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(span)))).alias("spans"))
    names = windows.select(F.col("window_id").alias("query"), "item_id").distinct()
    named = matches.select("row", "query").join(names, "query").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        "spans", F.expr("named_struct('n', 0, 'to', 0)"),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["to"]))).alias("n"),
                              F.greatest(a["to"], s["end"]).alias("to")), lambda a: a["n"])
    hits = spans.join(named, "row").withColumn("n_hit", covered)
    return index.documents.join(hits, "row", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def oracle_sql() -> str:
    """Windows are compared as joined words; words hold no blank."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
        WITH i AS (SELECT item_id, {words} AS w FROM benchmark),
        iw AS (
          SELECT DISTINCT item_id, array_to_string(w[k:k + {WINDOW - 1}], ' ') AS win, least(len(w), {WINDOW}) AS m
          FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS k FROM i WHERE len(w) > 0)),
        d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        dw AS (
          SELECT r, k, m, array_to_string(w[k:k + m - 1], ' ') AS win
          FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
        hit AS (SELECT r, k, dw.m, item_id FROM dw JOIN iw USING (win, m)),
        pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS p FROM hit) GROUP BY r),
        its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
                FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""
