"""Reversible line deduplication: exact reference counts behind cuckoo filters.

A ``LineIndex`` holds written tables:

* ``postings`` (k1, k2, doc_id): each document's distinct line keys (the
  128-bit hash of the stripped, ASCII-lower-cased line);
* ``refs`` (k1, k2, refs, last): per key the exact number of documents that
  hold it and the largest of their ids;
* ``filters`` (shard, n, table): cuckoo filters over the keys with at least
  ``min_docs`` references. The number of shards follows the number of keys, so
  a filter's size does not.

``insert`` adds documents and ``delete`` takes them out again: postings change,
counts are updated for the keys that those documents hold, and keys that cross
the threshold enter or leave the filter of their shard. Deleting what was
inserted restores the earlier state.

``rewrite`` drops repeated lines: the filters pick the lines that may be
repeated (no false negatives) and the exact counts confirm them, so filter
errors never reach the result. Filters are broadcast while they have at most
``FILTER_BYTES`` altogether; beyond that every line key goes to the exact
join, with the same result.

Defined results: null or empty text is one empty line; a null id is one
document with the smallest id; rows that share an id are one document; lines
whose key is shorter than ``min_chars`` stay; a document whose lines all go
has the empty text; an empty table gives an empty table; in ``rewrite`` all
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.llm._tables import ship, staged, text_column

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS, FILTER_BYTES = 1 << 16, 64 << 20
NO_ID = -(1 << 63)

POSTINGS = "k1 long, k2 long, doc_id long"
REFS = "k1 long, k2 long, refs long, last long"
FILTERS = "shard long, n long, table binary"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """16 bytes for a line long enough to be judged, else None."""
    key = line.strip().lower()  # bytes: ASCII white space and A-Z only
    if len(key) < min_chars:
        return None
    if not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """Four 16-bit fingerprints a bucket, two buckets a key; insert, delete,
    and probes for whole arrays of keys."""

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, self.SLOTS), np.uint16) if table is None else table

    @classmethod
    def holding(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        """A filter with all the keys; its size doubles until they fit."""
        buckets = 1 << max(2, int(max(1, len(k1)) / (cls.SLOTS * 0.8)).bit_length())
        while True:
            made = cls(buckets)
            if all(made.insert(a, b) for a, b in zip(k1.tolist(), k2.tolist(), strict=True)):
                return made
            buckets *= 2

    def places(self, k1, k2):
        """(fingerprint, first bucket, second bucket); arrays or numbers."""
        mark = (k2 & 0xFFFE) + 1  # never 0, which is a free slot
        first = (k1 >> 16) & (self.buckets - 1)
        return mark, first, first ^ ((mark * 0x5BD1) & (self.buckets - 1))

    def insert(self, k1: int, k2: int) -> bool:
        mark, a, b = self.places(k1, k2)
        for i in (a, b):
            free = np.flatnonzero(self.table[i] == 0)
            if len(free):
                self.table[i, free[0]] = mark
                return True
        at = b
        for kick in range(self.KICKS):
            slot = (mark + kick) % self.SLOTS
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at ^= (mark * 0x5BD1) & (self.buckets - 1)
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        return False

    def delete(self, k1: int, k2: int) -> bool:
        mark, a, b = self.places(k1, k2)
        for i in (a, b):
            held = np.flatnonzero(self.table[i] == mark)
            if len(held):
                self.table[i, held[0]] = 0
                return True
        return False

    def may_hold(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(k1, k2)
        mark = mark.astype(np.uint16)[:, None]
        return (self.table[a] == mark).any(1) | (self.table[b] == mark).any(1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy()
        return cls(len(table), table)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       docs[id_col].cast("long").alias("given_id"), text_column(docs, text_col).alias("text"))


def _key_rows(min_chars: int, filters=None):
    """Map function: the distinct keys of each text (only those that a
    broadcast filter may hold, where one is given)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if filters is None else [CuckooFilter.from_bytes(t) for t in filters.value]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at in range(0, len(batch), 1024):
                keys, where = [], []
                for i in range(at, min(at + 1024, len(batch))):
                    own = {line_key(line, min_chars) for line in texts[i].as_py().split(b"\n")}
                    own.discard(None)
                    keys += own
                    where += [i] * len(own)
                both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                take = np.array(where, np.int64)
                if held is not None:
                    shard = both[:, 1] % len(held)
                    hit = np.zeros(len(both), bool)
                    for k in np.unique(shard).tolist():
                        own_rows = np.flatnonzero(shard == k)
                        hit[own_rows] = held[k].may_hold(both[own_rows, 0], both[own_rows, 1])
                    both, take = both[hit], take[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column("doc_id").take(pa.array(take))],
                    ["k1", "k2", "doc_id"])

    return rows


def _kept_lines(min_chars: int):
    """Map function: lines without those whose key is in the row's ``drop``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, drops = batch.column("text").cast(pa.binary()), batch.column("drop")
            lines, dropped, kept = [], [], []
            for i in range(len(batch)):
                own, gone = texts[i].as_py().split(b"\n"), drops[i].as_py()
                stay = own
                if gone:
                    out = {a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True) for a, b in (x.values() for x in gone)}
                    stay = [x for x in own if line_key(x, min_chars) not in out]
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("given_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_text"])

    return rows


@dataclass(frozen=True)
class LineIndex:
    """The state after some inserts and deletes (see the module)."""

    spark: SparkSession
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int = 0
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS

    @staticmethod
    def empty(spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
        none = lambda schema: spark.createDataFrame([], schema)
        return LineIndex(spark, none(POSTINGS), none(REFS), none(FILTERS), 0, min_chars, min_docs)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        ship(self.spark)
        rows = _documents(docs, id_col, text_col).select("doc_id", "text")
        found = rows.mapInArrow(_key_rows(self.min_chars), POSTINGS)
        if self.shards == 0 and self.postings.isEmpty():  # nothing to merge with
            postings = staged(found, "line-postings")
            refs = staged(_counted(postings), "line-refs")
            return replace(self, postings=postings, refs=refs)._with_filters()
        new = staged(found.distinct().join(self.postings, ["k1", "k2", "doc_id"], "left_anti"), "line-added")
        postings = staged(self.postings.unionByName(new), "line-postings")
        delta = _counted(new).withColumnsRenamed({"refs": "d_refs", "last": "d_last"})
        joined = self.refs.join(delta, ["k1", "k2"], "full").select(
            "k1", "k2", F.coalesce("refs", F.lit(0)).alias("was"),
            (F.coalesce("refs", F.lit(0)) + F.coalesce("d_refs", F.lit(0))).alias("refs"),
            F.greatest("last", "d_last").alias("last"))
        return self._moved(postings, joined)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """Without the documents whose ids are given."""
        gone = ids.select(F.coalesce(ids[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id")).distinct()
        keys = self.postings.join(gone, "doc_id", "left_semi").select("k1", "k2").distinct()
        postings = staged(self.postings.join(gone, "doc_id", "left_anti").select("k1", "k2", "doc_id"), "line-postings")
        left = _counted(postings.join(keys, ["k1", "k2"], "left_semi")).withColumnsRenamed({"refs": "n_refs", "last": "n_last"})
        touched = keys.join(left, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("n_refs", F.lit(0)).alias("n_refs"), "n_last")
        joined = self.refs.join(touched, ["k1", "k2"], "left").select(
            "k1", "k2", F.col("refs").alias("was"), F.coalesce("n_refs", "refs").alias("refs"),
            F.when(F.col("n_refs").isNull(), F.col("last")).otherwise(F.col("n_last")).alias("last"))
        return self._moved(postings, joined)

    def _moved(self, postings: DataFrame, joined: DataFrame) -> LineIndex:
        """The next state, from keys with the counts before (``was``) and now."""
        ship(self.spark)
        joined = staged(joined, "line-refs-moved")
        refs = joined.where("refs > 0").select("k1", "k2", "refs", "last")
        after = replace(self, postings=postings, refs=refs)
        if self.shards == 0 or after._shards_needed() > 2 * self.shards:
            return after._with_filters()  # more shards
        limit, shards = self.min_docs, self.shards
        moves = joined.where((F.col("was") >= limit) != (F.col("refs") >= limit)).select(
            _shard(shards).alias("shard"), "k1", "k2", (F.col("refs") >= limit).alias("enters"))
        every = after.refs.where(F.col("refs") >= limit).select(_shard(shards).alias("shard"), "k1", "k2")

        def move(held: pa.Table, changes: pa.Table) -> pa.Table:
            if not len(changes):
                return held
            one = CuckooFilter.from_bytes(held.column("table")[0].as_py()) if len(held) else CuckooFilter(4)
            n, fits = (held.column("n")[0].as_py() if len(held) else 0), True
            for k1, k2, enters in sorted(zip(*(changes.column(c).to_pylist() for c in ("k1", "k2", "enters")), strict=True), key=lambda x: x[2]):
                fits &= one.insert(k1, k2) if enters else one.delete(k1, k2)
                n += 1 if enters else -1
            table = one.to_bytes() if fits else None  # None: full, built anew below
            shard = (held if len(held) else changes).column("shard")[0].as_py()
            return pa.table([pa.array([shard], pa.int64()), pa.array([n], pa.int64()), pa.array([table], pa.binary())], ["shard", "n", "table"])

        moved = staged(self.filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInArrow(move, FILTERS), "line-filters-moved")
        full = moved.where("table IS NULL").select("shard")
        anew = _built(every.join(full, "shard", "left_semi"))
        return replace(after, filters=staged(moved.where("table IS NOT NULL").unionByName(anew), "line-filters"))

    def _shards_needed(self) -> int:
        return max(1, ceil(self.refs.where(F.col("refs") >= self.min_docs).count() / SHARD_KEYS))

    def _with_filters(self) -> LineIndex:
        shards = self._shards_needed()
        hot = self.refs.where(F.col("refs") >= self.min_docs).select(_shard(shards).alias("shard"), "k1", "k2")
        return replace(self, filters=staged(_built(hot), "line-filters"), shards=shards)

    def rewrite(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_lines, n_dropped, kept_text for every row of ``docs``: keys
        with ``min_docs`` references stay only in their last document."""
        ship(self.spark)
        rows = _documents(docs, id_col, text_col)
        size = self.filters.agg(F.coalesce(F.sum(F.length("table")), F.lit(0))).first()[0]
        filters = None
        if size <= FILTER_BYTES:
            tables = {r["shard"]: bytes(r["table"]) for r in self.filters.collect()}
            nothing = CuckooFilter(4).to_bytes()
            filters = self.spark.sparkContext.broadcast([tables.get(k, nothing) for k in range(max(1, self.shards))])
        maybe = rows.select("doc_id", "text").mapInArrow(_key_rows(self.min_chars, filters), POSTINGS)
        hot = self.refs.where(F.col("refs") >= self.min_docs).select("k1", "k2", "last")
        drops = maybe.join(hot, ["k1", "k2"]).where(F.col("doc_id") != F.col("last")).groupBy("doc_id").agg(
            F.collect_set(F.struct("k1", "k2")).alias("drop"))
        return rows.join(drops, "doc_id", "left").select("given_id", "text", "drop").mapInArrow(
            _kept_lines(self.min_chars), "doc_id long, n_lines long, n_dropped long, kept_text string")


def _shard(shards: int):
    return F.pmod(F.col("k2"), F.lit(shards))


def _counted(postings: DataFrame) -> DataFrame:
    """Documents and largest id of each key. Rows are combined map-side by
    (key, document), so a line that most documents hold is spread."""
    return postings.distinct().groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("refs"), F.max("doc_id").alias("last"))


def _built(hot: DataFrame) -> DataFrame:
    def build(table: pa.Table) -> pa.Table:
        k1, k2 = table.column("k1").to_numpy(), table.column("k2").to_numpy()
        order = np.lexsort((k2, k1))
        made = CuckooFilter.holding(k1[order], k2[order])
        return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int64()), pa.array([len(k1)], pa.int64()),
                         pa.array([made.to_bytes()], pa.binary())], ["shard", "n", "table"])

    return hot.groupBy("shard").applyInArrow(build, FILTERS)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index all of ``docs`` and drop their repeated lines."""
    return LineIndex.empty(docs.sparkSession).insert(docs, id_col, text_col).rewrite(docs, id_col, text_col)


def digest(rewritten: DataFrame) -> DataFrame:
    return rewritten.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def oracle_sql() -> str:
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
        WITH l AS (
          SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
        k AS (
          SELECT *, translate(trim(line, {space}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        h AS (
          SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {MIN_CHARS}
          GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
        f AS (SELECT k.*, coalesce(h.last <> doc_id, false) AS gone FROM k LEFT JOIN h USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM f GROUP BY doc_id"""
