"""Exact top-k search by integer inner product, with block-at-a-time pruning.

Vectors become integers, floor(scale * x). A vector is a document whose terms
are its dimensions, and documents lie in *ranges* of about ``BLOCK``: near a
pivot vector, then dealt by hash, so that ranges hold like documents and copies
of one vector fill as many ranges as they need. A range is one row: its ids,
its term maxima (largest and smallest component of each dimension) and its
forward index, the components document by document.

Queries are worked off in waves of about ``CELLS`` components (16 MB), which is
what is broadcast at once. In a wave every task reads its ranges some at a time and for each
query orders them by their bound, the sum over terms of the query's component
times the range's maximum for it (its minimum where the query is negative). A
query takes its ranges in that order, scores a whole range through the forward
index (a matrix product for all queries that are at this range), and stops at
the first bound below its k-th best score; bounds that tie with it are scored,
as ids decide ties. Before that, a first look scores each task's best range for
each query, and the k-th best of these over all tasks is where each query
starts. Every candidate is scored or bounded away: results are exact. A wave
reads each range table twice and shuffles at most k rows a query and task.

Pivots are a bounded sample (``PIVOTS`` vectors by hash): they shape ranges and
so the pruning, never the result.

Defined results: a vector that is null, or holds a null or non-finite
component, is neither query nor candidate; components missing at the end of a
shorter vector count as 0; a null id is no query, and as a candidate comes last
among ties; rows with equal ids are queries and candidates of their own, only
the query's own row is left out; an empty table gives an empty table; other
columns are ignored. A component or a score beyond a 64-bit integer is an
error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripyard.llm._tables import ship, staged

SCALE, TOP, EVERY = 1024, 10, 100
BLOCK, PIVOTS, CELLS, SLICE = 256, 256, 1 << 21, 1024
EXACT = float(1 << 53)

HITS = "query long, vec_id long, row long, score long"


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v) of the rows whose vectors take part."""
    component = lambda x: F.lit(float(scale)) * x.cast("double")
    fits = lambda x: F.when(F.abs(component(x)) < float(1 << 62), F.floor(component(x)).cast("long")).otherwise(
        F.raise_error(F.lit("a scaled component does not fit a 64-bit integer")).cast("long"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    vector = table[vector_col]
    rows = table.select(F.monotonically_increasing_id().alias("row"), table[id_col].cast("long").alias("vec_id"), vector.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(finite(x), F.lit(False))))
    return rows.select("row", "vec_id", F.transform("v", fits).alias("v"))


def _padded(column, width: int) -> np.ndarray:
    """Vectors of a list column as rows of a matrix, 0 where they are short."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, cuts = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).astype(np.int64)
    size = np.diff(cuts)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(flat)) - cuts[at]] = flat
    return out


def document_ranges(vectors: DataFrame, width: int, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """(most, least, rows, ids, v): one row for each range of about ``block``
    documents that are near the same pivot."""
    spark = vectors.sparkSession
    ship(spark)
    total = vectors.count()
    share = min(1.0, 4 * pivots / max(total, 1))
    chosen = vectors.where(F.pmod(F.xxhash64("row"), F.lit(1 << 40)) < int(share * (1 << 40))).orderBy(
        F.xxhash64("row", F.lit(1))).limit(pivots).select("v").toArrow()
    centres = spark.sparkContext.broadcast(_padded(chosen.column("v"), width).astype(np.float64))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = centres.value
        half = (points * points).sum(axis=1) / 2
        for batch in batches:
            near = (_padded(batch.column("v"), width).astype(np.float64) @ points.T - half).argmax(axis=1) if len(points) else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], [*batch.schema.names, "pivot"])

    rows = staged(vectors.mapInArrow(placed, "row long, vec_id long, v array<long>, pivot int"), "search-placed")
    parts = rows.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))  # at most `pivots` rows
    dealt = rows.join(F.broadcast(parts), "pivot").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    document = F.struct("row", "vec_id", "v")
    ranges = dealt.groupBy("pivot", "part").agg(F.collect_list(document).alias("docs"))
    ranges = ranges.select(F.col("docs.row").alias("rows"), F.col("docs.vec_id").alias("ids"), F.col("docs.v").alias("v"))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = (_padded(batch.column("v")[i].values, width) for i in range(len(batch)))
            sides = [(d.max(axis=0).tolist(), d.min(axis=0).tolist()) for d in documents]
            maxima = [pa.array([s[i] for s in sides], pa.list_(pa.int64())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*maxima, *batch.columns], ["most", "least", *batch.schema.names])

    return ranges.mapInArrow(indexed, "most array<long>, least array<long>, rows array<long>, ids array<long>, v array<array<long>>")


class _Range:
    def __init__(self, rows: pa.Array, ids: pa.Array, vectors: pa.Array, width: int):
        self.rows = rows.to_numpy(zero_copy_only=False)
        self.nameless = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.forward = _padded(vectors, width)
        self.real = self.forward.astype(np.float64)
        self.largest = float(np.abs(self.real).max()) if self.real.size else 0.0


class _Wave:
    """The queries of a wave, and their best candidates so far in a task."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, least: np.ndarray, k: int):
        self.rows, self.vectors, self.least, self.k = rows, vectors, least, k
        self.real = vectors.astype(np.float64)
        self.up, self.down = np.maximum(self.real, 0), np.minimum(self.real, 0)
        self.reach = np.abs(self.real).sum(axis=1)

    def bounds(self, most: np.ndarray, least: np.ndarray, part: slice) -> np.ndarray:
        """(queries, ranges): no document of the range scores more. Where sums
        could pass the exact range of floats, they are widened."""
        sums = self.up[part] @ most.T + self.down[part] @ least.T
        size = self.reach[part][:, None] * np.maximum(np.abs(most), np.abs(least)).max(axis=1, initial=0)[None, :]
        return np.where(size < EXACT, sums, sums + size * 1e-9)

    def scores(self, chosen: np.ndarray, block: _Range) -> np.ndarray:
        """Inner products of some queries with a range's documents."""
        if not len(chosen) or self.reach[chosen].max() * block.largest < EXACT:
            return (self.real[chosen] @ block.real.T).astype(np.int64)
        exact = self.vectors[chosen].astype(object) @ block.forward.T.astype(object)
        return exact.astype(np.int64)  # an OverflowError beyond 64 bits


def _best(score: np.ndarray, nameless: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score, then smaller id, nameless last."""
    return np.lexsort((rows, ids, nameless, -score))[:k]


def _looked_up(wave, width: int, k: int, first_look: bool):
    """Map function over ranges: (query, vec_id, row, score) of candidates that
    can be among a query's k best, at most k a query and task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_rows, vectors, floors = wave.value
        queries = _Wave(own_rows, vectors, floors, k)
        kth = queries.least.copy()
        found: list[tuple | None] = [None] * len(own_rows)

        def take(q: int, score: np.ndarray, block: _Range, hit: np.ndarray) -> None:
            new = (score[hit], block.nameless[hit], block.ids[hit], block.rows[hit])
            both = new if found[q] is None else tuple(np.concatenate(p) for p in zip(found[q], new, strict=True))
            keep = _best(*both, k)
            found[q] = tuple(p[keep] for p in both)
            if len(keep) == k:
                kth[q] = max(kth[q], int(found[q][0][-1]))

        def work(group: pa.RecordBatch) -> None:
            most, least = (_padded(group.column(c), width).astype(np.float64) for c in ("most", "least"))
            blocks = [_Range(*(group.column(c)[i].values for c in ("rows", "ids", "v")), width) for i in range(len(group))]
            for begin in range(0, len(own_rows), SLICE):
                part = slice(begin, min(begin + SLICE, len(own_rows)))
                bounds = queries.bounds(most, least, part)
                order = np.argsort(-bounds, axis=1, kind="stable")
                active = np.arange(len(bounds))
                for turn in range(1 if first_look else len(blocks)):
                    at = order[active, turn]
                    going = bounds[active, at] >= kth[begin + active]
                    active, at = active[going], at[going]
                    if not len(active):
                        break
                    for b in np.unique(at).tolist():
                        chosen = begin + active[at == b]
                        score = queries.scores(chosen, blocks[b])
                        hits = (score >= kth[chosen][:, None]) & (blocks[b].rows[None, :] != own_rows[chosen][:, None])
                        for i in np.flatnonzero(hits.any(axis=1)).tolist():
                            take(int(chosen[i]), score[i], blocks[b], hits[i])

        for batch in batches:
            documents = max(1, CELLS // width)
            cuts = np.cumsum(batch.column("rows").value_lengths().to_numpy()) // documents
            starts = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), len(batch)]
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                work(batch.slice(begin, end - begin))
        for begin in range(0, len(own_rows), SLICE):
            held = [(q, found[q]) for q in range(begin, min(begin + SLICE, len(own_rows))) if found[q] is not None]
            if not held:
                continue
            score, nameless, ids, docs = (np.concatenate([f[c] for _, f in held]) for c in range(4))
            who = np.repeat(own_rows[[q for q, _ in held]], [len(f[0]) for _, f in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(who), pa.array(ids, pa.int64(), mask=nameless), pa.array(docs), pa.array(score)], ["query", "vec_id", "row", "score"])

    return rows


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP, every: int = EVERY,
          scale: int = SCALE, block: int = BLOCK, pivots: int = PIVOTS, wave: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row whose
    id is divisible by ``every``, among all rows but its own."""
    spark = table.sparkSession
    ship(spark)
    vectors = staged(integer_vectors(table, id_col, vector_col, scale), "search-vectors")
    width = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    ranges = staged(document_ranges(vectors, width, block, pivots), "search-ranges")
    asked = vectors.where(F.col("vec_id") % every == 0)
    waves = max(1, -(-asked.count() // (wave or max(64, CELLS // width))))
    found = None
    for number in range(waves):
        held = asked.where(F.pmod(F.xxhash64("row"), F.lit(waves)) == number).select("row", "v").toArrow()
        rows = held.column("row").to_numpy()
        if not len(rows):
            continue
        own = _padded(held.column("v"), width)
        floors = np.full(len(rows), -(1 << 63), np.int64)
        sent = spark.sparkContext.broadcast((rows, own, floors))
        looked = staged(ranges.mapInArrow(_looked_up(sent, width, k, True), HITS), "search-first-look")
        least = _ranked(looked, k).where(F.col("rank") == k).select("query", "score").toArrow()  # at most a row a query
        place = {q: i for i, q in enumerate(rows.tolist())}
        for q, score in zip(least.column("query").to_pylist(), least.column("score").to_pylist(), strict=True):
            floors[place[q]] = score
        sent = spark.sparkContext.broadcast((rows, own, floors))
        hits = staged(_ranked(ranges.mapInArrow(_looked_up(sent, width, k, False), HITS), k), "search-hits")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    named = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return found.join(named, "query").select("query_id", "rank", "vec_id", "score")


def oracle_sql(scale: int = SCALE, k: int = TOP, every: int = EVERY) -> str:
    return f"""
        WITH v AS (
          SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, q.row AS query, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % {every} = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""
