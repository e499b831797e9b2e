"""N-gram Jaccard join: prefix filters under several global token orders.

A text is the set of its distinct k-word shingles (64-bit hashes). Texts with
equal sets are one class, found by a 128-bit digest of the set, so copies are
never paired. Two sets with Jaccard similarity of at least num/den share a
token among the first n - ceil(n * num / den) + 1 of each under *every* total
order of tokens. Three orders are used:

1. by frequency: tokens known to be frequent come last, the others in hash
   order. Frequencies come from the whole corpus (task-side counts of runs of
   ``RUN`` tokens, summed); the order only needs to be the same everywhere, so
   the table of the ``FREQUENT`` most frequent tokens bounds memory, not results.
   This order makes the candidates: classes that share a prefix token, whose
   sizes fit and whose positions of it leave room for the needed overlap. A
   candidate pair must also pass a bitmap: each class carries ``MAP_BITS``
   parity bits of its tokens, and similar sets differ in few of them. Families
   of texts that share prefix tokens but are not similar end here, inside the
   join, and are not written as pairs.
2. and 3. by two other hashes: a candidate pair must share prefix tokens under
   both, too, before its sets are compared, and enough of them: up to the
   smaller of the prefixes' ends both sets are fully known, and each token
   there that the other set lacks lowers the overlap that is still possible.

Only the texts of candidate classes are shingled again, first for the prefixes
of orders 2 and 3, then for whole sets. Which rows those are, and which prefix
tokens occur twice, is first tested on bit tables of fixed size; they have no
false negatives, and exact joins follow.

Links are wanted for components, so a group of near copies isn't paired
through: in each token's list every class is first compared with one hub, the
member with the token furthest forward; verified links merge. Afterwards pairs
are made between different components only, by the classes outside their hub's
component. Every pair of linked classes is either compared or already in one
component, so components are exact.

Defined results: null or empty text, and text without words, has an empty set
and no links; a null id takes part, and a component's id is its smallest
non-null id (null if there is none); repeated rows and ids are linked by their
texts; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm import _words
from tripyard.llm._graph import components
from tripyard.llm._tables import most_frequent, ship, small_batches, staged, text_column

RUN, LOCAL_LEAST, FREQUENT = 4_000_000, 2, 1 << 20
COUNT_ROWS = 1 << 16
ROW_BITS, TOKEN_BITS = 1 << 22, 1 << 24
MAP_BITS = 256
MAPS = [f"map{i}" for i in range(MAP_BITS // 64)]


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, tokens, starts): sorted sets of the rows that have words."""
    rows, sets, size = [], [], 0

    def out():
        sizes = np.array([len(s) for s in sets])
        return np.array(rows), np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])

    for row, h in _words.text_rows(batch, "text", _words.SPACE):
        if not len(h):
            continue
        rows.append(row)
        sets.append(np.unique(_words.grams(h, k)))
        size += len(sets[-1])
        if size > 1 << 18:
            yield out()
            rows, sets, size = [], [], 0
    if rows:
        yield out()


def _digests(tokens: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The 128-bit digests of the sets, which name their classes."""
    halves = [_words.mix(np.add.reduceat(_words.mix(tokens, salt), starts[:-1]), salt + 2) for salt in (101, 102)]
    ends = np.arange(0, 16 * len(starts) - 15, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.stack(halves, axis=1).tobytes())])


def _parities(tokens: np.ndarray) -> np.ndarray:
    """64-bit words of ``MAP_BITS`` bits, each the parity of the tokens that
    hash to it: two sets' bits differ in at most as many places as the sets
    have tokens that are not in both."""
    odd = np.bincount((_words.mix(tokens, 4) % np.uint64(MAP_BITS)).astype(np.int64), minlength=MAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _repeated(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that occur ``LOCAL_LEAST`` times or more, and how often.
    Sorts ``tokens`` in place: a run is long, so it is not copied."""
    tokens.sort()
    reach = len(tokens) - LOCAL_LEAST + 1
    often = tokens[:max(0, reach)]
    often = often[often == tokens[LOCAL_LEAST - 1:]]
    often = often[np.concatenate([[True], often[1:] != often[:-1]])] if len(often) else often
    return often, np.searchsorted(tokens, often, "right") - np.searchsorted(tokens, often)


def _profiles(k: int):
    """Map function: a row for each text, and counts of its run's tokens."""
    names = ["doc_id", "n", "cls", "token"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(RUN, np.uint64), 0

        def counts(run: np.ndarray) -> Iterator[pa.RecordBatch]:
            tokens, times = _repeated(run)
            for lo in range(0, len(tokens), COUNT_ROWS):
                token, n = tokens[lo:lo + COUNT_ROWS], times[lo:lo + COUNT_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(n), pa.int64()), pa.array(n.astype(np.int64)), pa.nulls(len(n), pa.binary()),
                     pa.array(token.view(np.int64))], names)

        for batch in batches:
            n, at, classes = np.zeros(len(batch), np.int64), np.full(len(batch), -1), [pa.nulls(0, pa.binary())]
            for own, tokens, starts in _sets(batch, k):
                n[own] = np.diff(starts)
                at[own] = sum(map(len, classes)) + np.arange(len(own))
                classes.append(_digests(tokens, starts))
                if size + len(tokens) > RUN:
                    yield from counts(held[:size])
                    size = 0
                if len(tokens) > RUN:
                    yield from counts(tokens)
                else:
                    held[size:size + len(tokens)] = tokens
                    size += len(tokens)
            cls = pa.concat_arrays(classes).take(pa.array(at, pa.int64(), mask=at < 0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), cls, pa.nulls(len(batch), pa.int64())], names)
        if size:
            yield from counts(held[:size])

    return rows


def _prefix_size(n, num: int, den: int):
    return n + (-num * n) // den + 1


def _prefixes(k: int, num: int, den: int, frequent):
    """Map function: each class's prefix under the frequency order, once a task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = frequent.value
        seen: set[bytes] = set()
        for batch in batches:
            for _, tokens, starts in _sets(batch, k):
                names = _digests(tokens, starts)
                key = _words.mix(tokens, 1) >> np.uint64(24)
                if len(known):
                    at = np.searchsorted(known, tokens)
                    at[at == len(known)] = 0
                    key |= np.where(known[at] == tokens, often[at], 0).astype(np.uint64) << np.uint64(40)
                classes, sizes, prefixes, maps = [], [], [], []
                for i, c in enumerate(names.to_pylist()):
                    if c in seen:
                        continue
                    seen.add(c)
                    lo, hi = starts[i], starts[i + 1]
                    order = np.argsort(key[lo:hi], kind="stable")  # equal keys: by token
                    classes.append(c)
                    sizes.append(hi - lo)
                    prefixes.append(tokens[lo:hi][order[:_prefix_size(hi - lo, num, den)]].view(np.int64))
                    maps.append(_parities(tokens[lo:hi]))
                columns = np.array(maps, np.int64).reshape(-1, len(MAPS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())),
                     *(pa.array(columns[:, i].copy()) for i in range(len(MAPS)))], ["cls", "n", "prefix", *MAPS])

    return rows


def _other_prefixes(k: int, num: int, den: int):
    """Map function: the prefixes under the second and the third order, as the
    hashes that give the order (equal for equal tokens, signed in order)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, tokens, starts in _sets(batch, k):
                names = _digests(tokens, starts)
                orders = [_words.mix(tokens, salt) for salt in (2, 3)]
                firsts: list[list] = [[], []]
                for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                    most = _prefix_size(hi - lo, num, den)
                    for kept, order in zip(firsts, orders, strict=True):
                        chosen = np.partition(order[lo:hi], most - 1)[:most]
                        kept.append((chosen ^ np.uint64(1 << 63)).view(np.int64))
                lists = [pa.array(x, pa.list_(pa.int64())) for x in firsts]
                yield pa.RecordBatch.from_arrays([names, pa.array(np.diff(starts), pa.int32()), *lists], ["cls", "n", "second", "third"])

    return rows


def _whole_sets(k: int):
    """Map function: the sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, tokens, starts in _sets(batch, k):
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([_digests(tokens, starts), pa.array(np.diff(starts), pa.int32()), lists], ["cls", "n", "tokens"])

    return rows


def _place(column, bits: int):
    return F.pmod(F.xxhash64(column), F.lit(bits))


def _maybe_in(rows: DataFrame, column: str, keys: DataFrame, bits: int, mark: str | None = None) -> DataFrame:
    """``rows`` whose ``column`` may be among ``keys`` (one column): those with
    their bit set in a table of ``bits`` bits, at most bits / 64 rows. With
    ``mark``: all rows, and whether they are such in a column of that name."""
    word, bit = F.floor(F.col("_place") / 64), (F.col("_place") % 64).cast("int")
    table = keys.select(_place(F.col(keys.columns[0]), bits).alias("_place")).groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    marked = rows.withColumn("_place", _place(F.col(column), bits)).withColumn("_word", word)
    on = F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1
    if mark:
        return marked.join(F.broadcast(table), "_word", "left").withColumn(mark, F.coalesce(on, F.lit(False))).drop("_place", "_word", "_bits")
    return marked.join(F.broadcast(table), "_word").where(on).drop("_place", "_word", "_bits")


def _placed(lists: DataFrame, merged: DataFrame) -> DataFrame:
    """The rows of ``lists`` with the component of their class, and whether it
    is outside their hub's. A class without links is a component of its own and
    outside every hub but itself, so those rows, most of all, need no join."""
    of = lambda c: merged.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component"))
    rows = _maybe_in(lists, "cls", merged.select("node"), ROW_BITS, "linked")
    out = ["token", "cls", "n", "pos", *MAPS]
    alone = rows.where("NOT linked").select(*out, F.col("cls").alias("component"), (F.col("cls") != F.col("hub")).alias("outside"))
    joined = rows.where("linked").join(of("cls"), "cls", "left").join(of("hub"), "hub", "left").withColumns({
        "cls_component": F.coalesce("cls_component", "cls"), "hub_component": F.coalesce("hub_component", "hub")})
    return alone.unionByName(joined.select(
        *out, F.col("cls_component").alias("component"), (F.col("cls_component") != F.col("hub_component")).alias("outside")))


class JaccardJoin:
    """Sets, candidates and links of one table of texts."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text"):
        self.k, self.num, self.den = k, num, den
        self.spark = docs.sparkSession
        ship(self.spark)
        small_batches(self.spark)
        self.source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_column(docs, text_col).alias("text"))
        found = staged(self.source.mapInArrow(_profiles(k), "doc_id long, n long, cls binary, token long"), "join-profiles")
        self.profiles = found.where("token IS NULL").drop("token")
        self.counts = found.where("token IS NOT NULL").select("token", "n")

    def _needed(self, n1, n2):
        """Least overlap of sets of these sizes."""
        return F.floor((self.num * (n1 + n2) + (self.num + self.den - 1)) / (self.num + self.den))

    def _fits(self, n1, p1, n2, p2):
        small, large = F.least(n1, n2), F.greatest(n1, n2)
        return (self.den * small >= self.num * large) & (F.least(n1 - p1, n2 - p2) >= self._needed(n1, n2))

    def _near(self, n1, maps1, n2, maps2):
        """Whether the sets can be similar: their parity bits differ in no more
        places than similar sets have tokens that are not in both."""
        differ = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(maps1, maps2, strict=True)), F.lit(0))
        return differ <= n1 + n2 - 2 * self._needed(n1, n2)

    def _lists(self) -> DataFrame:
        """(token, cls, n, pos, bits, hub, ...) of tokens in more than one prefix."""
        counted = staged(self.counts.groupBy("token").agg(F.sum("n").alias("c")).where("c >= 4"), "join-counts")
        top = most_frequent(counted, "c", FREQUENT).toArrow()
        tokens = top.column("token").to_numpy().view(np.uint64)
        often = np.minimum(top.column("c").to_numpy(), (1 << 23) - 1)  # the most frequent comes last
        order = np.argsort(tokens)
        frequent = self.spark.sparkContext.broadcast((tokens[order], often[order]))
        prefixes = self.source.select("text").mapInArrow(
            _prefixes(self.k, self.num, self.den, frequent),
            "cls binary, n int, prefix array<long>, " + ", ".join(f"{m} long" for m in MAPS))
        once = staged(prefixes.dropDuplicates(["cls"]), "join-prefixes")
        frequent.destroy()  # written, so no task needs it again; the workers let it go
        twice = once.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token")
        posted = once.select("cls", "n", *MAPS, F.posexplode("prefix").alias("pos", "token"))
        posted = staged(_maybe_in(posted, "token", twice, TOKEN_BITS), "join-postings")
        hub = F.min(F.struct("pos", F.xxhash64("cls").alias("h"), "cls", "n", *MAPS)).alias("h")
        shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), hub).where("members > 1")
        n, p = F.col("n"), F.col("pos")
        smallest = F.greatest("least", F.ceil(self.num * n / self.den))
        near = self._near(n, [F.col(m) for m in MAPS], F.col("h.n"), [F.col(f"h.{m}") for m in MAPS])
        return staged(posted.join(shared, "token").where(n - p >= self._needed(n, smallest)).select(
            "token", "cls", "n", "pos", *MAPS, F.col("h.cls").alias("hub"), F.col("h.n").alias("hub_n"),
            F.col("h.pos").alias("hub_pos"), near.alias("hub_near")), "join-lists")

    def _possible(self, order: str):
        """Whether the prefixes under an order leave room for the overlap."""
        a, b = F.col(f"a_{order}"), F.col(f"b_{order}")
        end = F.least(F.array_max(a), F.array_max(b))
        shared = F.size(F.array_intersect(a, b))
        missed = lambda own: F.size(F.filter(own, lambda v: v <= end)) - shared
        left = F.least(F.col("a_n") - missed(a), F.col("b_n") - missed(b))
        return (shared > 0) & (left >= self._needed(F.col("a_n"), F.col("b_n")))

    def _reshingled(self, pairs: DataFrame, function, schema: str, name: str) -> DataFrame:
        """A row for each class of ``pairs`` (and for a few others), from the
        text with the smallest id."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        ids = self.profiles.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(wanted, "cls", "left_semi")
        texts = _maybe_in(self.source, "doc_id", ids.select("doc_id"), ROW_BITS)
        return staged(texts.select("text").mapInArrow(function, schema).dropDuplicates(["cls"]), name)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that share prefix tokens under the other
        orders, too, and whose sets are similar: (a, b)."""
        pairs = staged(pairs, "join-pairs")
        orders = self._reshingled(pairs, _other_prefixes(self.k, self.num, self.den), "cls binary, n int, second array<long>, third array<long>", "join-orders")
        of = lambda c, t: t.select(*[F.col(x).alias(f"{c}_{x}" if x != "cls" else c) for x in t.columns])
        filtered = pairs.join(of("a", orders), "a").join(of("b", orders), "b").where(
            self._possible("second") & self._possible("third")).select("a", "b")
        filtered = staged(filtered, "join-filtered")
        sets = self._reshingled(filtered, _whole_sets(self.k), "cls binary, n int, tokens array<long>", "join-sets")
        compared = filtered.join(of("a", sets), "a").join(of("b", sets), "b")
        overlap = F.size(F.array_intersect("a_tokens", "b_tokens"))
        return staged(compared.where(overlap >= self._needed(F.col("a_n"), F.col("b_n"))).select("a", "b"), "join-verified")

    def links(self) -> DataFrame:
        """(a, b) of classes, verified; enough of all links to connect each
        component."""
        lists = self._lists()
        fits_hub = self._fits(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos"))
        best = lists.where((F.col("cls") != F.col("hub")) & fits_hub & F.col("hub_near")).groupBy("cls", "hub").agg(
            F.count(F.lit(1)).alias("times")).groupBy("cls").agg(F.max_by("hub", F.struct("times", "hub")).alias("hub"))
        first = self._verified(best.select(F.col("cls").alias("a"), F.col("hub").alias("b")))
        placed = staged(_placed(lists, components(first)), "join-placed")
        others = placed.where("outside").select("token", *[F.col(c).alias(f"o_{c}") for c in ("cls", "n", "pos", *MAPS, "component")])
        crossing = others.join(placed, "token").where(
            (F.col("component") != F.col("o_component")) & (~F.col("outside") | (F.col("o_cls") < F.col("cls")))
            & self._fits(F.col("n"), F.col("pos"), F.col("o_n"), F.col("o_pos"))
            & self._near(F.col("n"), [F.col(m) for m in MAPS], F.col("o_n"), [F.col(f"o_{m}") for m in MAPS]))
        pairs = crossing.select(F.least("cls", "o_cls").alias("a"), F.greatest("cls", "o_cls").alias("b")).distinct()
        return first.unionByName(self._verified(pairs))

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id for every row."""
        merged = components(self.links()).select(F.col("node").alias("cls"), "component")
        classes = self.profiles.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        labelled = staged(classes.join(merged, "cls", "left").withColumn("component", F.coalesce("component", "cls")), "join-classes")
        smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
        known = labelled.join(smallest, "component").select("cls", "n", "component_id")
        return self.profiles.join(known, ["cls", "n"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of texts whose k-word shingle sets are similar by num/den."""
    return JaccardJoin(docs, k, num, den, id_col, text_col).components()


def oracle_sql(k: int = 3, num: int = 9, den: int = 10) -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
    return f"""
        WITH RECURSIVE w AS (SELECT doc_id, {words} AS w FROM documents),
        s AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS shingle
          FROM (SELECT *, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE {den} * c >= {num} * (nx.n + ny.n - c)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
        SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
        FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x"""
