"""Periodic runs of words: maximal repetitions by suffix trees.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends; reported are those of at least ``LEAST`` words and
``POWER`` periods. Every run of two or more periods has a Lyndon root: for one
of two orders (one of words, and its opposite) the longest Lyndon word at some
position of the run is its period. So for each position and order

* the longest Lyndon word starting there ends before the next position whose
  suffix is smaller, found on the ranks that a walk of the suffix tree gives;
* with p its length, the words from i and i + p on agree as far as their
  longest common extension (LCE), and backwards from i - 1 and i + p - 1 by the
  LCE of the reversed text; both together give the stretch of period p.

Suffix trees are Ukkonen's, of the text and of its reversal. An LCE is the
depth of the leaves' lowest common ancestor: the least string depth between
their visits on the tree's Euler tour, answered in constant time by a sparse
table over blocks of the tour and a look into at most two blocks.

Trees are built for stretches that can hold a run at all: each word of a run of
``POWER`` periods occurs that many times in it, so text is cut at words that
occur less often in their stretch, until nothing changes. A cut word is in no
run and extends none, so runs of the stretches are the runs of the text. Texts
without such stretches need no tree. A text is worked off in its own task with
memory in proportion to the longest stretch; nothing is shuffled.

Defined results: null or empty text has no words, no runs, nulls for the
longest run and the digests of empty texts; a null id repeats nothing; repeated
rows are judged each on their own; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm._tables import crc32_sql, ship, text_column

LEAST, POWER = 6, 4
TOUR_BLOCK, ROUNDS = 16, 32


class SuffixTree:
    """Ukkonen's suffix tree of a list of small non-negative numbers, closed by
    an end mark (-1) of its own."""

    def __init__(self, text: list[int]):
        self.text = text = [*text, -1]
        n = self.n = len(text)
        start, end, link = [-1], [-1], [0]
        children: list[dict[int, int] | None] = [{}]
        suffix = [-1]
        node, edge, length, first = 0, 0, 0, 0  # active point; first suffix not yet in the tree
        for i, symbol in enumerate(text):
            pending = 0
            while first <= i:
                if length == 0:
                    edge = i
                own = children[node]
                child = own.get(text[edge])
                if child is None:
                    children[node][text[edge]] = len(start)
                    start.append(i), end.append(n), link.append(0), children.append(None), suffix.append(first)
                    if pending:
                        link[pending], pending = node, 0
                else:
                    size = (end[child] if end[child] <= i else i + 1) - start[child]
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    if text[start[child] + length] == symbol:
                        length += 1
                        if pending:
                            link[pending], pending = node, 0
                        break
                    middle = len(start)
                    start.append(start[child]), end.append(start[child] + length), link.append(0), suffix.append(-1)
                    leaf = middle + 1
                    children.append({text[start[child] + length]: child, symbol: leaf})
                    own[text[edge]] = middle
                    start[child] += length
                    start.append(i), end.append(n), link.append(0), children.append(None), suffix.append(first)
                    if pending:
                        link[pending] = middle
                    pending = middle
                first += 1
                if node == 0 and length > 0:
                    length -= 1
                    edge = first
                elif node:
                    node = link[node]
        self.start, self.end, self.children, self.suffix = start, end, children, suffix

    def leaves(self, descending: bool) -> list[int]:
        """The suffixes in the order of their words, or of the opposite order
        of words; in both a suffix comes after its own prefixes."""
        out, todo, children, suffix = [], [0], self.children, self.suffix
        while todo:
            node = todo.pop()
            own = children[node]
            if own is None:
                out.append(suffix[node])
            else:
                # popped from the end: the end mark (-1) first, then by the order
                keys = sorted(own, reverse=not descending)
                if -1 in own:
                    keys.remove(-1)
                    keys.append(-1)
                todo += [own[key] for key in keys]
        return out

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """The Euler tour's string depths, and each suffix's place on it."""
        depths, place = [], [0] * self.n
        start, end, children, suffix = self.start, self.end, self.children, self.suffix
        todo = [(0, 0)]  # (node, its depth); (-1, depth): back at an inner node
        while todo:
            node, depth = todo.pop()
            if node < 0:
                depths.append(depth)
                continue
            own = children[node]
            if own is None:
                place[suffix[node]] = len(depths)
                depths.append(depth)
                continue
            for child in own.values():
                todo.append((-1, depth))
                todo.append((child, depth + end[child] - start[child]))
        return np.array(depths, np.int64), np.array(place, np.int64)


class Extensions:
    """Longest common extensions of suffixes, constant time each."""

    def __init__(self, tree: SuffixTree):
        depths, self.place = tree.tour()
        self.last = tree.n - 1
        pad = -len(depths) % TOUR_BLOCK
        self.depths = np.concatenate([depths, np.full(pad + TOUR_BLOCK, np.iinfo(np.int64).max)])
        blocks = self.depths.reshape(-1, TOUR_BLOCK)
        self.before = np.minimum.accumulate(blocks, axis=1).ravel()
        self.after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while len(self.table[-1]) > 1 << len(self.table) - 1:
            step = 1 << len(self.table) - 1
            self.table.append(np.minimum(self.table[-1][:-step], self.table[-1][step:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from positions a and b on, a < b <= the end."""
        x, y = self.place[a], self.place[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        bx, by = x // TOUR_BLOCK, y // TOUR_BLOCK
        out = np.minimum(self.after[x], self.before[y])
        inside = np.flatnonzero(bx == by)
        if len(inside):
            at = x[inside, None] + np.arange(TOUR_BLOCK)
            out[inside] = np.where(at <= y[inside, None], self.depths[at], np.iinfo(np.int64).max).min(axis=1)
        between = np.flatnonzero(by - bx > 1)
        if len(between):
            lo, hi = bx[between] + 1, by[between]
            level = np.floor(np.log2(hi - lo)).astype(np.int64)
            for k in np.unique(level).tolist():
                own = level == k
                table, at = self.table[k], between[own]
                out[at] = np.minimum(out[at], np.minimum(table[lo[own]], table[hi[own] - (1 << k)]))
        return out


def _lyndon_lengths(order: list[int], n: int) -> np.ndarray:
    """Length of the longest Lyndon word at each position: up to the next
    position whose suffix is smaller (ranks from ``order``)."""
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.arange(n + 1)
    ranks, ahead, held = rank.tolist(), [0] * n, [n]
    for i in range(n - 1, -1, -1):
        own = ranks[i]
        while ranks[held[-1]] > own:  # the end mark's rank is the least
            held.pop()
        ahead[i] = held[-1] - i
        held.append(i)
    return np.array(ahead, np.int64)


def runs_of(ids: list[int], least: int = LEAST, power: int = POWER) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of numbers; power >= 2."""
    n = len(ids)
    tree = SuffixTree(ids)
    lengths = [_lyndon_lengths(tree.leaves(descending), n) for descending in (False, True)]
    forward = Extensions(tree)
    del tree
    backward = Extensions(SuffixTree(ids[::-1]))
    found: set[tuple[int, int, int]] = set()
    for period in lengths:
        i = np.flatnonzero(np.arange(n) + period < n)
        p = period[i]
        right = forward.of(i, i + p)
        inner = np.flatnonzero(i > 0)
        left = np.zeros(len(i), np.int64)
        # position j of the text is position n - 1 - j of its reversal
        left[inner] = backward.of(n - i[inner] - p[inner], n - i[inner])
        length = p + left + right
        good = length >= np.maximum(least, power * p)
        found |= set(zip((i - left)[good].tolist(), length[good].tolist(), p[good].tolist(), strict=True))
    return found


def stretches(ids: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int]]:
    """(begin, end) of the parts whose words all occur ``power`` times in
    their part, of at least ``least`` words; all runs lie in them. After
    ``ROUNDS`` cuts a part is taken as it is: it may hold rarer words, too."""
    out, todo = [], [(0, len(ids), 0)]
    while todo:
        begin, end, cuts = todo.pop()
        if end - begin < least:
            continue
        _, back, times = np.unique(ids[begin:end], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(times[back] < power) + begin
        if not len(rare) or cuts == ROUNDS:
            out.append((begin, end))
            continue
        edges = np.concatenate([[begin - 1], rare, [end]])
        wide = np.flatnonzero(np.diff(edges) > least)
        todo += [(int(edges[w]) + 1, int(edges[w + 1]), cuts + 1) for w in wide]
    return sorted(out)


def word_runs(words: list, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start and
    period."""
    if len(words) < least:
        return []
    known: dict = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if len(ids) - len(known) < power - 1:  # no word occurs often enough
        return []
    found = []
    for begin, end in stretches(ids, least, power):
        _, own = np.unique(ids[begin:end], return_inverse=True)
        found += [(begin + s, length, p) for s, length, p in runs_of(own.tolist(), least, power)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(words: list, h: int | None) -> list:
    """The words, a tenth of the texts (by hash) with a repeated stretch."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    return words[:a] + cycle * ((n - a) // p) + cycle[:(n - a) % p]


COLUMNS = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string, starts array<long>, lengths array<long>, periods array<long>, collapsed string")


def _detect(least: int, power: int, control: bool):
    names = [c.split(" ")[0] for c in COLUMNS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[c.split(" ")[1]] for c in COLUMNS.split(", ")]

    def judged(key, text: str) -> tuple:
        words = text.encode().split()  # of bytes: exactly [\x20\x09-\x0D]
        if control and key is not None:
            words = planted(words, crc32(str(key).encode()))
        runs = word_runs(words, least, power)
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        text = b" ".join(words if kept.all() else [words[i] for i in np.flatnonzero(kept).tolist()])
        longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = None if longest[0] is None else 1000 * longest[1] // longest[2]
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        start, length, period = ([r[i] for r in runs] for i in range(3))
        return (key, len(words), len(runs), *longest, milli, sha256(lines.encode()).hexdigest(), sha256(text).hexdigest(),
                start, length, period, text.decode())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                held.append(judged(key.as_py(), text.as_py()))
                size += len(held[-1][-1])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    return rows


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, power: int = POWER,
                  control: bool = False) -> DataFrame:
    """Each text's runs (starts, lengths, periods), its longest run, and the
    text with every run collapsed to its first period. ``control`` first
    repeats a stretch in a tenth of the texts (see ``planted``)."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_column(docs, text_col).alias("text"))
    return rows.mapInArrow(_detect(least, power, control), COLUMNS)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def oracle_sql(least: int = LEAST, power: int = POWER) -> str:
    return f"""
        WITH split AS (
          SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        hashed AS (SELECT *, len(w) AS n, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM split),
        placed AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS parts FROM hashed),
        words AS MATERIALIZED (
          SELECT row, doc_id, n, CASE WHEN a IS NULL THEN w
            ELSE list_transform(range(0, n), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // parts) ELSE i END + 1]) END AS w FROM placed),
        spread AS MATERIALIZED (SELECT row, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM words WHERE n >= {least}),
        same AS (
          SELECT x.row, y.i - x.i AS q, x.i FROM spread x JOIN spread y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * {power} <= x.n),
        islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM same),
        found AS (SELECT row, min(i) AS start, q, count(*) + q AS length FROM islands GROUP BY row, q, island),
        runs AS MATERIALIZED (
          SELECT row, start, length, min(q) AS period FROM found WHERE length >= greatest({least}, {power} * q) GROUP BY row, start, length),
        dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (SELECT row, list(i) AS gone FROM dropped GROUP BY row),
        told AS (
          SELECT row, count(*) AS n_runs, arg_min(start, (-length, start, period)) AS start, arg_min(length, (-length, start, period)) AS length,
            arg_min(period, (-length, start, period)) AS period,
            string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY row)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
          sha256(coalesce(lines, '')) AS runs_sha256,
          sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)), ' ') END)
            AS collapsed_sha256
        FROM words LEFT JOIN told USING (row) LEFT JOIN kept USING (row)"""
