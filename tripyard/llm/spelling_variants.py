"""Spelling variants: words one edit apart, grouped under their frequent form.

Words are counted with task-side combination. Two words are near if they
differ by exactly one inserted, deleted or replaced code point: with m the
length of the longer one, their common prefix and common suffix together reach
m - 1. Such pairs are found by dense prefix-suffix tiling:

* A pair of longer length m has its edit at position p, the length of its
  common prefix. The positions 0..m-1 are cut into windows; outside the window
  that holds p both words agree. So a word is posted, for m its length and for
  m one more, once for each window, under the hash of what lies outside of it.
* A group of more than ``GROUP`` postings has its windows cut in halves, and
  only its own postings are dealt again under the narrower windows, until
  groups are small. A window of one position leaves at most an alphabet of
  words, so this ends; there is no cap and no group is compared unbounded.
* Postings are sorted by group inside partitions and read in tiles. A tile's
  words are a padded matrix of code points, aligned left and, once more,
  right; each pair of blocks of rows is compared at once, and the common
  prefix and suffix of every pair are read from the two comparisons. A pair
  counts only in the window that holds its p, so each pair comes out once, and
  colliding hashes cost a comparison but change nothing.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that is ``RATIO`` times the word's own; its root is found by
following forms. Counts grow along a chain by ``RATIO`` each, so doubling the
steps needs few rounds.

Defined results: null text has no words; a null id alters no word; repeated
rows and ids count each on their own; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm._tables import ship, staged, text_column

LEAST_LENGTH, LEAST_COUNT, RATIO, ALTERED = 7, 2, 10, 31
GROUP, BLOCK, CELLS, HELD = 512, 128, 1 << 21, 200_000


def _count_runs(least: int, altered: int):
    """Map function: (word, n) of a task's documents."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                lowered = text.as_py().encode().lower().decode()  # bytes: A-Z only
                for word, n in Counter(run.findall(lowered)).items():
                    if key is not None:
                        h = crc32(word.encode(), crc32(f"{key}:".encode()))
                        if h % altered == 0:
                            word = word[:h % len(word)] + word[h % len(word) + 1:]
                            if len(word) < least:
                                continue
                    held[word] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return rows


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH,
                altered: int = ALTERED) -> DataFrame:
    """(word, n) of every word of at least ``least`` code points."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("string").alias("id"), text_column(docs, text_col).alias("text"))
    return rows.mapInArrow(_count_runs(least, altered), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(windows: DataFrame) -> DataFrame:
    """Postings with the hash of what their word holds outside of the window;
    a word shorter than m has one position less inside of it."""
    skipped = F.col("end") - F.col("m") + F.length("word")
    outside = F.xxhash64("m", "begin", "end", F.expr("substring(word, 1, begin)"), F.substring("word", skipped + 1, F.col("m")))
    return windows.withColumn("key", outside)


def _halves(begin, end):
    middle = F.floor((begin + end + 1) / 2).cast("int")
    return F.array(F.struct(begin.alias("begin"), middle.alias("end")), F.struct(middle.alias("begin"), end.alias("end")))


def _postings(words: DataFrame, group: int) -> DataFrame:
    """(key, m, begin, end, word, n): every word under each of its windows,
    narrow enough that no group has more than ``group`` postings."""
    length = F.length("word")
    rows = words.withColumn("m", F.explode(F.array(length, length + 1)))
    rows = rows.select("word", "n", "m", F.inline(_halves(F.lit(0), F.col("m"))))
    settled = []
    while True:
        rows = staged(_keyed(rows).select("key", "m", "begin", "end", "word", "n"), "spelling-postings")
        large = rows.where(F.col("end") - F.col("begin") > 1).groupBy("key").agg(
            F.count(F.lit(1)).alias("members")).where(F.col("members") > group).select("key")
        large = staged(large, "spelling-large")
        if large.isEmpty():
            settled.append(rows)
            break
        settled.append(rows.join(large, "key", "left_anti"))
        rows = rows.join(large, "key", "left_semi").select("word", "n", "m", F.inline(_halves(F.col("begin"), F.col("end"))))
    whole = settled[0]
    for part in settled[1:]:
        whole = whole.unionByName(part)
    return whole


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the words' code points aligned left and, reversed, from
    their ends, padded to one column more than the longest (code points of
    words are at most U+00FF)."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    points = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    row = np.repeat(np.arange(len(words)), size)
    column = np.arange(len(points)) - first[row]
    left, right = (np.zeros((len(words), int(size.max()) + 1), np.uint8) for _ in range(2))
    left[row, column] = points
    right[row, size[row] - 1 - column] = points
    return size, left, right


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of a with every row of b. The
    last column differs always; padding is reached only past the shorter end."""
    differ = a[:, None, :] != b[None, :, :]
    differ[:, :, -1] = True
    return differ.argmax(axis=2)


class _Tile:
    """Whole groups, sorted by group, compared in pairs of blocks."""

    def __init__(self, batch: pa.RecordBatch):
        self.key, self.m, self.begin, self.end, self.n = (
            batch.column(c).to_numpy() for c in ("key", "m", "begin", "end", "n"))
        self.word = batch.column("word")
        self.size, self.left, self.right = _matrices(self.word.to_pylist())
        new = (np.diff(self.key) != 0) | (np.diff(self.m) != 0) | (np.diff(self.begin) != 0) | (np.diff(self.end) != 0)
        self.group = np.concatenate([[0], np.cumsum(new)])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows (a, b), a < b, of near words whose edit lies in the window."""
        total, width = self.left.shape
        side = int(max(1, min(BLOCK, (CELLS // width) ** 0.5)))
        found = []
        for i in range(0, total, side):
            a = slice(i, min(i + side, total))
            for j in range(i, total, side):
                if self.group[j] != self.group[a.stop - 1] and j > i:
                    break
                b = slice(j, min(j + side, total))
                wide = int(max(self.size[a].max(), self.size[b].max())) + 1
                prefix = _common(self.left[a, :wide], self.left[b, :wide])
                # of equal words the comparison runs into the padding: they differ by no edit
                longer = np.maximum(self.size[a][:, None], self.size[b][None, :])
                fits = (self.group[a][:, None] == self.group[b][None, :]) & (longer == self.m[a][:, None])
                fits &= (prefix >= self.begin[a][:, None]) & (prefix < self.end[a][:, None])
                if not fits.any():
                    continue
                suffix = _common(self.right[a, :wide], self.right[b, :wide])
                x, y = np.nonzero(fits & (prefix + suffix >= longer - 1))
                later = x + i < y + j
                found.append((x[later] + i, y[later] + j))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _tiles(batches: Iterator[pa.RecordBatch], rows: int = 1 << 13, cells: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Map function over postings sorted by (m, key): whole groups, as many as
    ``rows`` and ``cells`` take (one group at least)."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.RecordBatch, last: bool):
        key, m = table.column("key").to_numpy(), table.column("m").to_numpy()
        ends = np.flatnonzero((np.diff(key) != 0) | (np.diff(m) != 0)) + 1
        if last:
            ends = np.append(ends, len(table))
        begin = 0
        while begin < len(table):
            most = max(1, min(rows, cells // (int(m[begin]) + 1)))
            most = min(most, max(1, int(np.searchsorted(m, 2 * m[begin] + 16, side="right")) - begin))  # like widths together
            at = int(np.searchsorted(ends, begin + most, side="right")) - 1
            if at < 0 or ends[at] <= begin:
                at += 1  # one group is more than that
            if at >= len(ends):
                break
            yield table.slice(begin, int(ends[at]) - begin)
            begin = int(ends[at])
        held[:] = [table.slice(begin)] if begin < len(table) else []

    def near(table: pa.RecordBatch) -> pa.RecordBatch:
        tile = _Tile(table)
        a, b = tile.pairs()
        own, other = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
        return pa.RecordBatch.from_arrays(
            [tile.word.take(own), tile.word.take(other), table.column("n").take(other)], ["word", "near", "near_n"])

    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
        for tile in cut(table, last=False):
            yield near(tile)
    if held:
        for tile in cut(held[0], last=True):
            yield near(tile)


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near, near_n): both directions of every pair of near words of
    ``words`` (word, n; each word once, of at least two code points up to
    U+00FF)."""
    ship(words.sparkSession)
    dealt = _postings(words, group).repartition("m", "key").sortWithinPartitions("m", "key", "begin", "end")
    return dealt.mapInArrow(_tiles, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: (word, form)."""
    at = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(at.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH,
                   least_count: int = LEAST_COUNT, ratio: int = RATIO, altered: int = ALTERED, group: int = GROUP) -> DataFrame:
    """word, n, n_near, form, form_n, root."""
    words = staged(word_counts(docs, id_col, text_col, least, altered).where(F.col("n") >= least_count), "spelling-words")
    near = near_words(words, group).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("best_n"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), F.col("best_n").alias("form_n"))).alias("best"))
    judged = staged(judged.select("word", "n", "n_near", "best.form", "best.form_n"), "spelling-forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def oracle_sql() -> str:
    from tripyard.llm._tables import crc32_sql

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH RECURSIVE runs AS (
          SELECT doc_id, run, count(*) AS c
          FROM (SELECT doc_id, unnest(regexp_extract_all({lower}, '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents)
          GROUP BY 1, 2),
        hashed AS (SELECT run, c, {crc32_sql("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM runs),
        altered AS (
          SELECT c, CASE WHEN h % {ALTERED} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
        w AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM altered WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
        cuts AS MATERIALIZED (
          SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
        pairs AS (
          SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cuts a JOIN w b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cuts a JOIN w b ON a.rest = b.word),
        best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
        j AS MATERIALIZED (
          SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
            CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM w LEFT JOIN best USING (word)),
        follow AS (SELECT word, word AS here, 0 AS steps FROM j UNION ALL SELECT f.word, j.form, steps + 1 FROM follow f JOIN j ON f.here = j.word WHERE j.form IS NOT NULL)
        SELECT word, n, n_near, form, form_n, (SELECT arg_max(here, steps) FROM follow f WHERE f.word = j.word) AS root FROM j"""
