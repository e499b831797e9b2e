"""Exact duplicates with a heavy-hitter split (built-in functions only).

Every text is reduced to the SHA-256 digest of its normalised form. A
Misra-Gries summary (the built-in frequent-items sketch) proposes the digests
that may be frequent; their exact counts and winners are computed with
map-side combination and broadcast (at most ``heavy`` rows, whatever the
input), so the rows of a huge group are decided where they are read. All
other digests take the ordinary shuffle: one aggregate per digest, joined back.

Defined results: null text is the empty text and groups with it; white space
alone is empty too; a null id loses every tie against a value; a row that is
repeated in full is one member more, and exactly one member of a group is
kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm._tables import free_name, ids_repeat, staged, text_column

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: Most frequent digests looked at, and counters of the summary: a digest with
#: more than rows / TRACKED members is always among the summary's items.
HEAVY, TRACKED = 256, 8192
#: Sketches that one task merges.
FAN_IN = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_cp, text_sha256): one narrow row a document."""
    text = text_column(docs, text_col)
    normal = F.translate(text, WHITE_SPACE, "")
    return docs.select(
        docs[id_col].alias("doc_id"),
        F.length(text).cast("long").alias("n_cp"),
        F.sha2(normal.cast("binary"), 256).alias("text_sha256"),
    ).withColumn("row", F.monotonically_increasing_id())


def winners(rows: DataFrame) -> DataFrame:
    """Per digest: its size and the row that stays (longest, then smallest id).

    The order-reversing ``~`` makes one ``max`` of a struct pick the smallest
    id; nulls are smallest in a struct, so a null id never wins a tie.
    """
    best = F.max(F.struct("n_cp", F.bitwise_not("doc_id").alias("r_id"), F.bitwise_not("row").alias("r_row")))
    return rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).select(
        "text_sha256", "group_size",
        F.bitwise_not("best.r_id").alias("keep_id"), F.bitwise_not("best.r_row").alias("keep_row"))


def frequent_digests(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED, fan_in: int = FAN_IN) -> DataFrame:
    """At most ``heavy`` candidate digests from the Misra-Gries summary.

    Every task makes one sketch; ``fan_in`` of them meet in one task, then
    ``fan_in`` of these, before the last one sees what is left. Merged sketches
    keep the guarantee of one sketch over all rows. Without rows there is no
    sketch and no candidate."""
    tracked = max(heavy, tracked)
    leaves = rows.select("text_sha256", F.floor(F.spark_partition_id() / fan_in).alias("node"))
    sketches = leaves.groupBy("node").agg(F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("sketch"))
    merge = F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    inner = sketches.groupBy(F.floor(F.col("node") / fan_in).alias("node")).agg(merge)
    top = inner.groupBy(F.lit("all")).agg(merge).select(F.expr(f"approx_top_k_estimate(sketch, {heavy})").alias("top"))
    return top.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("text_sha256"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    rows = staged(digests(docs, id_col, text_col), "exact-digests")
    candidates = staged(frequent_digests(rows, heavy, tracked), "exact-candidates")
    verified = staged(winners(rows.join(F.broadcast(candidates), "text_sha256", "left_semi")), "exact-heavy")
    decided = rows.join(F.broadcast(verified), "text_sha256", "left")
    rest = rows.join(F.broadcast(verified.select("text_sha256")), "text_sha256", "left_anti")
    groups = winners(rest).where("group_size > 1")
    light = rest.join(groups, "text_sha256", "left")
    columns = [
        F.col("doc_id"),
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("text_sha256"),
    ]
    return decided.where(F.col("keep_row").isNotNull()).select(*columns).unionByName(light.select(*columns))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    The rows that go are found by id; a row repeated under one id (same id,
    same text) is reduced to the one with the most code points.
    """
    found = exact_groups(docs, id_col, text_col)
    own, size, row = (free_name(docs, c) for c in ("own_sha", "own_size", "own_row"))
    sha = F.sha2(F.translate(text_column(docs, text_col), WHITE_SPACE, "").cast("binary"), 256)
    joined = docs.withColumns({own: sha, size: F.length(text_column(docs, text_col))})
    keys = found.where("kept").select(F.col("doc_id").alias(free_name(joined, "kept_id")), F.col("text_sha256").alias(free_name(joined, "kept_sha"))).distinct()
    same = [F.col(f"`{x}`").eqNullSafe(F.col(f"`{y}`")) for x, y in zip((id_col, own), keys.columns, strict=True)]
    kept = joined.join(keys, same[0] & same[1], "left_semi")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if not ids_repeat(docs, id_col):
        return kept.select(*columns)
    longest = F.max_by(F.struct(*columns), F.col(size)).alias(row)
    return kept.groupBy(id_col, own).agg(longest).select(f"{row}.*")


def oracle_sql() -> str:
    return """
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n_cp,
                 sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
          FROM documents),
        g AS (
          SELECT doc_id, text_sha256,
                 first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id) AS keep_id,
                 count(*) OVER (PARTITION BY text_sha256) AS group_size
          FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""
