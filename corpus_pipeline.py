"""A corpus pipeline: language ID, exact dedup, near-duplicate join,
benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet into the shared scratch folder and reads it
back for the next one. All stages but the last return the columns of
``documents`` and only drop rows:

* language_id drops texts without any letter (``und``) and texts of which the
  network is hardly surer than a guess among the languages it learned; a text
  of whatever learned language stays.
* exact_dedup keeps the longest, then smallest-id row of equal texts.
* ngram_join keeps the smallest id of each component of texts whose 5-word
  shingle sets are similar by 0.8 or more.
* decontamination drops texts that hold a window of a benchmark item.
* packing returns the pieces of what is left with their places.

Rows are told apart by their id, and by a row number written with them where
ids are null or repeat. An empty table passes through every stage; all other
columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.llm import decontamination, exact_dedup, language_id, ngram_join, packing
from tripyard.llm._tables import free_name, ids_repeat, staged

#: A text stays if the score of its language is this many times that of a guess.
SURER = 1.1


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of its own for each row, and that column's name."""
    key = free_name(docs, "row_key")
    if ids_repeat(docs, "doc_id"):
        return staged(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed"), key
    return docs.withColumn(key, F.col("doc_id")), key


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter and a language that the network, trained on
    the labelled rows of ``docs``, tells from a guess. Null and empty texts go;
    with one learned language, or none, only letters decide."""
    net = language_id.train(language_id.labelled_rows(docs))
    if net is None:  # without any labelled row no language was learned, but a text without letters is none of any
        return docs.where(F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
    lang, score = free_name(docs, "judged_lang"), free_name(docs, "judged_score")
    judged = language_id.predict(docs, net, out=(lang, score))
    least = SURER / len(net.languages) if len(net.languages) > 1 else 0.0
    return judged.where((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= least)).drop(lang, score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space; null
    is empty. A text repeated under one id (or null) stays once."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest id (null last) of each component of similar texts;
    texts without words are similar to none and stay."""
    keyed, key = _keyed(docs)
    groups = ngram_join.jaccard_components(keyed, k=5, num=4, den=5, id_col=key)
    named = keyed.select("doc_id", key).join(groups.select(F.col("doc_id").alias(key), "component_id"), key)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("first")
    stay = named.groupBy("component_id").agg(first).select(F.col(f"first.{key}").alias(key))
    return keyed.join(stay, key, "left_semi").drop(key)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any window of a benchmark item; null texts have no words
    and stay."""
    keyed, key = _keyed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(keyed, benchmark, id_col=key)
    gone = found.where("n_hit > 0").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").drop(key)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row (null text: empty) with their places."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", drop_unknown_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Not expressible in SQL (a trained network, a tokenizer, best fit); the
#: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
