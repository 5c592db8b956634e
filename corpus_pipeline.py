"""Corpus pipeline: stages that each call one operator on all that the stage before kept.

SQL cannot express the stages (fits, rolling hashes, 64-bit fingerprints, packing), so
ORACLE_SQL is None; the tests hold the operators that the stages call against brute force.

All stages keep rows with nulls in any column, and judge null texts as empty ones; texts
of any length are handled whole; repeated rows stay repeated, but for near_dedup; an empty
table gives an empty one; further columns stay as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm.common import materialise, set_apart, shared_dir, table
from vitalair.llm.near_copies import near_copies, set_ids
from vitalair.llm.q03_packing import packed_documents
from vitalair.llm.q04_line_dedup import deduplicated
from vitalair.llm.q07_quality import passing
from vitalair.llm.q08_decontamination import clean_documents


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is in ids (one row an id, stored); a merge join, so that no id table is broadcast at any size."""
    return docs.join(ids.withColumnRenamed("doc_id", "_kept_id").hint("merge"), F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier passes, each judged by its own text; without labels of both kinds all pass."""
    return passing(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that an earlier document has; n_chars follows the text; a text of which nothing is left is empty."""
    return deduplicated(docs).withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more; SimHash under Golay keys, MinHash for what differs in more bits): the least doc_id; rows that share it stay once per set of shingles."""
    columns = docs.columns
    docs, names = set_apart(docs, "doc_id", "text")
    found = near_copies(docs)
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    keep = materialise(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(least).alias("k")).where("k > 0"), "keep")
    once = _kept(docs, keep.where("n = 1").select("doc_id"))
    if keep.where("n > 1").limit(1).count():
        own = found.where(least).select(F.col("doc_id").alias("_kept_id"), F.col("set_id").alias("_own")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_set") == F.col("_own"))
        many = _kept(docs, keep.where("n > 1").select("doc_id")).withColumn("_set", set_ids(F.col("text")))
        many = many.join(own.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", "_set"])
        once = once.unionByName(many.select(*docs.columns))
    return once.withColumnsRenamed(names).select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no or little benchmark text, each judged by its own text."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences of 2048 tokens."""
    return packed_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
