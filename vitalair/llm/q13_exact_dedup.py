"""op13: exact duplicates of documents against a history, by a minimal perfect hash over its distinct digests.

Texts with A-Z lower-cased are known by their SHA-256.  The distinct digests of
the history fill the slots of a minimal perfect hash; a slot holds the full
digest, the locator of its winner (doc_id and partition) and how many rows have
it.  Newer documents are summed up by digest, find their slot and are members if
the slot's digest is theirs; nonmembers group among themselves.  Bytes are
compared too: of each digest the least and the greatest text, which Spark finds
with a partial aggregate before its shuffle, must be one; the texts of a digest
that has several are grouped by their bytes instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm import minimal_hash
from vitalair.llm.common import ascii_lower, materialise, table


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _texts(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    lowered = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    return lowered.select("doc_id", "text", digest(F.col("text")).alias("digest"))


def _rows(texts: DataFrame, *keys: str) -> DataFrame:
    """Rows summed up by keys, doc_id and partition: a row repeated with its doc_id is one of n."""
    return texts.withColumn("part", F.spark_partition_id()).groupBy(*keys, "doc_id", "part").agg(F.count("*").alias("n"))


def _groups(rows: DataFrame, *keys: str) -> DataFrame:
    """Size and winner of each group: the largest doc_id, of its repeats one in the first partition."""
    return rows.groupBy(*keys).agg(F.max(F.struct("doc_id", (-F.col("part")).alias("at"))).alias("top"), F.sum("n").alias("size"))


def _judged(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    met = rows.join(groups, list(keys)).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    won = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("part") == -F.col("top.at")) & (F.col("k") == 1)
    return met.select("doc_id", F.col("top.doc_id").alias("keep_id"), F.col("size").alias("group_size"), won.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def register(history: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(slots, pilots, number of buckets) of the groups (digest, top, size) of a history."""
    pilots, n = minimal_hash.build(history.select("digest"))
    return materialise(minimal_hash.with_slots(history, pilots, n), "slots"), pilots, n


def merged(newer: DataFrame, slots: DataFrame, pilots: DataFrame, n: int) -> DataFrame:
    """Groups of history and newer documents together: members join their slot's group, nonmembers are groups of their own."""
    held = slots.select("bucket", "slot", F.col("digest").alias("held"))
    met = minimal_hash.with_slots(newer, pilots, n).join(held, ["bucket", "slot"], "left")
    looked = materialise(met.withColumn("member", F.coalesce(F.col("held") == F.col("digest"), F.lit(False))), "looked-up")
    more = looked.where("member").select("bucket", "slot", F.col("top").alias("other"), F.col("size").alias("more"))
    grown = slots.join(more, ["bucket", "slot"], "left").select("digest", F.greatest("top", "other").alias("top"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))
    return grown.unionByName(looked.where("not member").select("digest", "top", "size"))


def deduplicated(history: DataFrame, newer: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of both tables.

    Null text counts as empty; texts of any length are compared whole; a null doc_id
    is the smallest; of rows repeated with one doc_id one is kept; other columns are
    ignored; empty tables on either side give the rows of the other. digest maps a
    text column to 32 bytes.
    """
    texts = _texts(history, digest).unionByName(_texts(newer, digest))
    known, fresh = (materialise(_rows(_texts(d, digest).select("doc_id", "digest"), "digest"), "rows") for d in (history, newer))
    groups = materialise(merged(_groups(fresh, "digest"), *register(materialise(_groups(known, "digest"), "history"))), "groups")
    bytes_of = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    differ = materialise(bytes_of.where("low != high").select("digest"), "differ")
    rows = known.unionByName(fresh)
    if not differ.limit(1).count():
        return _judged(rows, groups, "digest")
    apart = materialise(_rows(texts.join(differ, "digest"), "digest", "text"), "apart")
    alike = _judged(rows.join(differ, "digest", "left_anti"), groups, "digest")
    return alike.unionByName(_judged(apart, _groups(apart, "digest", "text"), "digest", "text"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History is the older half of the table by doc_id, the rest is newer."""
    docs = table(spark, sf_dir, "documents")
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).alias("m")).first()["m"]
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    return deduplicated(docs.where(old), docs.where(~old))


SQL = """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d"""
