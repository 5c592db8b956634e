"""Rows in descending key order, each seen together with its follower, without a global sort in one task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalair.llm.common import partitions


def dealt_in_order(df: DataFrame, key: str, tie: str) -> DataFrame:
    """Deal rows to partitions by ranges of `key` (descending), sorted within, and add `ghost` rows.

    A partition's rows are followed by copies (ghost = true) of the first row of
    the next partition that has rows, and the last partition's by the first row
    of all.  So the follower of every row is in the same partition.  Each row is
    shuffled once.  Equal keys stay together, ordered by `tie`; null keys come last.
    """
    spark = df.sparkSession
    n = partitions(spark)
    order = F.coalesce(F.col(key).cast("double"), F.lit(-math.inf))
    cuts = sorted(set(df.select(F.col(key).cast("double").alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []

    def slot(d: DataFrame) -> DataFrame:
        if not cuts:
            return d.withColumn("_slot", F.lit(0))
        b = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_order", outputCol="_bucket")
        d = b.transform(d.withColumn("_order", order))
        return d.withColumn("_slot", (F.lit(len(cuts)) - F.col("_bucket")).cast("int")).drop("_order", "_bucket")

    heads = sorted((r["_slot"], r["top"]) for r in slot(df.select(key)).groupBy("_slot").agg(F.max(key).alias("top")).collect())
    rows = slot(df).withColumn("ghost", F.lit(False))
    if heads:
        moved = [(heads[i - 1][0], heads[i][1]) for i in range(len(heads))]  # heads[-1] is followed by the very first row
        small = spark.createDataFrame(moved, f"_slot int, _key {dict(df.dtypes)[key]}")  # one row a partition
        ghosts = df.join(F.broadcast(small), F.col(key).eqNullSafe(F.col("_key"))).drop("_key").withColumn("ghost", F.lit(True))
        rows = rows.unionByName(ghosts)
    by: list[Column] = [F.col("ghost"), F.col(key).desc_nulls_last(), F.col(tie)]
    return rows.repartitionById(n, F.col("_slot")).sortWithinPartitions(*by).drop("_slot")
