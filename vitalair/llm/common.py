"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z and a-z for ASCII-only lower-casing.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: bytes.translate table: A-Z lower-cased, ASCII outside 0-9, A-Z, a-z turned into a space, all else kept.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a fresh local one only in a local session without any (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jdir = sc._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a narrow table to the shared folder and read it back: lineage ends, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` as UTF-8."""
    return text.encode().translate(WORD_TABLE).split() if text else []


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def set_apart(docs: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with all columns but own under names that nothing else has, and the way back for withColumnsRenamed."""
    names = {c: f"other column {i}" for i, c in enumerate(docs.columns) if c not in own}
    return docs.withColumnsRenamed(names), {v: k for k, v in names.items()}
