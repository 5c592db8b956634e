"""Profiles of tables: distinct values, counts of values, row numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.operators.binning import ranked


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return df.select(F.expr(f"stack({len(columns)}, {pairs}) AS (name, value)"))


def value_counts(tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """(name, value, n) of the columns of all tables, values as text."""
    return reduce(DataFrame.unionAll, [_long(df, columns) for df, columns in tables]).groupBy("name", "value").agg(F.count("*").alias("n"))


def distinct_values(tables: list[tuple[DataFrame, str]]) -> DataFrame:
    """The different values, as text, of one column of each table together."""
    return reduce(DataFrame.unionAll, [df.select(F.col(c).cast("string").alias("value")) for df, c in tables]).distinct()


def row_index(df: DataFrame, order: list[str], out: str = "index") -> DataFrame:
    """Rows numbered from 0 in the order of columns that tell them apart."""
    return ranked(df, order, out)
