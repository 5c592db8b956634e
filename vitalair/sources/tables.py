"""Reading and writing flat tables: partial schemas, differing headers, nested columns as text, sparse rows."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder beside the session's checkpoints, which all executors see; a local one only in a local session without any."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        own = sc._jsc.sc().getCheckpointDir()
        found = own.get() if own.isDefined() else None
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(found)
    return f"{found.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table, written to a fresh shared folder and read back: what follows reads it and computes nothing anew."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_absent(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Add the columns of schema that df lacks as typed nulls; those present stay as they are."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns})


def read_csv(spark: SparkSession, path: str, schema: dict[str, str] | None = None, default: str = "string", **options) -> DataFrame:
    """CSV with a header: columns in schema have its types, others `default`; columns of schema that the file lacks are null.

    Only the header is read to learn the names; types are never inferred.
    """
    schema = schema or {}
    names = spark.read.csv(path, header=True, **options).columns
    typed = T.StructType([T.StructField(c, T._parse_datatype_string(schema.get(c, default))) for c in names])
    return with_absent(spark.read.schema(typed).csv(path, header=True, **options), schema)


def write_csv(df: DataFrame, path: str, one_file: bool = False, **options) -> None:
    """CSV with a header. One file only where the caller knows the table to be small."""
    flat = df.select(*[as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
    (flat.coalesce(1) if one_file else flat).write.csv(path, header=True, **options)


def as_text(c: Column, t: T.DataType) -> Column:
    """Nested values as text: arrays [a,b], structs (a,b), maps {k_v:w} with keys in order; plain values stay."""
    if isinstance(t, T.ArrayType):
        inner = F.transform(c, lambda x: F.coalesce(as_text(x, t.elementType).cast("string"), F.lit("")))
        return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]")))
    if isinstance(t, T.StructType):
        parts = [F.coalesce(as_text(c[f.name], f.dataType).cast("string"), F.lit("")) for f in t.fields]
        return F.when(c.isNotNull(), F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")")))
    if isinstance(t, T.MapType):
        pair = lambda k: F.concat_ws(":", k.cast("string"), F.coalesce(as_text(c[k], t.valueType).cast("string"), F.lit("")))
        return F.when(c.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(c)), pair), ","), F.lit("}")))
    return c


def write_by_key(df: DataFrame, keys: list[str], path: str) -> None:
    """One folder a key value. Rows meet by key and a hash, so that a key with very many rows has several writers."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    df.repartition(*keys, salt).write.partitionBy(*keys).parquet(path)


def union_all(tables: list[DataFrame], fill=None) -> DataFrame:
    """Rows of all tables under the union of their columns; what a table lacks is null or `fill`."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return out if fill is None else out.fillna(fill)


def merge_tables(tables: list[DataFrame], on: list[list[str]], how: list[str], patterns: list[str] | None = None) -> DataFrame:
    """Join tables one after the other; patterns choose columns of each by whole-name regular expression, keys stay."""
    import re

    if patterns:
        keys = {k for step in on for k in step}
        tables = [t.select(*[c for c in t.columns if c in keys or re.fullmatch(p, c)]) for t, p in zip(tables, patterns)]
    out = tables[0]
    for t, k, h in zip(tables[1:], on, how):
        out = out.join(t, k, h)
    return out


def sparse_to_map(text: Column, names: Column) -> Column:
    """`(i,value)!(i,value)...` with the names of the positions -> map of name to value as text; positions without a name are left out."""
    cells = F.filter(F.split(text, "!"), lambda x: x.rlike(r"^\(\d+,.*\)$"))
    at = lambda x: F.regexp_extract(x, r"^\((\d+),", 1).cast("int")
    pairs = F.transform(cells, lambda x: F.struct(F.get(names, at(x)).alias("k"), F.regexp_extract(x, r"^\(\d+,(.*)\)$", 1).alias("v")))
    return F.map_from_entries(F.filter(pairs, lambda p: p["k"].isNotNull()))


def to_sparse(dense: Column) -> Column:
    """array -> struct(indices, elements, size) of the elements that are neither null nor zero."""
    held = F.filter(F.transform(dense, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["x"].isNotNull() & (p["x"] != 0))
    return F.struct(held["i"].alias("indices"), held["x"].alias("elements"), F.size(dense).alias("size"))


def to_dense(sparse: Column, zero: float = 0.0) -> Column:
    """The array again, with `zero` where nothing is held."""
    held = F.map_from_arrays(sparse["indices"], sparse["elements"])
    return F.when(sparse["size"] > 0, F.transform(F.sequence(F.lit(0), sparse["size"] - 1), lambda i: F.coalesce(F.try_element_at(held, i), F.lit(zero)))).otherwise(F.array().cast("array<double>"))


def read_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(json, file): one text a line, or one a file, with the name of its file."""
    return spark.read.text(path, wholetext=whole).select(F.col("value").alias("json"), F.col("_metadata.file_name").alias("file"))


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON document a row and line; nulls are left out."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", schema).alias("d")).select("d.*")


def concatenated(spark: SparkSession, paths: list[str], pattern: str, fill: str, file_column: str | None = None, distinct: bool = False, **options) -> DataFrame:
    """CSV files as one table: columns whose whole name meets the pattern, `fill` where a file lacks one, each row with the name of its file, repeated rows once."""
    import re

    parts = []
    for p in paths:
        df = read_csv(spark, p, **options)
        own = [F.col(f"`{c}`") for c in df.columns if re.fullmatch(pattern, c)]
        parts.append(df.select(*own, *([F.col("_metadata.file_path").alias(file_column)] if file_column else [])))
    out = union_all(parts)
    out = out.fillna(fill, [c for c in out.columns if c != file_column])
    return out.dropDuplicates([c for c in out.columns if c != file_column]) if distinct else out


def not_empty(df: DataFrame) -> DataFrame | None:
    """The table, or nothing where it has no rows: an empty result is not written."""
    return None if df.isEmpty() else df


def missing_columns(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns that only one of two tables has."""
    return {"only_first": [c for c in a.columns if c not in b.columns], "only_second": [c for c in b.columns if c not in a.columns]}
