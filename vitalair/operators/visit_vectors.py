"""Visit vectors: effective starts, pseudo-visits, study windows, coded features with values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalair.operators.patterns import SCHEMA, indexed, matched
from vitalair.sources.tables import stored


def local_day(instant: Column, offset_hours: int) -> Column:
    """Calendar day of a UTC instant in a zone of fixed offset."""
    return F.to_date(instant + F.make_interval(hours=F.lit(offset_hours)))


def in_window(instant: Column, start: str, end: str) -> Column:
    """Whether an instant lies in the half-open window."""
    return (instant >= F.lit(start).cast("timestamp")) & (instant < F.lit(end).cast("timestamp"))


def effective_starts(visits: DataFrame, items: DataFrame, key: str, start: str, kinds: list[str]) -> DataFrame:
    """Visits with `start` filled where it is missing: the first instant of their items of the first kind that has any; visits without one go.

    Items have the key, a kind and an instant.
    """
    firsts = [F.min(F.when(F.col("kind") == k, F.col("instant"))).alias(f"_{i}") for i, k in enumerate(kinds)]
    held = items.where(F.col(key).isNotNull()).groupBy(key).agg(*firsts)
    filled = visits.join(held, key, "left").withColumn(start, F.coalesce(start, *[f"_{i}" for i in range(len(kinds))]))
    return filled.drop(*[f"_{i}" for i in range(len(kinds))]).where(F.col(start).isNotNull())


def visit_items(visits: DataFrame, items: DataFrame, patient: str, key: str, start: str) -> DataFrame:
    """(patient, start, the items' columns): items stand at the start of their visit; those without one are visits of their own, at their own instant."""
    rest = [c for c in items.columns if c not in (patient, key)]
    own = items.where(F.col(key).isNotNull()).join(visits.select(key, patient, start), [key, *([patient] if patient in items.columns else [])])
    loose = items.where(F.col(key).isNull()).withColumn(start, F.col("instant"))
    return own.select(patient, start, *rest).unionByName(loose.select(patient, start, *rest))


def coding_features(codings: DataFrame, system: str, code: str, patterns: DataFrame | list[dict]) -> DataFrame:
    """(system, code, feature) of distinct codings whose system and code both meet a pattern, a row for each such pattern.

    A pattern has feature, system, code and the flags system_is_regex and
    code_is_regex: true is a regular expression for the whole text, false the
    text as it stands, absent lets `*` stand for anything. Patterns are a table
    of any size, or a short list.
    """
    if not isinstance(patterns, DataFrame):
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        patterns = codings.sparkSession.createDataFrame([tuple(p.get(c) for c in names) for p in patterns], SCHEMA)
    return matched(codings.select(system, code).distinct(), F.col(system), F.col(code), stored(indexed(patterns), "index"))


def coded_counts(items: DataFrame, keys: list[str], system: str, code: str, patterns: DataFrame | list[dict], features: list[str]) -> DataFrame:
    """One column a feature: pairs of coding and pattern per key. Codings are summed up before they meet the map."""
    summed = items.groupBy(*keys, system, code).agg(F.count("*").alias("_n"))
    mapped = summed.join(coding_features(items, system, code, patterns), [system, code])
    return mapped.groupBy(*keys).pivot("feature", features).agg(F.sum("_n")).fillna(0, features)


def value_features(labs: DataFrame, keys: list[str], value: str, flag: str, order: list[str], features: list[str]) -> DataFrame:
    """Per key and feature: number of values, first and last value and flag by order, and whether values of one instant (the first of order) differ.

    labs has a column `feature`.
    """
    at = F.struct(*order)
    held = labs.where(F.col("feature").isin(features)).groupBy(*keys, "feature", order[0]).agg(
        F.count("*").alias("n"), F.min_by(F.struct(value, flag), at).alias("a"), F.min(at).alias("lo"), F.max_by(F.struct(value, flag), at).alias("b"), F.max(at).alias("hi"),
        (F.min(value) != F.max(value)).alias("differ"),
    )
    out = []
    for f in features:
        own = F.col("feature") == f
        first, last = F.min_by("a", F.when(own, F.col("lo"))), F.max_by("b", F.when(own, F.col("hi")))
        out += [F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"{f}_n")]
        out += [x[c].alias(f"{f}_{n}_{w}") for w, x in (("first", first), ("last", last)) for c, n in ((value, "value"), (flag, "flag"))]
        out += [F.coalesce(F.bool_or(own & F.col("differ")), F.lit(False)).alias(f"{f}_differ")]
    return held.groupBy(*keys).agg(*out)


def visit_vectors(visits: DataFrame, items: DataFrame, counts: DataFrame, patient: str, key: str, start: str, kind: str, offset_hours: int) -> DataFrame:
    """One row a patient and instant: ids and types of its visits joined by bars, local day, and the counts' columns (0 where it has none)."""
    own = visits.groupBy(patient, start).agg(F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), "|").alias(key), F.array_join(F.array_sort(F.collect_set(kind)), "|").alias(kind))
    every = own.select(patient, start).unionByName(items.select(patient, start)).distinct()
    named = [c for c in counts.columns if c not in (patient, start)]
    out = every.join(own, [patient, start], "left").join(counts, [patient, start], "left").fillna(0, named).fillna("", [key, kind])
    return out.withColumn("day", local_day(F.col(start), offset_hours))
