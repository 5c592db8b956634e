"""Visits and patients: code mapping, merging, integration with exposures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalair.operators.patterns import indexed, matched
from vitalair.sources.tables import stored

#: Race codes and their names.
RACES = {"2106-3": "Caucasian", "2054-5": "African American", "2028-9": "Asian", "2076-8": "Native Hawaiian/Pacific Islander", "1002-5": "American/Alaskan Native"}


def race(code: Column) -> Column:
    out = F.when(code.isNull() | (code == "Unknown"), "Unknown")
    for k, v in RACES.items():
        out = out.when(code == k, v)
    return out.otherwise(F.concat(F.lit("Other("), code, F.lit(")")))


def sex(gender: Column) -> Column:
    return F.when(F.lower(gender) == "male", "Male").when(F.lower(gender) == "female", "Female")


def age_years(birth: Column, at: Column) -> Column:
    """Completed years; toward zero before birth."""
    return (F.months_between(F.to_date(at), birth) / 12).cast("int")


def feature_map(codes: DataFrame, code: str, patterns: DataFrame | list[tuple[str, bool, str]]) -> DataFrame:
    """(code, feature) of distinct codes: patterns match whole codes, as regular expressions or as they stand.

    A table of patterns (code, code_is_regex, feature), of any size, goes through the
    pattern index. A short literal list is tried in place: each distinct code meets
    each of its patterns once.
    """
    distinct = codes.select(code).distinct()
    if isinstance(patterns, DataFrame):
        every = patterns.withColumns({"system": F.lit("*"), "system_is_regex": F.lit(None).cast("boolean")})
        return matched(distinct, F.lit(""), F.col(code), stored(indexed(every), "index"))
    hits = [F.when(F.col(code).rlike(f"^(?:{p})$") if is_regex else F.col(code) == p, F.lit(f)) for p, is_regex, f in patterns]
    return distinct.select(code, F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("feature"))


def feature_counts(events: DataFrame, keys: list[str], code: str, patterns, features: list[str]) -> DataFrame:
    """One column a feature: how many pairs of event and pattern a visit has; visits without any are left out."""
    mapped = events.join(feature_map(events, code, patterns), code)
    return mapped.groupBy(*keys).pivot("feature", features).count().fillna(0, features)


def merged_visits(encounters: DataFrame) -> DataFrame:
    """Encounters of one patient at one instant as one visit."""
    join = lambda c, f: F.array_join(F.array_sort(f(F.col(c).cast("string"))), "|")
    return encounters.groupBy("patient_num", "start_date").agg(join("encounter_num", F.collect_list).alias("encounter_num"), join("visit_type", F.collect_set).alias("visit_type"))


def merged_classes(encounters: DataFrame, keys: list[str], key: str, classes: list[str], end: str) -> DataFrame:
    """Encounters of one patient at one instant as one: ids in order and joined by bars, each class column as the sorted set of its bar-joined parts (null if none has it), the first end that is known."""
    parts = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split(c, "[|]")))))
    merged = [F.when(F.count(c) > 0, F.array_join(parts(c), "|")).alias(c) for c in classes]
    ids = F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), "|").alias(key)
    return encounters.groupBy(*keys).agg(ids, *merged, F.min_by(end, F.when(F.col(end).isNotNull(), F.col(key))).alias(end))


def with_exposure(visits: DataFrame, exposure: DataFrame, on: list[str]) -> DataFrame:
    return visits.join(exposure, on, "left")


def patient_periods(visits: DataFrame, measures: list[str]) -> DataFrame:
    """Per patient and period: visit counts by type, and each measure's average, maximum and first value."""
    kind = F.col("visit_type")
    out = [F.count("*").alias("visits"), F.count_if(kind.isin("AMB", "EMER")).alias("ed_visits"), F.count_if(kind == "IMP").alias("inpatient_visits"), F.count_if(kind.isin("AMB", "EMER", "IMP")).alias("all_visits")]
    for m in measures:
        out += [F.avg(m).alias(f"{m}_avg"), F.max(m).alias(f"{m}_max"), F.min_by(m, F.struct("start_date", "encounter_num")).alias(f"{m}_first")]
    return visits.groupBy("patient_num", "study_period").agg(*out)


def visit_table(visits: DataFrame, features: list[str], names: dict[str, str], drop: list[str]) -> DataFrame:
    """Published visit table: features (absent ones 0) with suffix Visit, measures under published names (absent ones null), age below 90.

    Needs birth_date, start_date and bmi; `drop` lists identifying columns.
    """
    age = age_years(F.col("birth_date"), F.col("start_date"))
    counts = [(F.coalesce(F.col(f), F.lit(0)) if f in visits.columns else F.lit(0)).alias(f"{f}Visit") for f in features]
    measures = [(F.col(c) if c in visits.columns else F.lit(None).cast("double")).alias(n) for c, n in names.items()]
    rest = [c for c in visits.columns if c not in features and c not in names and c != "bmi" and c not in drop]
    obese = F.coalesce((F.col("bmi") >= 30).cast("int"), F.lit(0)).alias("ObesityBMIVisit")
    return visits.withColumn("_age", age).where("_age < 90").select(*rest, F.col("_age").alias("AgeVisit"), *counts, obese, *measures)


def active_in_period(pairs: DataFrame, visits: DataFrame, on: list[str]) -> DataFrame:
    """1 where the pair occurs among the visits, else 0."""
    seen = visits.select(*on).distinct().withColumn("active", F.lit(1))
    return pairs.join(seen, on, "left").fillna(0, ["active"])


def crosswalk(patients: DataFrame, confirmed: DataFrame, registry: DataFrame, key: str, diagnosis: str, values: list[str]) -> DataFrame:
    """Patients with two registries (full outer, then left): one flag for each value of the diagnosis, 0 where it is unknown, and membership."""
    both = confirmed.withColumn("_a", F.lit(1)).join(registry.withColumn("_b", F.lit(1)), key, "full")
    flags = [F.coalesce((F.col(diagnosis) == v).cast("int"), F.lit(0)).alias(f"{diagnosis}_{v}") for v in values]
    member = [F.coalesce(c, F.lit(0)).alias(n) for c, n in (("_a", "confirmed"), ("_b", "in_registry"))]
    return patients.join(both, key, "left").select(*[patients[c] for c in patients.columns], *flags, *member)


def patient_list(explicit: DataFrame | None, tables: list[DataFrame], key: str) -> DataFrame:
    """Patients of the explicit table, else all that occur as keys."""
    if explicit is not None:
        return explicit.select(key).distinct()
    out = tables[0].select(key)
    for t in tables[1:]:
        out = out.unionByName(t.select(key))
    return out.distinct()
