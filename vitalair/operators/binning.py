"""Binning and de-identification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalair.operators.quantiles import exact_quantiles
from vitalair.sources.tables import stored


def fixed_bins(value: Column, edges: list[float]) -> Column:
    """Left-closed bins: the number (from 1) of edges at or below the value; null below the first."""
    hit = sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(value.isNotNull() & (value >= edges[0]), hit)


def _right_closed(value: Column, edges: list[Column]) -> Column:
    hit = sum((F.when(value > e, 1).otherwise(0) for e in edges[1:-1]), F.lit(1))
    return F.when(value.isNotNull(), hit)


def quantile_bins(df: DataFrame, value: str, n: int, out: str) -> DataFrame:
    """n right-closed bins at exact quantiles, the lowest value included; all null if two edges agree."""
    found = exact_quantiles(df, [], value, [i / n for i in range(n + 1)]).first()  # one row
    if found is None or len(set(found["quantiles"])) <= n:
        return df.withColumn(out, F.lit(None).cast("int"))
    return df.withColumn(out, _right_closed(F.col(value), [F.lit(e) for e in found["quantiles"]]))


def width_bins(df: DataFrame, value: str, n: int, out: str) -> DataFrame:
    """n right-closed bins of equal width over the range of the values."""
    span = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    e = [F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (i / n) for i in range(n + 1)]
    return df.crossJoin(F.broadcast(span)).withColumn(out, _right_closed(F.col(value), e)).drop("_lo", "_hi")  # the range is one row


def binary(count: Column) -> Column:
    return F.when(F.coalesce(count, F.lit(0)) < 0.5, 0).otherwise(1)


def capped_distance(d: Column, cap: float = 500.0) -> Column:
    """Distances that are negative or infinite become the cap."""
    return F.when((d < 0) | (d == float("inf")), cap).otherwise(d)


def ranked(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Rows numbered from 0 by order: numbers within ranges of it, plus the rows of earlier ranges.

    Spark deals the ranges by a sample of the rows, so no value of the first column,
    however frequent, holds a range together.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_b").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sizes = sizes.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_b").orderBy(*order)
    met = dealt.withColumn("_r", F.row_number().over(within) - 1).join(F.broadcast(sizes), "_b")
    return met.withColumn(out, F.col("_before") + F.col("_r")).drop("_b", "_r", "_before")


def dense_index(df: DataFrame, key: str, order: Column) -> DataFrame:
    """(key, index from 0) by each key's least order, then key."""
    keyed = df.select(key, order.alias("_o")).groupBy(key).agg(F.min("_o").alias("_o"))
    return ranked(keyed, ["_o", key], "index").drop("_o")


#: Lower ends and labels of the two schemes of age bins.
AGES_WIDE = ([5, 18, 45, 65, 90], ["<5", "5-17", "18-44", "45-64", "65-89"])
AGES_FINE = ([3, 18, 35, 51, 70, 90], ["0-2", "3-17", "18-34", "35-50", "51-69", "70-89"])


def age_bins(age: Column, scheme: tuple[list[int], list[str]]) -> Column:
    """Label of the bin (upper ends are open); null from the last end on."""
    out = F.when(F.lit(False), "")
    for end, label in zip(*scheme):
        out = out.when(age < end, label)
    return out


def survey_rows(survey: DataFrame, ages: list[str], drop: list[str]) -> DataFrame:
    """Rows whose ages are all null or below 90, without the dropped columns, ages binned by both schemes (wide under suffix 2)."""
    kept = survey
    for a in ages:
        kept = kept.where(F.col(a).isNull() | (F.col(a) < 90))
    wide = {f"{a}2": age_bins(F.col(a), AGES_WIDE) for a in ages}
    return kept.drop(*drop).withColumns(wide).withColumns({a: age_bins(F.col(a), AGES_FINE) for a in ages})


def with_registry(patients: DataFrame, survey: DataFrame, key: str, year: int) -> DataFrame:
    """Full outer join with a survey on the patient: flags of membership, year filled in."""
    a, b = patients.withColumn("IN_ICEES", F.lit(1)), survey.withColumn("IN_EPR", F.lit(1))
    return a.join(b, key, "full").fillna(0, ["IN_ICEES", "IN_EPR"]).fillna(year, ["year"])


def registry_periods(rows: DataFrame, survey: DataFrame, key: str, period: str, periods: list) -> DataFrame:
    """Patients or visits and a survey, for each of the periods: full outer join on key and period with flags of membership."""
    asked = survey.withColumn(period, F.explode(F.array(*map(F.lit, periods)))).withColumn("IN_EPR", F.lit(1))
    met = rows.where(F.col(period).isin(periods)).withColumn("IN_ICEES", F.lit(1)).join(asked, [key, period], "full")
    return met.fillna(0, ["IN_ICEES", "IN_EPR"])


def appended_index(known: DataFrame | None, keys: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """(key, index): keys of `known` keep their index, those of `keys` (a row each) that are new are appended in order.

    So an index given once holds over all later runs.
    """
    if known is None:
        return ranked(keys, order, "index").select(key, "index")
    fresh = ranked(keys.join(known.select(key), key, "left_anti"), order, "index")
    first = known.agg(F.coalesce(F.max("index") + 1, F.lit(0)).alias("_first"))  # one row
    return known.select(key, "index").unionByName(fresh.crossJoin(F.broadcast(first)).select(key, (F.col("index") + F.col("_first")).alias("index")))


def person(survey_key: str, patient: str) -> Column:
    """A patient, or a survey's row that belongs to none."""
    return F.coalesce(F.concat(F.lit("p:"), F.col(patient).cast("string")), F.concat(F.lit("s:"), F.col(survey_key).cast("string")))


def persons(survey: DataFrame, crosswalk: DataFrame, rows: DataFrame, survey_key: str, patient: str) -> DataFrame:
    """A row a person of a survey and of patient or visit rows: person, survey_key (the least), patient."""
    asked = survey.select(survey_key).join(crosswalk, survey_key, "left").select(survey_key, patient)
    own = rows.select(F.lit(None).cast(survey.schema[survey_key].dataType).alias(survey_key), patient)
    return asked.unionByName(own).groupBy(person(survey_key, patient).alias("person")).agg(F.min(survey_key).alias(survey_key), F.min(patient).alias(patient))


def survey_tables(survey: DataFrame, crosswalk: DataFrame, rows: DataFrame, index: DataFrame, survey_key: str, patient: str, period: str, label: object) -> tuple[DataFrame, DataFrame]:
    """A period's patient or visit rows with the survey, found by the crosswalk's survey key, and the de-identified copy.

    Everyone of either side has a row (full outer on the patient), flags of
    membership IN_EPR and IN_ICEES, the period filled in, and the index of the
    person. Survey rows without a patient do not meet at all.
    """
    asked = survey.join(crosswalk, survey_key, "left").withColumn("IN_EPR", F.lit(1))
    met = asked.where(F.col(patient).isNotNull()).join(rows.withColumn("IN_ICEES", F.lit(1)), patient, "full")
    every = met.unionByName(asked.where(F.col(patient).isNull()), allowMissingColumns=True)
    every = every.fillna(0, ["IN_EPR", "IN_ICEES"]).withColumn(period, F.coalesce(period, F.lit(label)))
    named = every.withColumn("person", person(survey_key, patient)).join(index, "person").drop("person")
    return named, named.drop(survey_key, patient)
