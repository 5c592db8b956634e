"""Patient tables per study period, and the binning and de-identification of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalair.operators.quantiles import exact_quantiles
from vitalair.operators.visits import age_years


def any_feature(features: list[str], present: list[str]) -> Column:
    """Whether one of the features that are present is 1; true where none is named."""
    if not features:
        return F.lit(True)
    hit = F.lit(False)
    for f in features:
        if f in present:
            hit = hit | F.coalesce(F.col(f) == 1, F.lit(False))
    return hit


def patient_table(visits: DataFrame, patient: str, period: str, order: list[str], first: list[str], sums: list[str], labs: list[str], flag: list[str], study_start: str, oldest: int = 90) -> DataFrame:
    """One row a patient and study period, of patients younger than `oldest` at the start of the study.

    Columns of `first` have the value of the first visit by order, features of
    `sums` are summed (absent ones 0), of lab columns `x_first` the first and of
    `x_last` the last value that is there stay. ObesityBMI is the largest flag of
    the visits. Visits count by type (a bar-joined list) among those that have one
    of the `flag` features: ED (AMB or EMER), inpatient (IMP), and both without
    counting one twice. Needs birth_date, VisitType and ObesityBMIVisit.
    """
    own = visits.withColumn("RespiratoryDx", any_feature(flag, visits.columns))
    ed = F.col("VisitType").contains("AMB") | F.col("VisitType").contains("EMER")
    inpatient = F.col("VisitType").contains("IMP")
    n = lambda c: F.count_if(F.col("RespiratoryDx") & F.coalesce(c, F.lit(False)))
    at = F.struct(*order)
    out = [F.min_by(c, at).alias(c) for c in ["birth_date", *first]]
    out += [(F.coalesce(F.sum(c), F.lit(0)) if c in visits.columns else F.lit(0)).cast("int").alias(c) for c in sums]
    known = lambda c: F.when(F.col(c).isNotNull(), at)
    out += [(F.max_by if c.endswith("_last") else F.min_by)(c, known(c)).alias(c) for c in labs if c in visits.columns]
    out += [F.coalesce(F.max("ObesityBMIVisit"), F.lit(0)).cast("int").alias("ObesityBMI"), F.bool_or("RespiratoryDx").cast("int").alias("RespiratoryDx")]
    out += [n(ed).alias("TotalEDVisits"), n(inpatient).alias("TotalInpatientVisits"), n(ed | inpatient).alias("TotalEDInpatientVisits")]
    table = own.groupBy(patient, period).agg(*out).withColumn("AgeStudyStart", age_years(F.col("birth_date"), F.lit(study_start).cast("date")))
    return table.where(F.col("AgeStudyStart") < oldest)


def published(patients: DataFrame, names: dict[str, str]) -> DataFrame:
    """Exposure columns under their published names, empty ones where the table has none; all other columns first, raw names go."""
    own = [(F.col(c).cast("double") if c in patients.columns else F.lit(None).cast("double")).alias(n) for c, n in names.items()]
    return patients.select(*[c for c in patients.columns if c not in names], *own)


def bin_edges(df: DataFrame, period: str, columns: list[str], n: int) -> DataFrame:
    """(period, name, method, edges): edges of n bins by quantiles (qcut; null if two agree) and of equal width (cut; the first lowered by 0.1 % of the range).

    All columns are taken at once: one long table, summed up by value.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.select(period, F.expr(f"stack({len(columns)}, {pairs}) AS (name, value)")).where("value is not null")
    q = exact_quantiles(long, [period, "name"], "value", [i / n for i in range(n + 1)])
    same = F.size(F.array_distinct("quantiles")) <= n
    span = F.element_at("quantiles", -1) - F.get("quantiles", 0)
    width = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.get("quantiles", 0) + span * i / n - F.when(i == 0, span * 0.001).otherwise(0.0))
    methods = F.array(F.struct(F.lit("qcut").alias("method"), F.when(~same, F.col("quantiles")).alias("edges")), F.struct(F.lit("cut").alias("method"), width.alias("edges")))
    return q.select(period, "name", F.explode(methods).alias("m")).select(period, "name", "m.*")


def with_bins(df: DataFrame, period: str, columns: list[str], edges: DataFrame, drop: list[str] = ()) -> DataFrame:
    """Columns `c_qcut` and `c` (equal width) of bins from 1, right-closed, by the edges of each row's period; `drop` goes.

    The edges of a period are one row: two short arrays a column.
    """
    wide = edges.groupBy(period).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "name", "method"), "edges"))).alias("_edges"))
    met = df.join(wide, period, "left")

    def bin_of(c: str, method: str) -> Column:
        e = F.try_element_at("_edges", F.lit(f"{c} {method}"))
        inner = F.slice(e, 2, F.size(e) - 2)
        return F.when(F.col(c).isNotNull() & e.isNotNull(), 1 + F.size(F.filter(inner, lambda x: F.col(c) > x)))

    met = met.withColumns({f"{c}_qcut": bin_of(c, "qcut") for c in columns}).withColumns({c: bin_of(c, "cut") for c in columns})
    return met.drop("_edges", *drop)


def deidentified_patients(patients: DataFrame, index: DataFrame, patient: str, rename: dict[str, str]) -> DataFrame:
    """The table with the patients' index first and ordered by it, without birth date and patient; names changed."""
    met = patients.drop("birth_date").join(index, patient, "left").withColumnsRenamed(rename)
    return met.select("index", *[c for c in met.columns if c not in ("index", patient)]).orderBy("index")


def deidentified_visits(visits: DataFrame, patient: str) -> DataFrame:
    return visits.drop("birth_date", patient)
