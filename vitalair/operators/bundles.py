"""Health-record bundles: JSON text to typed tables, rejects, patient documents, merging of yearly extracts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.sources.tables import stored

#: Addresses of the extensions that hold race, ethnicity and coordinates.
RACE_URLS = ["http://terminology.hl7.org/ValueSet/v3-Race", "http://hl7.org/fhir/v3/Race"]
ETHNICITY_URLS = ["http://terminology.hl7.org/ValueSet/v3-Ethnicity", "http://hl7.org/fhir/v3/Ethnicity"]

_CODED = "struct<coding array<struct<system string, code string, display string>>>"
_REF = "struct<reference string>"
_RESOURCE = f"""struct<resourceType string, id string, birthDate string, gender string,
  extension array<struct<url string, valueString string, extension array<struct<url string, valueString string>>>>,
  address array<struct<extension array<struct<extension array<struct<url string, valueDecimal double>>>>>>,
  class struct<system string, code string, display string>, period struct<start string, `end` string>,
  subject {_REF}, context {_REF}, encounter {_REF}, code {_CODED}, medicationCodeableConcept {_CODED}, interpretation {_CODED},
  valueQuantity struct<value double, code string>, valueString string, recordedDate string, effectiveDateTime string, issued string,
  authoredOn string, performedDateTime string, dispenseRequest struct<validityPeriod struct<start string, `end` string>>>"""
_BARE = _RESOURCE.replace("struct<resourceType string,", "struct<resourceType string, entry array<struct<resource RES>>,", 1).replace("RES", _RESOURCE, 1)


def resources(text: DataFrame, json: str = "json") -> DataFrame:
    """(r, position) per resource of each text: the entries of a bundle, or one bare resource. Broken JSON gives r null."""
    parsed = text.withColumn("_b", F.from_json(json, _BARE[7:-1]))
    entries = F.when(F.col("_b.entry").isNotNull(), F.transform("_b.entry", lambda e: e["resource"])).otherwise(F.array(F.from_json(json, _RESOURCE[7:-1])))
    return parsed.select(*[c for c in text.columns if c != json], F.posexplode(entries).alias("position", "r"))


def counts_by_type(res: DataFrame) -> DataFrame:
    return res.groupBy(F.col("r.resourceType").alias("resource_type")).agg(F.count("*").alias("n"))


def reference_id(reference: Column) -> Column:
    """`Patient/x` -> x."""
    return F.get(F.split(reference, "/"), F.lit(1))


def coded_values(extensions: Column, urls: list[str]) -> Column:
    """Values of the extensions with one of the urls: their own, then those one level below."""
    own = F.filter(extensions, lambda e: e["url"].isin(*urls))
    below = lambda e: F.transform(F.coalesce(e["extension"], F.array()), lambda x: x["valueString"])
    values = F.flatten(F.transform(own, lambda e: F.concat(F.array(e["valueString"]), below(e))))
    return F.coalesce(F.filter(values, lambda v: v.isNotNull()), F.array().cast("array<string>"))


def coordinates(address: Column) -> Column:
    """array<struct<lat, lon>> of the address extensions that have both."""
    outer = F.flatten(F.transform(address, lambda a: F.coalesce(a["extension"], F.array())))
    pick = lambda x, name: F.get(F.filter(F.coalesce(x["extension"], F.array()), lambda y: F.lower(y["url"]) == name), F.lit(0))["valueDecimal"]
    both = F.transform(outer, lambda x: F.struct(pick(x, "latitude").alias("lat"), pick(x, "longitude").alias("lon")))
    return F.coalesce(F.filter(both, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()), F.array().cast("array<struct<lat double, lon double>>"))


def patients(res: DataFrame) -> DataFrame:
    """Patients with an id and a birth date."""
    p = res.where("r.resourceType = 'Patient' and r.id is not null and r.birthDate is not null")
    return p.select(
        F.col("r.id").alias("id"), F.col("r.birthDate").alias("birth_date"), F.coalesce("r.gender", F.lit("Unknown")).alias("gender"),
        coded_values(F.col("r.extension"), RACE_URLS).alias("race"), coded_values(F.col("r.extension"), ETHNICITY_URLS).alias("ethnicity"), coordinates(F.col("r.address")).alias("address"),
    )


def encounters(res: DataFrame) -> DataFrame:
    e = res.where("r.resourceType = 'Encounter' and r.id is not null and r.subject.reference is not null")
    return e.select(F.col("r.id").alias("id"), reference_id(F.col("r.subject.reference")).alias("patient"), F.col("r.class").alias("class"), F.col("r.period.start").alias("start"), F.col("r.period.end").alias("end"))


#: How each kind of coded resource names its codes and its time.
CODED = {
    "Condition": ("r.code.coding", ["r.recordedDate"]),
    "Observation": ("r.code.coding", ["r.effectiveDateTime", "r.issued"]),
    "MedicationRequest": ("r.medicationCodeableConcept.coding", ["r.dispenseRequest.validityPeriod.start"]),
    "Procedure": ("r.code.coding", ["r.performedDateTime"]),
}


def clean_codings(codings: Column) -> Column:
    """Codings with a code; code 99999 has an empty system; null where another coding lacks its system."""
    coded = F.filter(F.coalesce(codings, F.array()), lambda c: c["code"].isNotNull())
    full = F.transform(coded, lambda c: F.struct(F.when(c["code"] == "99999", F.lit("")).otherwise(c["system"]).alias("system"), c["code"].alias("code")))
    return F.when(~F.exists(full, lambda c: c["system"].isNull()), full)


def coded(res: DataFrame, kind: str, r4: bool = False) -> DataFrame:
    """All resources of a kind, with `valid`: id, subject, time and clean codings are there. Rejects are those that are not valid.

    With r4 the encounter may stand in `encounter`, and a medication's time in `authoredOn`.
    """
    codes, times = CODED[kind]
    if r4 and kind == "MedicationRequest":
        times = [*times, "r.authoredOn"]
    visit = F.coalesce("r.context.reference", "r.encounter.reference") if r4 else F.col("r.context.reference")
    out = res.where(F.col("r.resourceType") == kind).select(
        F.col("r.id").alias("id"), reference_id(F.col("r.subject.reference")).alias("patient"), reference_id(visit).alias("encounter"),
        clean_codings(F.col(codes)).alias("codings"), F.coalesce(*times).alias("time"), F.col("r.valueQuantity.value").alias("value"), F.col("r.valueQuantity.code").alias("unit"),
        F.col("r.valueString").alias("text"), F.get(F.col("r.interpretation.coding"), F.lit(0))["code"].alias("flag"),
    )
    needed = [F.col(c).isNotNull() for c in ("id", "patient", "codings", *([] if kind == "MedicationRequest" and not r4 else ["time"]))]
    ok = needed[0]
    for c in needed[1:]:
        ok = ok & c
    return out.withColumn("valid", ok)


def routed(items: DataFrame, visits: DataFrame) -> DataFrame:
    """Items whose encounter is unknown belong to the patient: their encounter becomes null."""
    known = visits.select(F.col("id").alias("_known")).distinct()
    return items.join(known, F.col("encounter") == F.col("_known"), "left").withColumn("encounter", F.col("_known")).drop("_known")


def documents(pats: DataFrame, visits: DataFrame, items: dict[str, DataFrame]) -> DataFrame:
    """One nested row a patient: encounters with the items that belong to them, and under each name the items without encounter.

    Items of one patient are gathered in one row, as the document is the result.
    """
    held = visits.withColumnRenamed("patient", "_p")
    loose = pats
    for name, df in items.items():
        body = F.struct("id", "time", "codings", "value", "unit", "text", "flag")
        at = routed(df, visits)
        inside = at.where("encounter is not null").groupBy(F.col("encounter").alias("id")).agg(F.array_sort(F.collect_list(body)).alias(name))
        outside = at.where("encounter is null").groupBy(F.col("patient").alias("id")).agg(F.array_sort(F.collect_list(body)).alias(name))
        held, loose = held.join(inside, "id", "left"), loose.join(outside, "id", "left")
    own = held.groupBy(F.col("_p").alias("id")).agg(F.array_sort(F.collect_list(F.struct("id", "start", "end", "class", *items))).alias("encounter"))
    return loose.join(own, "id", "left")


def first_address(pats: DataFrame) -> DataFrame:
    one = F.get("address", F.lit(0))
    return pats.select(F.col("id").alias("patient_num"), one["lat"].alias("lat"), one["lon"].alias("lon"))


def merged_patients(extracts: dict[int, DataFrame]) -> DataFrame:
    """One row a patient over yearly extracts, lists united in the order of the years; `conflict` where birth dates or genders differ."""
    rows = None
    for year, df in sorted(extracts.items()):
        own = df.withColumn("year", F.lit(year))
        rows = own if rows is None else rows.unionByName(own)
    in_order = lambda c: F.array_sort(F.collect_list(F.struct("year", F.col(c).alias("v"))))
    lists = [F.array_distinct(F.flatten(F.transform(in_order(c), lambda x: x["v"]))).alias(c) for c in ("race", "ethnicity", "address")]
    first = [F.min_by(c, F.struct("year", c)).alias(c) for c in ("birth_date", "gender")]
    conflict = (F.min("birth_date") != F.max("birth_date")) | (F.min("gender") != F.max("gender"))
    return rows.groupBy("id").agg(*first, *lists, conflict.alias("conflict"))


FIELDS, LISTS = ("birth_date", "gender"), ("race", "ethnicity", "address")


def _year_rows(extract: DataFrame, year: int) -> DataFrame:
    """A row a patient of one extract: the different values of each field, and its lists one after the other."""
    values = [F.array_sort(F.collect_set(c)).alias(f"_{c}") for c in FIELDS]
    lists = [F.array_distinct(F.flatten(F.array_sort(F.collect_list(c)))).alias(f"_{c}") for c in LISTS]
    return extract.groupBy("id").agg(*values, *lists).withColumn("_year", F.lit(year))


def merged_year(known: DataFrame | None, extract: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    """(patients, conflicts) after one more yearly extract.

    patients: id, fields with the year they come from (`<field>_year`), lists united
    in order. The first value of a field stays; each later one that differs is a row
    of conflicts: id, field, kept, other, kept_year, year. Years are merged in order.
    """
    return _merged(_met(known, _year_rows(extract, year), extract), extract, year)


def _met(known: DataFrame | None, own: DataFrame, extract: DataFrame) -> DataFrame:
    """Known patients and a year's rows, side by side."""
    if known is not None:
        return known.join(own, "id", "full")
    none = {c: F.lit(None).cast(t) for f in FIELDS for c, t in ((f, extract.schema[f].dataType), (f"{f}_year", "int"))}
    return own.withColumns(none | {c: F.lit(None).cast(extract.schema[c].dataType) for c in LISTS})


def _merged(met: DataFrame, extract: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    kept = {c: F.coalesce(c, F.get(f"_{c}", F.lit(0))) for c in FIELDS}
    since = {f"{c}_year": F.when(F.col(c).isNotNull(), F.col(f"{c}_year")).when(F.size(f"_{c}") > 0, F.col("_year")) for c in FIELDS}
    united = {c: F.array_union(F.coalesce(c, F.array().cast(extract.schema[c].dataType)), F.coalesce(f"_{c}", F.array().cast(extract.schema[c].dataType))) for c in LISTS}
    patients = met.select("id", *[x.alias(n) for n, x in (kept | since | united).items()])

    def differing(c: str) -> Column:
        row = lambda v: F.named_struct(F.lit("field"), F.lit(c), F.lit("kept"), kept[c].cast("string"), F.lit("other"), v.cast("string"), F.lit("kept_year"), since[f"{c}_year"])
        return F.transform(F.filter(f"_{c}", lambda v: v != kept[c]), row)

    rows = [differing(c) for c in FIELDS]
    conflicts = met.where(F.col("_year").isNotNull()).select("id", F.explode(F.concat(*rows)).alias("c"), F.lit(year).alias("year")).select("id", "c.*", "year")
    return patients, conflicts


def merge_into(spark: SparkSession, path: str, extract: DataFrame, year: int, parts: int = 64) -> None:
    """Merge one more year into the patients stored under path, and write the year's conflicts.

    Patients lie in folders by a hash of their id. Only folders with patients of the
    extract are read and replaced. The extract is read once, and the rows that meet
    are stored before any folder is replaced, so a run that breaks off can be repeated.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    own = stored(_year_rows(extract, year).select("*", part), "year")  # the extract is read once
    try:
        known = spark.read.parquet(f"{path}/patients")
    except AnalysisException:  # the first year
        known = None
    if known is not None:
        touched = [r[0] for r in own.select("part").distinct().collect()]  # `parts` numbers at most
        known = known.where(F.col("part").isin(touched)).drop("part")
    met = stored(_met(known, own.drop("part"), extract), "met")
    patients, conflicts = _merged(met, extract, year)
    conflicts.write.mode("overwrite").parquet(f"{path}/conflicts/year={year}")
    patients.select("*", part).repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{path}/patients")


def address_reason(lats: Column, lons: Column) -> Column:
    """Why a patient's place is unusable; null if there is exactly one latitude and one longitude."""
    return (
        F.when((lats == 0) & (lons == 0), "no address").when(lats == 0, "no latitude").when(lons == 0, "no longitude")
        .when(lats > 1, "several latitudes").when(lons > 1, "several longitudes")
    )


def reject_counts(kinds: dict[str, DataFrame]) -> DataFrame:
    """(kind, n, rejected) of coded resources by kind."""
    out = None
    for kind, items in kinds.items():
        own = items.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("rejected"))
        out = own if out is None else out.unionByName(own)
    return out


def yearly(extracts: dict[int, DataFrame]) -> DataFrame:
    """Resources of yearly extracts as one table, each row under its year; columns that an extract lacks are null."""
    out = None
    for year, df in extracts.items():
        own = df.withColumn("year", F.lit(year))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out
