"""Queries on bundles: the given tables are written as bundle text and parsed again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.operators import bundles, mapping
from vitalair.plans import views
from vitalair.plans.catalog import query
from vitalair.sources import tables


def _json(kind: str, *fields) -> F.Column:
    return F.struct(F.lit(kind).alias("resourceType"), *fields)


def _patient_text(spark, sf, year: int = 2010) -> DataFrame:
    """One bare resource a patient; in 2011 some have another gender and a further race."""
    p, k = views.patients(spark, sf).repartition("patient_num"), F.col("patient_num")  # few splits hold many patients; texts are made in many tasks
    gender = F.when((k % 13 == 0) & F.lit(year == 2011), "other").otherwise(F.col("gender"))
    race = F.when((k % 5 == 0) & F.lit(year == 2011), "2028-9").otherwise(F.col("race"))
    direct = k % 2 == 0
    kind = lambda url, c: F.struct(F.lit(url).alias("url"), F.when(direct, c).alias("valueString"), F.when(~direct, F.array(F.struct(F.lit("x").alias("url"), c.alias("valueString")))).alias("extension"))
    ext = F.filter(F.array(kind(bundles.RACE_URLS[1], race), F.when(k % 4 < 2, kind(bundles.ETHNICITY_URLS[0], F.lit("2135-2")))), lambda x: x.isNotNull())
    place = F.array(F.struct(F.lit("Latitude").alias("url"), F.col("lat").alias("valueDecimal")), F.struct(F.lit("longitude").alias("url"), F.col("lon").alias("valueDecimal")))
    address = F.array(F.struct(F.array(F.struct(place.alias("extension"))).alias("extension")))
    born = F.when(k % 17 != 0, F.col("birth_date").cast("string")).alias("birthDate")
    return p.select(F.to_json(_json("Patient", k.cast("string").alias("id"), born, gender.alias("gender"), ext.alias("extension"), address.alias("address"))).alias("json"))


def _bundle(resource) -> F.Column:
    return F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.array(F.struct(resource.alias("resource"))).alias("entry"))).alias("json")


def visit_text(spark, sf) -> DataFrame:
    e = views.encounters(spark, sf)
    ref = lambda c: F.struct(F.concat(F.lit("Patient/"), F.col(c).cast("string")).alias("reference")).alias("subject")
    start = F.date_format("start_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return e.select(_bundle(_json("Encounter", F.col("encounter_num").cast("string").alias("id"), ref("patient_num"), F.struct(F.col("visit_type").alias("code")).alias("class"), F.struct(start.alias("start")).alias("period"))))


def _lab_text(spark, sf) -> DataFrame:
    """Events as labs: some without system, without time, with text for a number, of an encounter that isn't there."""
    e, k = views.table(spark, sf, "events"), F.col("event_id")
    ref = lambda kind, c: F.struct(F.concat(F.lit(kind + "/"), c.cast("string")).alias("reference"))
    coding = F.struct(F.when(k % 5 != 0, "http://loinc.org").alias("system"), F.when(k % 10 == 0, "99999").otherwise(F.col("event_type")).alias("code"))
    when = F.date_format("ts", "yyyy-MM-dd")
    return e.select(_bundle(_json(
        "Observation", k.cast("string").alias("id"), ref("Patient", F.col("user_id")).alias("subject"), ref("Encounter", k * 7 % 20000).alias("context"), F.struct(F.array(coding).alias("coding")).alias("code"),
        F.when(k % 3 != 0, F.struct(F.col("value").alias("value"), F.lit("mg").alias("code"))).alias("valueQuantity"), F.when(k % 3 == 0, F.col("event_type")).alias("valueString"),
        F.struct(F.array(F.struct(F.when(F.col("value") > 50, "H").otherwise("N").alias("code"))).alias("coding")).alias("interpretation"),
        F.when((k % 7 != 0) & (k % 2 == 0), when).alias("effectiveDateTime"), F.when((k % 7 != 0) & (k % 2 == 1), when).alias("issued"),
    )))


_RACE11 = "CASE WHEN patient_num%5=0 THEN '2028-9' ELSE race END"
_VALID = "(event_id%10=0 OR event_id%5<>0) AND event_id%7<>0"


@query("SELECT patient_num::VARCHAR AS id, birth_date::VARCHAR AS birth_date, gender, race, CASE WHEN patient_num%4<2 THEN 'Hispanic' ELSE 'Unknown' END AS ethnicity, lat, lon FROM patients WHERE patient_num%17<>0")
def fh_patients(spark, sf):
    p = bundles.patients(bundles.resources(_patient_text(spark, sf)))
    at = bundles.first_address(p).withColumnRenamed("patient_num", "id")
    return p.select("id", "birth_date", "gender", F.array_join("race", "|").alias("race"), mapping.ethnicity(F.get("ethnicity", F.lit(0))).alias("ethnicity")).join(at, "id")


@query("SELECT 'Patient' AS resource_type, count(*) AS n FROM customer UNION ALL SELECT 'Encounter', count(*) FROM orders UNION ALL SELECT 'Observation', count(*) FROM events")
def fh_resource_counts(spark, sf):
    text = _patient_text(spark, sf).unionAll(visit_text(spark, sf)).unionAll(_lab_text(spark, sf))
    return bundles.counts_by_type(bundles.resources(text))


@query(f"""SELECT event_id::VARCHAR AS id, user_id::VARCHAR AS patient, (event_id*7%20000)::VARCHAR AS encounter, CASE WHEN {_VALID} THEN CASE WHEN event_id%10=0 THEN '99999' ELSE event_type END END AS code,
CASE WHEN event_id%3<>0 THEN value END AS value, CASE WHEN event_id%3=0 THEN event_type END AS text, CASE WHEN value>50 THEN 'H' ELSE 'N' END AS flag, CASE WHEN event_id%7<>0 THEN ts::DATE::VARCHAR END AS time, {_VALID} AS valid FROM events""")
def fh_labs(spark, sf):
    """Labs with their validity: rejects are kept and told apart."""
    o = bundles.coded(bundles.resources(_lab_text(spark, sf)), "Observation")
    return o.select("id", "patient", "encounter", F.when(F.col("valid"), F.get("codings", F.lit(0))["code"]).alias("code"), "value", "text", "flag", "time", "valid")


@query(f""", l AS (SELECT event_id, user_id, o_custkey AS owner FROM events LEFT JOIN orders ON o_orderkey=event_id*7%20000 WHERE {_VALID}),
i AS (SELECT owner AS p, count(*) AS n FROM l WHERE owner IS NOT NULL GROUP BY 1), u AS (SELECT user_id AS p, count(*) AS n FROM l WHERE owner IS NULL GROUP BY 1), v AS (SELECT o_custkey AS p, count(*) AS n FROM orders GROUP BY 1)
SELECT patient_num::VARCHAR AS id, coalesce(v.n,0)::INT AS encounters, coalesce(i.n,0)::INT AS labs_inside, coalesce(u.n,0)::INT AS labs_outside FROM patients LEFT JOIN v ON v.p=patient_num LEFT JOIN i ON i.p=patient_num LEFT JOIN u ON u.p=patient_num WHERE patient_num%17<>0""")
def fh_documents(spark, sf):
    """Patient documents, by the size of their parts."""
    labs = bundles.coded(bundles.resources(_lab_text(spark, sf)), "Observation").where("valid")
    d = bundles.documents(bundles.patients(bundles.resources(_patient_text(spark, sf))), bundles.encounters(bundles.resources(visit_text(spark, sf))), {"lab": labs})
    inside = F.aggregate(F.coalesce("encounter", F.array()), F.lit(0), lambda n, e: n + F.coalesce(F.array_size(e["lab"]), F.lit(0)))
    return d.select("id", F.coalesce(F.array_size("encounter"), F.lit(0)).alias("encounters"), inside.alias("labs_inside"), F.coalesce(F.array_size("lab"), F.lit(0)).alias("labs_outside"))


@query(f"""SELECT patient_num::VARCHAR AS id, birth_date::VARCHAR AS birth_date, gender, CASE WHEN race={_RACE11} THEN race ELSE race||'|'||{_RACE11} END AS race, patient_num%13=0 AND gender<>'other' AS conflict FROM patients WHERE patient_num%17<>0""")
def fh_merged_patients(spark, sf):
    years = {y: bundles.patients(bundles.resources(_patient_text(spark, sf, y))) for y in (2010, 2011)}
    return bundles.merged_patients(years).select("id", "birth_date", "gender", F.array_join("race", "|").alias("race"), "conflict")


def _merged(spark, sf) -> str:
    """The folder of patients merged year by year."""
    path = tables.shared_folder(spark, "merged")
    for y in (2010, 2011):
        bundles.merge_into(spark, path, bundles.patients(bundles.resources(_patient_text(spark, sf, y))), y)
    return path


@query(f"""SELECT patient_num::VARCHAR AS id, birth_date::VARCHAR AS birth_date, gender, CASE WHEN race={_RACE11} THEN race ELSE race||'|'||{_RACE11} END AS race, 2010::INT AS since FROM patients WHERE patient_num%17<>0""")
def fh_merged_by_year(spark, sf):
    """Yearly extracts merged one after the other into stored patients."""
    return spark.read.parquet(f"{_merged(spark, sf)}/patients").select("id", "birth_date", "gender", F.array_join("race", "|").alias("race"), F.col("gender_year").alias("since"))


@query("SELECT patient_num::VARCHAR AS id, 'gender' AS field, gender AS kept, 'other' AS other, 2010::INT AS kept_year, 2011::INT AS year FROM patients WHERE patient_num%17<>0 AND patient_num%13=0 AND gender<>'other'")
def fh_merge_conflicts(spark, sf):
    """What extracts said of a patient beside what was kept."""
    return spark.read.parquet(f"{_merged(spark, sf)}/conflicts").select("id", "field", "kept", "other", "kept_year", "year")


@query("""SELECT CASE event_id%3 WHEN 0 THEN 'Condition' WHEN 1 THEN 'MedicationRequest' ELSE 'Procedure' END AS kind, event_id::VARCHAR AS id, user_id::VARCHAR AS patient, CASE WHEN event_id%11<>0 THEN event_type END AS code,
CASE WHEN event_id%7<>0 THEN strftime(ts, '%Y-%m-%d') END AS time, (event_id%11<>0 AND (event_id%3=1 OR event_id%7<>0)) AS valid FROM events""")
def fh_coded_kinds(spark, sf):
    """Conditions, medications and procedures: some without system, some without their time."""
    e, k = views.table(spark, sf, "events"), F.col("event_id")
    ref = F.struct(F.concat(F.lit("Patient/"), F.col("user_id").cast("string")).alias("reference")).alias("subject")
    coding = F.struct(F.array(F.struct(F.when(k % 11 != 0, "http://snomed.info/sct").alias("system"), F.col("event_type").alias("code"))).alias("coding"))
    when = F.when(k % 7 != 0, F.date_format("ts", "yyyy-MM-dd"))
    own = {
        "Condition": [coding.alias("code"), when.alias("recordedDate")], "Procedure": [coding.alias("code"), when.alias("performedDateTime")],
        "MedicationRequest": [coding.alias("medicationCodeableConcept"), F.struct(F.struct(when.alias("start")).alias("validityPeriod")).alias("dispenseRequest")],
    }
    out = None
    for kind, at in (("Condition", 0), ("MedicationRequest", 1), ("Procedure", 2)):
        text = e.where(k % 3 == at).select(_bundle(_json(kind, k.cast("string").alias("id"), ref, *own[kind])))
        read = bundles.coded(bundles.resources(text), kind).select(F.lit(kind).alias("kind"), "id", "patient", F.get("codings", F.lit(0))["code"].alias("code"), "time", "valid")
        out = read if out is None else out.unionByName(read)
    return out


@query("SELECT patient_num, CASE WHEN lat IS NULL THEN 'no address' WHEN patient_num%9=0 THEN 'several latitudes' WHEN patient_num%10=0 THEN 'no longitude' END AS reason FROM patients")
def fh_address_reasons(spark, sf):
    k = F.col("patient_num")
    lats = F.when(F.col("lat").isNull(), 0).when(k % 9 == 0, 2).otherwise(1)
    lons = F.when(F.col("lat").isNull(), 0).when((k % 10 == 0) & (k % 9 != 0), 0).otherwise(1)
    return views.patients(spark, sf).select("patient_num", bundles.address_reason(lats, lons).alias("reason"))


_POUND = "1/0.45359237"


@query(f"""SELECT patient_num, round(CASE patient_num%4 WHEN 0 THEN 20.0+patient_num%15 WHEN 1 THEN (60.0+patient_num%40)*{_POUND}/pow((150.0+patient_num%40)/2.54,2)*703 WHEN 2 THEN (130.0+patient_num%90)/pow(60.0+patient_num%14,2)*703 ELSE -1 END,6) AS bmi FROM patients""")
def mp_body_mass(spark, sf):
    k = F.col("patient_num")
    row = lambda code, v, unit: F.struct(F.lit(code).alias("code"), v.cast("double").alias("value"), F.lit(unit).alias("unit"))
    rows = (
        F.when(k % 4 == 0, F.array(row(mapping.BMI, 20 + k % 15, "kg/m2"))).when(k % 4 == 1, F.array(row(mapping.WEIGHT, 60 + k % 40, "kg"), row(mapping.HEIGHT, 150 + k % 40, "cm")))
        .when(k % 4 == 2, F.array(row(mapping.WEIGHT, 130 + k % 90, "[lb_av]"), row(mapping.HEIGHT, 60 + k % 14, "[in_i]"))).otherwise(F.array(row(mapping.WEIGHT, k, "stone")))
    )
    m = views.patients(spark, sf).select("patient_num", F.explode(rows).alias("m")).select("patient_num", "m.*")
    return mapping.body_mass_index(m, ["patient_num"], "code", "value", "unit", ["code", "value"]).withColumn("bmi", F.round("bmi", 6))


_PANEL = {"click": "wbc", "view": "hct", "purchase": "plt"}


@query("SELECT cell, " + ", ".join(f"count(*) FILTER (measure='{k}') AS {n}_n, arg_min(value, (ts, value)) FILTER (measure='{k}') AS {n}_first, arg_max(value, (ts, value)) FILTER (measure='{k}') AS {n}_last" for k, n in _PANEL.items()) + f" FROM readings WHERE measure IN {tuple(_PANEL)} GROUP BY 1")
def mp_lab_panel(spark, sf):
    return mapping.lab_panel(views.readings(spark, sf), ["cell"], "measure", "value", ["ts", "value"], _PANEL)


@query("SELECT DISTINCT concept_cd, CASE WHEN concept_cd LIKE 'PROMO%' THEN 'glob' WHEN concept_cd='ECONOMY.7' THEN 'plain' WHEN regexp_full_match(concept_cd, 'S.*[.]1[0-9]') THEN 'regex' END AS hit FROM observations")
def mp_patterns(spark, sf):
    c = F.col("concept_cd")
    hit = F.when(c.rlike(mapping.anchored("PROMO*")), "glob").when(c.rlike(mapping.anchored("ECONOMY.7", False)), "plain").when(c.rlike(mapping.anchored("S.*[.]1[0-9]", True)), "regex")
    return views.observations(spark, sf).select("concept_cd").distinct().withColumn("hit", hit)


@query("SELECT p_partkey, CASE WHEN p_partkey%4=0 THEN p_type WHEN p_partkey%3=0 THEN p_size::VARCHAR ELSE p_size||' mg' END AS text, CASE WHEN p_partkey%4<>0 AND p_partkey%3<>0 THEN p_size END AS checked FROM part")
def mp_values_and_units(spark, sf):
    k = F.col("p_partkey")
    value, unit = F.when(k % 4 != 0, F.col("p_size")), F.when(k % 3 != 0, "mg")
    return views.table(spark, sf, "part").select("p_partkey", mapping.value_text(value, unit, F.col("p_type")).alias("text"), mapping.in_unit(value, unit, F.lit("mg")).alias("checked"))


@query("SELECT p_brand AS code, p_name AS name FROM part UNION ALL SELECT p_type, p_name FROM part")
def mp_code_list(spark, sf):
    lines = views.table(spark, sf, "part").select(F.concat("p_name", F.lit("\t"), "p_brand", F.lit(","), "p_type", F.lit(",")).alias("line"))
    return mapping.code_list(lines, "line")


@query("SELECT DISTINCT encounter_num, split_part(concept_cd,'.',1) AS concept_cd FROM observations WHERE (concept_cd LIKE 'PROMO%' OR concept_cd LIKE 'STANDARD%') AND concept_cd<>'PROMO.7'")
def mp_codes_with_prefix(spark, sf):
    return mapping.codes_with_prefix(views.observations(spark, sf), ["encounter_num"], "concept_cd", ["PROMO", "STANDARD"], ["PROMO.7"])


@query("SELECT patient_num, CASE patient_num%3 WHEN 0 THEN 'Hispanic' WHEN 1 THEN 'Not Hispanic' ELSE 'Unknown' END AS ethnicity FROM patients")
def mp_ethnicity(spark, sf):
    code = F.element_at(F.array(F.lit("2135-2"), F.lit("2186-5"), F.lit("other")), (F.col("patient_num") % 3 + 1).cast("int"))
    return views.patients(spark, sf).select("patient_num", mapping.ethnicity(code).alias("ethnicity"))


@query(f"""SELECT 'Observation' AS kind, count(*) AS n, count(*) FILTER (NOT ({_VALID})) AS rejected FROM events""")
def fh_rejects(spark, sf):
    """How many resources of a kind are rejected."""
    return bundles.reject_counts({"Observation": bundles.coded(bundles.resources(_lab_text(spark, sf)), "Observation")})


@query("SELECT y::INT AS year, event_id::VARCHAR AS id, user_id::VARCHAR AS patient FROM events, (VALUES (2010), (2011)) t(y) WHERE y = 2010 OR event_id % 2 = 0")
def fh_yearly_resources(spark, sf):
    """Labs of yearly extracts as one table under their year."""
    labs = bundles.coded(bundles.resources(_lab_text(spark, sf)), "Observation")
    return bundles.yearly({2010: labs, 2011: labs.where("cast(id as long) % 2 = 0")}).select("year", "id", "patient")


@query("SELECT patient_num::VARCHAR AS id, birth_date::VARCHAR AS birth_date, gender, coalesce(n,0)::INT AS encounters FROM patients LEFT JOIN (SELECT o_custkey AS patient_num, count(*) AS n FROM orders GROUP BY 1) USING (patient_num) WHERE patient_num%17<>0")
def fh_stored_documents(spark, sf):
    """Bundle files are read, patient documents written as lines of JSON and read again."""
    path = tables.shared_folder(spark, "bundles")
    _patient_text(spark, sf).select(F.col("json").alias("value")).write.text(f"{path}/Patient")
    visit_text(spark, sf).select(F.col("json").alias("value")).write.text(f"{path}/Encounter")
    read = lambda kind: bundles.resources(tables.read_text(spark, f"{path}/{kind}"))
    d = bundles.documents(bundles.patients(read("Patient")), bundles.encounters(read("Encounter")), {})
    tables.write_documents(d, f"{path}/documents")
    return tables.read_documents(spark, f"{path}/documents", d.schema).select("id", "birth_date", "gender", F.coalesce(F.array_size("encounter"), F.lit(0)).alias("encounters"))
