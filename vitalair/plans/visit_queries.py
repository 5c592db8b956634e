"""Queries: visit vectors, patient tables, binning and de-identification of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.operators import binning, bundles, names, patient_tables, visit_vectors, visits
from vitalair.plans import views
from vitalair.plans.bundle_queries import visit_text
from vitalair.plans.catalog import query
from vitalair.sources import tables

#: The study window and patterns on systems and codes.
START, END, OFFSET = "1996-01-01", "2000-01-01", -5
PATTERNS = [
    {"feature": "promo", "system": "A|N", "system_is_regex": True, "code": "PROMO*"},
    {"feature": "small", "system": "*", "code": r".*\.(1|2|3)", "code_is_regex": True},
    {"feature": "economy7", "system": "A", "system_is_regex": False, "code": "ECONOMY.7", "code_is_regex": False},
]
FEATURES = ["economy7", "promo", "small"]
_FITS = {
    "promo": "regexp_full_match(system, 'A|N') AND regexp_full_match(code, 'PROMO.*')",
    "small": r"regexp_full_match(code, '.*\.(1|2|3)')",
    "economy7": "system = 'A' AND code = 'ECONOMY.7'",
}

_VISITS = """, v AS (SELECT encounter_num, patient_num, CASE WHEN encounter_num%4<>0 THEN start_date END AS start_date, visit_type FROM encounters),
items AS (SELECT e.patient_num, CASE WHEN instance_num%5<>0 THEN o.encounter_num END AS encounter_num, o.modifier_cd AS kind, o.start_date AS instant, o.modifier_cd AS system, o.concept_cd AS code, nval_num AS value, instance_num,
  CASE WHEN nval_num>40 THEN 'H' WHEN nval_num<10 THEN 'L' END AS flag FROM observations o JOIN encounters e USING (encounter_num)),
f AS (SELECT encounter_num, min(instant) FILTER (kind='A') AS a, min(instant) FILTER (kind='N') AS n, min(instant) FILTER (kind='R') AS r FROM items WHERE encounter_num IS NOT NULL GROUP BY 1),
ev AS (SELECT v.encounter_num, v.patient_num, visit_type, coalesce(v.start_date, a, n, r) AS start_date FROM v LEFT JOIN f USING (encounter_num)),
"""
_WINDOW = f"start_date >= timestamp '{START}' AND start_date < timestamp '{END}'"
_VISITS += f"""w AS (SELECT * FROM ev WHERE {_WINDOW}),
placed AS (SELECT w.patient_num, w.start_date, i.* EXCLUDE (patient_num) FROM items i JOIN w ON i.encounter_num = w.encounter_num
  UNION ALL SELECT patient_num, instant AS start_date, items.* EXCLUDE (patient_num) FROM items WHERE encounter_num IS NULL AND instant >= timestamp '{START}' AND instant < timestamp '{END}')"""


def _visits(spark, sf) -> DataFrame:
    e = views.encounters(spark, sf)
    return e.select("encounter_num", "patient_num", F.when(F.col("encounter_num") % 4 != 0, F.col("start_date")).alias("start_date"), "visit_type")


def _items(spark, sf) -> DataFrame:
    """Facts as coded items; every fifth belongs to no encounter."""
    o = views.observations(spark, sf).withColumnRenamed("start_date", "instant").join(views.encounters(spark, sf).select("encounter_num", "patient_num"), "encounter_num")
    own = F.when(F.col("instance_num") % 5 != 0, F.col("encounter_num")).alias("encounter_num")
    flag = F.when(F.col("nval_num") > 40, "H").when(F.col("nval_num") < 10, "L").alias("flag")
    return o.select("patient_num", own, F.col("modifier_cd").alias("kind"), "instant", F.col("modifier_cd").alias("system"), F.col("concept_cd").alias("code"), F.col("nval_num").alias("value"), "instance_num", flag)


def _started(spark, sf) -> DataFrame:
    return visit_vectors.effective_starts(_visits(spark, sf), _items(spark, sf), "encounter_num", "start_date", ["A", "N", "R"])


def _placed(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Visits of the window, and items at their visits or as visits of their own."""
    own = _started(spark, sf).where(visit_vectors.in_window(F.col("start_date"), START, END))
    at = visit_vectors.visit_items(own, _items(spark, sf), "patient_num", "encounter_num", "start_date")
    return own, at.where(visit_vectors.in_window(F.col("start_date"), START, END))


@query(f"{_VISITS} SELECT encounter_num, start_date, ({_WINDOW}) AS in_study FROM ev WHERE start_date IS NOT NULL")
def vv_effective_start(spark, sf):
    s = _started(spark, sf)
    return s.select("encounter_num", "start_date", visit_vectors.in_window(F.col("start_date"), START, END).alias("in_study"))


_MAPPED = " UNION ALL ".join(f"SELECT system, code, '{f}' AS feature FROM c WHERE {x}" for f, x in _FITS.items())


@query(f", c AS (SELECT DISTINCT modifier_cd AS system, concept_cd AS code FROM observations) {_MAPPED}")
def mp_coding_features(spark, sf):
    return visit_vectors.coding_features(views.observations(spark, sf).select(F.col("modifier_cd").alias("system"), F.col("concept_cd").alias("code")), "system", "code", PATTERNS)


_PARTS = "c AS (SELECT DISTINCT p_brand AS system, p_type||'.'||p_partkey||'.'||p_size AS code FROM part), p AS (SELECT *, p_type||'.'||p_partkey AS start FROM part)"


@query(f""", {_PARTS}, h AS (SELECT system, code, 'g'||p_partkey AS feature FROM p JOIN c ON p_partkey%3=0 AND starts_with(code, start)
UNION ALL SELECT system, code, 'r'||p_partkey FROM p JOIN c ON p_partkey%3=1 AND system=p_brand AND starts_with(code, start) WHERE regexp_full_match(substr(code, length(start)+1), '[0-9]{{0,2}}\\.[123][0-9]?')
UNION ALL SELECT system, code, 'x'||p_partkey FROM p JOIN c ON p_partkey%3=2 AND code=start||'.'||p_size WHERE regexp_full_match(system, 'Brand#[1-3].*')) SELECT * FROM h""")
def mp_pattern_index(spark, sf):
    """As many patterns as parts: a third with a wildcard, a third regular expressions, a third whole codes."""
    k, part = F.col("p_partkey"), views.table(spark, sf, "part")
    start = F.concat_ws(".", "p_type", k.cast("string"))
    by = lambda a, b, c: F.when(k % 3 == 0, a).when(k % 3 == 1, b).otherwise(c)
    patterns = part.select(
        F.concat(by(F.lit("g"), F.lit("r"), F.lit("x")), k.cast("string")).alias("feature"),
        by(F.lit("*"), F.col("p_brand"), F.lit("Brand#[1-3].*")).alias("system"), by(F.lit(None), F.lit(False), F.lit(True)).cast("boolean").alias("system_is_regex"),
        by(F.concat(start, F.lit("*")), F.concat(F.replace(start, F.lit("."), F.lit("\\.")), F.lit(r"\d{0,2}\.[123][0-9]?")), F.concat_ws(".", start, F.col("p_size").cast("string"))).alias("code"),
        by(F.lit(None), F.lit(True), F.lit(False)).cast("boolean").alias("code_is_regex"),
    )
    codings = part.select(F.col("p_brand").alias("system"), F.concat_ws(".", start, F.col("p_size").cast("string")).alias("code"))
    return visit_vectors.coding_features(codings, "system", "code", tables.stored(patterns, "patterns"))


_COUNTS = ", ".join(f"count(*) FILTER ({x}) AS {f}" for f, x in sorted(_FITS.items()))


@query(f"""{_VISITS}, o AS (SELECT patient_num, start_date, string_agg(encounter_num::VARCHAR, '|' ORDER BY encounter_num::VARCHAR) AS encounter_num, array_to_string(list_sort(list_distinct(list(visit_type))), '|') AS visit_type FROM w GROUP BY ALL),
k AS (SELECT patient_num, start_date FROM w UNION SELECT patient_num, start_date FROM placed), c AS (SELECT patient_num, start_date, {_COUNTS} FROM placed GROUP BY ALL)
SELECT patient_num, start_date, coalesce(encounter_num,'') AS encounter_num, coalesce(visit_type,'') AS visit_type, {', '.join(f'coalesce({f},0) AS {f}' for f in FEATURES)}, (start_date - INTERVAL 5 HOURS)::DATE AS day
FROM k LEFT JOIN o USING (patient_num, start_date) LEFT JOIN c USING (patient_num, start_date)""", day="day")
def vv_vectors(spark, sf):
    """Bundles' items to visit vectors: effective starts, pseudo-visits, the study window, merged visits, features, local days."""
    own, at = _placed(spark, sf)
    counts = visit_vectors.coded_counts(at, ["patient_num", "start_date"], "system", "code", PATTERNS, FEATURES)
    return visit_vectors.visit_vectors(own, at, counts, "patient_num", "encounter_num", "start_date", "visit_type", OFFSET)


_LABS = ["promo", "small"]
_LAB_SQL = ", ".join(
    f"count(*) FILTER (feature='{f}') AS {f}_n, arg_min(value, k) FILTER (feature='{f}') AS {f}_value_first, (arg_min({{'f': flag}}, k) FILTER (feature='{f}')).f AS {f}_flag_first, "
    f"arg_max(value, k) FILTER (feature='{f}') AS {f}_value_last, (arg_max({{'f': flag}}, k) FILTER (feature='{f}')).f AS {f}_flag_last, coalesce(bool_or(d) FILTER (feature='{f}'), false) AS {f}_differ"
    for f in _LABS
)
_LAB_ROWS = " UNION ALL ".join(f"SELECT *, '{f}' AS feature FROM placed WHERE {_FITS[f]}" for f in _LABS)


@query(f"""{_VISITS}, l AS ({_LAB_ROWS}), x AS (SELECT *, {{'i': instant, 'n': instance_num, 'v': value, 's': system, 'c': code}} AS k, min(value) OVER p <> max(value) OVER p AS d FROM l WINDOW p AS (PARTITION BY patient_num, start_date, feature, instant))
SELECT patient_num, start_date, {_LAB_SQL} FROM x GROUP BY ALL""")
def vv_lab_features(spark, sf):
    _, at = _placed(spark, sf)
    features = visit_vectors.coding_features(at, "system", "code", [p for p in PATTERNS if p["feature"] in _LABS])
    labs = at.join(features, ["system", "code"])
    return visit_vectors.value_features(labs, ["patient_num", "start_date"], "value", "flag", ["instant", "instance_num", "value", "system", "code"], _LABS)


_YEAR_VISITS = """, c AS (SELECT encounter_num, count(*) FILTER (concept_cd LIKE 'PROMO%')::INT AS promo, (count(*) FILTER (concept_cd LIKE 'ECONOMY%')>0)::INT AS economy, min(nval_num) AS lab_first, max(nval_num) AS lab_last FROM observations GROUP BY 1),
y AS (SELECT e.patient_num, year(e.start_date)::INT AS study_period, e.start_date, e.encounter_num, e.visit_type AS VisitType, p.birth_date, p.race AS Race, p.gender AS Sex, p.lat AS place, ((e.encounter_num%50)>=30)::INT AS ObesityBMIVisit, promo, economy, lab_first, lab_last, o_totalprice AS pm
  FROM encounters e JOIN patients p USING (patient_num) LEFT JOIN c USING (encounter_num) JOIN orders ON o_orderkey=e.encounter_num)"""


def _year_visits(spark, sf) -> DataFrame:
    own = lambda p: F.col("concept_cd").startswith(p)
    c = views.observations(spark, sf).groupBy("encounter_num").agg(
        F.count_if(own("PROMO")).cast("int").alias("promo"), F.bool_or(own("ECONOMY")).cast("int").alias("economy"), F.min("nval_num").alias("lab_first"), F.max("nval_num").alias("lab_last"))
    price = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("encounter_num"), F.col("o_totalprice").alias("pm"))
    p = views.patients(spark, sf).select("patient_num", "birth_date", F.col("race").alias("Race"), F.col("gender").alias("Sex"), F.col("lat").alias("place"))
    e = views.encounters(spark, sf).drop("day").withColumnRenamed("visit_type", "VisitType").withColumn("study_period", F.year("start_date"))
    e = e.withColumn("ObesityBMIVisit", (F.col("encounter_num") % 50 >= 30).cast("int"))
    return e.join(p, "patient_num").join(c, "encounter_num", "left").join(price, "encounter_num")


_PATIENTS = f"""{_YEAR_VISITS}, g AS (SELECT patient_num, study_period, any_value(birth_date) AS birth_date, arg_min({{'x': pm}}, (start_date, encounter_num)).x AS pm, any_value(Race) AS Race, any_value(Sex) AS Sex, any_value(place) AS place, coalesce(sum(promo),0)::INT AS promo,
coalesce(sum(economy),0)::INT AS economy, 0 AS other, arg_min(lab_first, (start_date, encounter_num)) FILTER (lab_first IS NOT NULL) AS lab_first, arg_max(lab_last, (start_date, encounter_num)) FILTER (lab_last IS NOT NULL) AS lab_last, max(ObesityBMIVisit) AS ObesityBMI, max((coalesce(economy,0)=1)::INT) AS RespiratoryDx,
count(*) FILTER (economy=1 AND VisitType IN ('AMB','EMER')) AS TotalEDVisits, count(*) FILTER (economy=1 AND VisitType='IMP') AS TotalInpatientVisits, count(*) FILTER (economy=1) AS TotalEDInpatientVisits FROM y GROUP BY 1,2),
pt AS (SELECT *, date_sub('year', birth_date, date '1995-01-01')::INT AS AgeStudyStart FROM g WHERE date_sub('year', birth_date, date '1995-01-01') < 60)"""


def _patients(spark, sf) -> DataFrame:
    return patient_tables.patient_table(_year_visits(spark, sf), "patient_num", "study_period", ["start_date", "encounter_num"], ["pm", "Race", "Sex", "place"], ["promo", "economy", "other"], ["lab_first", "lab_last"], ["economy", "other"], "1995-01-01", 60)


@query(f"{_PATIENTS} SELECT * FROM pt", day="birth_date")
def in_patient_table(spark, sf):
    """Patients and study periods: flagged visits by type, sums, first and last values, age at the start of the study (here below 60)."""
    return _patients(spark, sf)


_Q = "1+(x.{c}>e.{c}[2])::INT+(x.{c}>e.{c}[3])::INT+(x.{c}>e.{c}[4])::INT+(x.{c}>e.{c}[5])::INT"
_W = "1+(x.{c}>lo_{c}+(hi_{c}-lo_{c})*1/5)::INT+(x.{c}>lo_{c}+(hi_{c}-lo_{c})*2/5)::INT+(x.{c}>lo_{c}+(hi_{c}-lo_{c})*3/5)::INT+(x.{c}>lo_{c}+(hi_{c}-lo_{c})*4/5)::INT"
_EDGES = ", ".join(f"quantile_cont({c}, [0,0.2,0.4,0.6,0.8,1.0]) AS {c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in ("pm", "lab_last"))


@query(f"""{_PATIENTS}, e AS (SELECT study_period, {_EDGES} FROM pt GROUP BY 1), n AS (SELECT study_period, name, unnest([1,2]) AS m, q, lo, hi FROM (SELECT study_period, 'pm' AS name, pm AS q, lo_pm AS lo, hi_pm AS hi FROM e UNION ALL SELECT study_period, 'lab_last', lab_last, lo_lab_last, hi_lab_last FROM e) WHERE lo IS NOT NULL)
SELECT study_period, name, CASE m WHEN 1 THEN 'qcut' ELSE 'cut' END AS method, CASE WHEN m=2 THEN array_to_string([round(lo+(hi-lo)*i/5-CASE WHEN i=0 THEN (hi-lo)*0.001 ELSE 0 END,3)::DECIMAL(20,3)::VARCHAR FOR i IN range(6)], ',')
WHEN len(list_distinct(q))=6 THEN array_to_string([round(x,3)::DECIMAL(20,3)::VARCHAR FOR x IN q], ',') END AS edges FROM n""")
def bn_edges(spark, sf):
    """Edges of quantile and equal-width bins of several columns per study period."""
    e = patient_tables.bin_edges(_patients(spark, sf), "study_period", ["pm", "lab_last"], 5)
    text = F.array_join(F.transform("edges", lambda x: F.round(x, 3).cast("decimal(20,3)").cast("string")), ",")
    return e.select("study_period", "name", "method", text.alias("edges"))


@query(f"""{_PATIENTS}, e AS (SELECT study_period, {_EDGES} FROM pt GROUP BY 1)
SELECT x.patient_num, x.study_period, {', '.join(f"CASE WHEN len(list_distinct(e.{c}))=6 AND x.{c} IS NOT NULL THEN {_Q.format(c=c)} END AS {c}_qcut, CASE WHEN x.{c} IS NOT NULL THEN {_W.format(c=c)} END AS {c}" for c in ("pm", "lab_last"))},
(x.promo>=0.5)::INT AS promo, (x.economy>=0.5)::INT AS economy, CASE x.Sex WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' END AS Sex2 FROM pt x JOIN e USING (study_period)""")
def bn_patient_bins(spark, sf):
    """The patient table binned per study period; intermediate columns go."""
    p = _patients(spark, sf)
    out = patient_tables.with_bins(p, "study_period", ["pm", "lab_last"], patient_tables.bin_edges(p, "study_period", ["pm", "lab_last"], 5), ["lab_first", "place"])
    return out.select("patient_num", "study_period", "pm_qcut", "pm", "lab_last_qcut", "lab_last", binning.binary(F.col("promo")).alias("promo"), binning.binary(F.col("economy")).alias("economy"), visits.sex(F.col("Sex")).alias("Sex2"))


_INDEX = ", ix AS (SELECT patient_num, row_number() OVER (ORDER BY min(start_date::DATE), patient_num) - 1 AS index FROM encounters GROUP BY 1)"


@query(f"{_PATIENTS}{_INDEX} SELECT index, study_period AS year, 1 AS Active_In_Year, promo, AgeStudyStart FROM pt JOIN ix USING (patient_num)")
def bn_deidentified_patients(spark, sf):
    p = _patients(spark, sf).select("patient_num", "birth_date", "study_period", F.lit(1).alias("Active_In_Study_Period"), "promo", "AgeStudyStart")
    index = binning.dense_index(views.encounters(spark, sf), "patient_num", F.to_date("start_date"))
    return patient_tables.deidentified_patients(p, index, "patient_num", {"study_period": "year", "Active_In_Study_Period": "Active_In_Year"})


@query(f"{_YEAR_VISITS} SELECT study_period, VisitType, promo FROM y")
def bn_deidentified_visits(spark, sf):
    v = _year_visits(spark, sf).select("patient_num", "birth_date", "study_period", "VisitType", "promo")
    return patient_tables.deidentified_visits(v, "patient_num")


@query("SELECT DISTINCT encounter_num::VARCHAR AS encounter_num FROM encounters")
def fh_encounter_ids(spark, sf):
    """Ids of the encounters of bundles."""
    return bundles.encounters(bundles.resources(visit_text(spark, sf))).select(F.col("id").alias("encounter_num")).distinct()


_RAW = {"pm25_avg": 7, "pm25_avg_avg": 11, "pm25_max": 13}
_RAW_SQL = ", ".join(f"arg_min((encounter_num%{k})::DOUBLE, (start_date, encounter_num)) AS {c}" for c, k in _RAW.items())


@query(f"""{_YEAR_VISITS}, g AS (SELECT patient_num, study_period, any_value(birth_date) AS birth_date, {_RAW_SQL} FROM y GROUP BY 1, 2)
SELECT patient_num, study_period, {', '.join(f"{c if c in _RAW else 'NULL::DOUBLE'} AS {names.column_name(n)}" for c, n in names.PATIENT_NAMES.items())} FROM g WHERE date_sub('year', birth_date, date '1995-01-01') < 90""")
def in_published_patients(spark, sf):
    """The patient table's exposures under all published names; those without data are empty."""
    v = _year_visits(spark, sf).withColumns({c: (F.col("encounter_num") % k).cast("double") for c, k in _RAW.items()})
    p = patient_tables.patient_table(v, "patient_num", "study_period", ["start_date", "encounter_num"], list(_RAW), [], [], [], "1995-01-01")
    out = patient_tables.published(p.select("patient_num", "study_period", *_RAW), names.PATIENT_NAMES)
    return out.toDF(*map(names.column_name, out.columns))


@query(f"""{_YEAR_VISITS}, e AS (SELECT study_period, quantile_cont(pm, [0,0.2,0.4,0.6,0.8,1.0]) AS pm, min(pm) AS lo_pm, max(pm) AS hi_pm FROM y GROUP BY 1)
SELECT encounter_num, x.study_period, CASE WHEN len(list_distinct(e.pm))=6 AND x.pm IS NOT NULL THEN {_Q.format(c='pm')} END AS pm_qcut, CASE WHEN x.pm IS NOT NULL THEN {_W.format(c='pm')} END AS pm,
(coalesce(promo,0)>=0.5)::INT AS promo, CASE x.Sex WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' END AS Sex2 FROM y x JOIN e USING (study_period)""")
def bn_visit_bins(spark, sf):
    """The visit table binned per study period; intermediate columns go."""
    v = _year_visits(spark, sf)
    out = patient_tables.with_bins(v, "study_period", ["pm"], patient_tables.bin_edges(v, "study_period", ["pm"], 5), ["lab_first", "lab_last", "place"])
    return out.select("encounter_num", "study_period", "pm_qcut", "pm", binning.binary(F.col("promo")).alias("promo"), visits.sex(F.col("Sex")).alias("Sex2"))


@query(""", v AS (SELECT patient_num, date_trunc('month', start_date) AS month, encounter_num, CASE WHEN encounter_num%5<>0 THEN 'v3|s'||(encounter_num%3) END AS system, CASE WHEN encounter_num%5<>0 THEN visit_type END AS code, CASE WHEN encounter_num%2=0 THEN start_date END AS end_date FROM encounters)
SELECT patient_num, strftime(month, '%Y-%m') AS month, string_agg(encounter_num::VARCHAR, '|' ORDER BY encounter_num::VARCHAR) AS encounter_num, nullif(array_to_string(list_sort(list_distinct(flatten(list(string_split(system, '|'))))), '|'), '') AS system,
nullif(array_to_string(list_sort(list_distinct(list(code))), '|'), '') AS code, arg_min(end_date, encounter_num) FILTER (end_date IS NOT NULL) AS end_date FROM v GROUP BY patient_num, month""")
def vv_merged_classes(spark, sf):
    """Encounters of a patient and month as one, with the systems and codes of their classes."""
    k = F.col("encounter_num")
    known = lambda c: F.when(k % 5 != 0, c)
    e = views.encounters(spark, sf).select(
        "patient_num", F.date_format("start_date", "yyyy-MM").alias("month"), "encounter_num", known(F.concat(F.lit("v3|s"), (k % 3).cast("string"))).alias("system"),
        known(F.col("visit_type")).alias("code"), F.when(k % 2 == 0, F.col("start_date")).alias("end_date"),
    )
    return visits.merged_classes(e, ["patient_num", "month"], "encounter_num", ["system", "code"], "end_date")
