"""Registered queries and the DuckDB SQL they are checked against.

A name begins with the family of the operation: en (exposure), vv (visits), mp
(mapping), in (integration), bn (binning), sp (places), wh (warehouse), co
(co-occurrence), py (patient years), st (statistics), ml (models), pf (profiles),
fh (bundles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.operators import binning, bundles, exposure, mapping, profiles, spatial, visits, warehouse
from vitalair.plans import bundle_queries, model_queries, source_queries, table_queries, views, visit_queries, warehouse_queries  # noqa: F401  (each registers its queries)
from vitalair.plans.catalog import grid_sql, oracle_sql, queries, query, r  # noqa: F401
from vitalair.sources import tables

BOUNDS, PERIODS = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"], ["early", "middle", "late"]
PATTERNS = [(r"PROMO.*", True, "promo"), (r".*\.(1|2|3)", True, "small"), (r"ECONOMY\.7", False, "economy7"), (r"[A-M].*", True, "first_half"), (r".*[05]", True, "fives")]
FEATURES = ["economy7", "first_half", "fives", "promo", "small"]


@query("SELECT cell, measure, ts::DATE AS day, round(avg(value),6) AS avg, max(value) AS max, min(value) AS min, round(stddev(value),6) AS stddev FROM readings GROUP BY ALL", day="day")
def en_daily(spark, sf):
    d = exposure.daily(views.readings(spark, sf), ["cell", "measure"], "ts", "value")
    return d.select("cell", "measure", "day", r("avg").alias("avg"), "max", "min", r("stddev").alias("stddev"))


_SCORE = "CASE WHEN v IS NULL THEN NULL ELSE 1+(v>=20)::INT+(v>=40)::INT+(v>=80)::INT+(v>=120)::INT END"


@query(f""", d AS (SELECT cell, ts::DATE AS day, max(value) AS v FROM readings GROUP BY ALL), s AS (SELECT cell, day, {_SCORE} AS score FROM d)
SELECT cell, day, score, round(avg(score) OVER (PARTITION BY cell ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),6) AS score7 FROM s""", day="day")
def en_score_trailing(spark, sf):
    d = exposure.daily(views.readings(spark, sf), ["cell"], "ts", "value")
    s = d.select("cell", "day", exposure.step_score(F.col("max"), [20, 40, 80, 120]).cast("int").alias("score"))
    return s.withColumn("score7", r(exposure.trailing_average(s, ["cell"], "day", "score")))


_PERIOD = "CASE WHEN day >= date '2024-01-01' AND day < date '2024-01-11' THEN 'early' WHEN day >= date '2024-01-11' AND day < date '2024-01-21' THEN 'middle' WHEN day >= date '2024-01-21' AND day < date '2024-02-01' THEN 'late' END"
_DAILY = f", d AS (SELECT cell, ts::DATE AS day, avg(value) AS m FROM readings GROUP BY ALL), p AS (SELECT *, {_PERIOD} AS study_period FROM d)"


def _series(spark, sf) -> DataFrame:
    d = exposure.daily(views.readings(spark, sf), ["cell"], "ts", "value").select("cell", "day", F.col("avg").alias("m"))
    d = d.withColumn("study_period", exposure.study_period(F.col("day"), BOUNDS, PERIODS))
    return exposure.with_period_statistics(d, ["cell"], "day", "study_period", ["m"])


@query(f"""{_DAILY} SELECT cell, day, study_period, round(m,6) AS m, round(avg(m) OVER (PARTITION BY cell, study_period),6) AS m_avg, round(max(m) OVER (PARTITION BY cell, study_period),6) AS m_max,
round(max(m) OVER (PARTITION BY cell ORDER BY day RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING),6) AS m_prev_date FROM p""", day="day")
def en_period_statistics(spark, sf):
    return _series(spark, sf).select("cell", "day", "study_period", *[r(c).alias(c) for c in ("m", "m_avg", "m_max", "m_prev_date")])


@query("""SELECT patient_num, start_date, string_agg(encounter_num::VARCHAR, '|' ORDER BY encounter_num::VARCHAR) AS encounter_num, array_to_string(list_sort(list_distinct(list(visit_type))), '|') AS visit_type FROM encounters GROUP BY ALL""")
def vv_merged_visits(spark, sf):
    return visits.merged_visits(views.encounters(spark, sf))


@query("SELECT encounter_num, date_sub('year', birth_date, start_date::DATE)::INT AS age FROM encounters JOIN patients USING (patient_num)")
def vv_age(spark, sf):
    both = views.encounters(spark, sf).join(views.patients(spark, sf), "patient_num")
    return both.select("encounter_num", visits.age_years(F.col("birth_date"), F.col("start_date")).alias("age"))


_RACE = "CASE WHEN race='Unknown' THEN 'Unknown' " + " ".join(f"WHEN race='{k}' THEN '{v}'" for k, v in visits.RACES.items()) + " ELSE 'Other('||race||')' END"


@query(f"""SELECT patient_num, birth_date, {_RACE} AS race, CASE gender WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' END AS sex,
CASE patient_num%4 WHEN 0 THEN 'Hispanic' WHEN 1 THEN 'Not Hispanic' ELSE 'Unknown' END AS ethnicity FROM patients""", day="birth_date")
def mp_demographics(spark, sf):
    k = F.col("patient_num") % 4
    code = F.when(k == 0, "2135-2").when(k == 1, "2186-5").when(k == 2, "x")
    return views.patients(spark, sf).select("patient_num", "birth_date", visits.race(F.col("race")).alias("race"), visits.sex(F.col("gender")).alias("sex"), mapping.ethnicity(code).alias("ethnicity"))


_HITS = " UNION ALL ".join(f"SELECT encounter_num, '{f}' AS feature FROM observations WHERE " + (f"regexp_full_match(concept_cd, '{p}')" if x else f"concept_cd='{p}'") for p, x, f in PATTERNS)


@query(f", h AS ({_HITS}) SELECT encounter_num, {', '.join(f'count(*) FILTER (feature={f!r}) AS {f}' for f in FEATURES)} FROM h GROUP BY 1")
def vv_feature_counts(spark, sf):
    return visits.feature_counts(views.observations(spark, sf), ["encounter_num"], "concept_cd", PATTERNS, FEATURES)


@query(f"""{_DAILY} SELECT e.encounter_num, e.patient_num, e.day, p.study_period, round(p.m,6) AS m FROM encounters e LEFT JOIN p ON p.cell = e.patient_num % 100 AND p.day = e.day""", day="day")
def in_visit_exposure(spark, sf):
    v = views.encounters(spark, sf).withColumn("cell", F.col("patient_num") % 100)
    return visits.with_exposure(v, _series(spark, sf), ["cell", "day"]).select("encounter_num", "patient_num", "day", "study_period", r("m").alias("m"))


def flagship(spark, sf) -> DataFrame:
    v = views.encounters(spark, sf).withColumn("cell", F.col("patient_num") % 100)
    joined = visits.with_exposure(v, _series(spark, sf), ["cell", "day"]).where("study_period is not null")
    p = visits.patient_periods(joined, ["m"])
    return p.select("patient_num", "study_period", "visits", "ed_visits", "inpatient_visits", "all_visits", *[r(c).alias(c) for c in ("m_avg", "m_max", "m_first")])


@query(f"""{_DAILY} SELECT e.patient_num, p.study_period, count(*) AS visits, count(*) FILTER (visit_type IN ('AMB','EMER')) AS ed_visits, count(*) FILTER (visit_type='IMP') AS inpatient_visits,
count(*) FILTER (visit_type IN ('AMB','EMER','IMP')) AS all_visits, round(avg(m),6) AS m_avg, round(max(m),6) AS m_max, round(arg_min(m, (start_date, encounter_num)),6) AS m_first
FROM encounters e JOIN p ON p.cell = e.patient_num % 100 AND p.day = e.day WHERE p.study_period IS NOT NULL GROUP BY ALL""")
def in_patient_periods(spark, sf):
    return flagship(spark, sf)


@query("""SELECT patient_num, (coalesce(quality,0)=1)::INT AS confirmed, (coalesce(toxic,0)=1)::INT AS predicted, (quality IS NOT NULL)::INT AS in_registry FROM patients LEFT JOIN labels ON doc_id = patient_num""")
def in_crosswalk(spark, sf):
    labels = views.table(spark, sf, "labels").select(F.col("doc_id").alias("patient_num"), "quality", "toxic")
    one = lambda c: F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))
    return views.patients(spark, sf).join(labels, "patient_num", "left").select("patient_num", one("quality").alias("confirmed"), one("toxic").alias("predicted"), F.col("quality").isNotNull().cast("int").alias("in_registry"))


@query(""", q AS (SELECT quantile_cont(nval_num, [0,0.2,0.4,0.6,0.8,1.0]) AS e, min(nval_num) AS lo, max(nval_num) AS hi FROM observations)
SELECT encounter_num, concept_cd, instance_num, nval_num, 1+(nval_num>e[2])::INT+(nval_num>e[3])::INT+(nval_num>e[4])::INT+(nval_num>e[5])::INT AS qbin,
1+(nval_num>lo+(hi-lo)*0.25)::INT+(nval_num>lo+(hi-lo)*0.5)::INT+(nval_num>lo+(hi-lo)*0.75)::INT AS wbin FROM observations, q""")
def bn_quantile_and_width(spark, sf):
    o = views.observations(spark, sf).select("encounter_num", "concept_cd", "instance_num", "nval_num")
    return binning.width_bins(binning.quantile_bins(o, "nval_num", 5, "qbin"), "nval_num", 4, "wbin")


@query("""SELECT c_custkey, CASE WHEN c_acctbal>=-1000 THEN (c_acctbal>=-1000)::INT+(c_acctbal>=0)::INT+(c_acctbal>=2500)::INT+(c_acctbal>=5000)::INT END AS band,
CASE WHEN c_acctbal<0 THEN 500.0 ELSE c_acctbal END AS distance, CASE WHEN coalesce(c_acctbal,0)<0.5 THEN 0 ELSE 1 END AS flag FROM customer""")
def bn_fixed(spark, sf):
    b = F.col("c_acctbal")
    return views.table(spark, sf, "customer").select("c_custkey", binning.fixed_bins(b, [-1000, 0, 2500, 5000]).alias("band"), binning.capped_distance(b).alias("distance"), binning.binary(b).alias("flag"))


@query("SELECT patient_num, row_number() OVER (ORDER BY min(start_date::DATE), patient_num) - 1 AS index FROM encounters GROUP BY 1")
def bn_patient_index(spark, sf):
    return binning.dense_index(views.encounters(spark, sf), "patient_num", F.to_date("start_date"))


_n, _f, _rho0 = spatial._constants()
_XY = grid_sql()


@query(f", {_XY} SELECT patient_num, CASE WHEN row BETWEEN 1 AND 299 AND col BETWEEN 1 AND 459 THEN row END AS row, CASE WHEN row BETWEEN 1 AND 299 AND col BETWEEN 1 AND 459 THEN col END AS col FROM g")
def sp_grid_cell(spark, sf):
    p = views.patients(spark, sf).select("patient_num", spatial.grid_cell(F.col("lat"), F.col("lon"), 2011).alias("c"))
    return p.select("patient_num", "c.row", "c.col")


def _inside(cols: int, rows: int) -> str:
    return f"row BETWEEN 1 AND {rows} AND col BETWEEN 1 AND {cols}"


@query(f""", {_XY}, g10 AS (SELECT patient_num, floor((rho*sin(th)+2556000)/36000)::INT+1 AS col, floor(({_rho0!r}-rho*cos(th)+1728000)/36000)::INT+1 AS row FROM xy),
c AS (SELECT patient_num, 2011::INT AS year, row, col FROM g WHERE {_inside(459, 299)} UNION ALL SELECT patient_num, 2010::INT, row, col FROM g10 WHERE {_inside(148, 112)}),
s AS (SELECT c.year, row, col, ts::DATE AS day, max(value) AS m FROM readings JOIN c ON c.patient_num=cell AND c.year=2010+day(ts)%2 GROUP BY ALL)
SELECT patient_num, year, row, col, day, m FROM c JOIN s USING (year, row, col)""", day="day")
def en_grid_series(spark, sf):
    """Readings kept by year and grid cell, attached to all patients of the cell."""
    p = views.patients(spark, sf).select("patient_num", "lat", "lon")
    d = exposure.daily(views.readings(spark, sf), ["cell"], "ts", "value").withColumn("year", F.dayofmonth("day") % 2 + 2010)
    cell = F.when(F.col("year") == 2010, spatial.grid_cell(F.col("lat"), F.col("lon"), 2010)).otherwise(spatial.grid_cell(F.col("lat"), F.col("lon"), 2011))
    at = d.join(p.withColumnRenamed("patient_num", "cell"), "cell").withColumn("c", cell).where("c is not null")
    path = tables.shared_folder(spark, "cells")
    spatial.write_grid_series(at.groupBy("year", "c.row", "c.col", "day").agg(F.max("max").alias("m")), path)
    return spatial.grid_series(p, spark.read.parquet(path), "patient_num", [2009, 2010, 2011])


def _sql_geodesic(turns: int = 8) -> str:
    """Steps of the inverse formula as nested queries over near(patient_num, facility, lat1, lon1, lat2, lon2)."""
    f, b = spatial.FLATTENING, spatial.A * (1 - spatial.FLATTENING)
    q = f"SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, l AS lam FROM (SELECT *, atan({1 - f!r}*tan(radians(lat1))) AS u1, atan({1 - f!r}*tan(radians(lat2))) AS u2, radians(lon2-lon1) AS l FROM near)"
    for i in range(turns + 1):
        q = f"SELECT *, sqrt(pow(c2*sin(lam),2)+pow(c1*s2-s1*c2*cos(lam),2)) AS ss, s1*s2+c1*c2*cos(lam) AS cs FROM ({q})"
        q = f"SELECT *, 1-sa*sa AS ca FROM (SELECT *, atan2(ss,cs) AS sg, CASE WHEN ss>0 THEN c1*c2*sin(lam)/ss ELSE 0 END AS sa FROM ({q}))"
        q = f"SELECT *, cs-2*s1*s2/ca AS cm, {f!r}/16*ca*(4+{f!r}*(4-3*ca)) AS c FROM ({q})"
        if i < turns:
            q = f"SELECT patient_num, facility, s1, c1, s2, c2, l, l+(1-c)*{f!r}*sa*(sg+c*ss*(cm+c*cs*(2*cm*cm-1))) AS lam FROM ({q})"
    k = (spatial.A**2 - b**2) / b**2
    q = f"SELECT *, 1+k/16384*(4096+k*(-768+k*(320-175*k))) AS ka, k/1024*(256+k*(-128+k*(74-47*k))) AS kb FROM (SELECT *, ca*{k!r} AS k FROM ({q}))"
    return f"SELECT patient_num, facility, {b!r}*ka*(sg-kb*ss*(cm+kb/4*(cs*(2*cm*cm-1)-kb/6*cm*(4*ss*ss-3)*(4*cm*cm-3)))) AS d FROM ({q})"


@query(f""", near AS (SELECT patient_num, facility, p.lat AS lat1, p.lon AS lon1, f.lat AS lat2, f.lon AS lon2 FROM patients p JOIN facilities f ON p.lon IS NOT NULL), z AS ({_sql_geodesic()}),
m AS (SELECT patient_num, arg_min(facility, (round(d,4), facility)) AS facility, min(d) AS d FROM z GROUP BY 1) SELECT patient_num, facility, round(d,2) AS distance FROM patients LEFT JOIN m USING (patient_num)""")
def sp_nearest_geodesic(spark, sf):
    out = spatial.nearest_place(views.patients(spark, sf), views.facilities(spark, sf), "patient_num", "facility")
    return out.select("patient_num", "facility", r("distance", 2).alias("distance"))


_H = "asin(sqrt(pow(sin(radians(f.lat-p.lat)/2),2)+cos(radians(p.lat))*cos(radians(f.lat))*pow(sin(radians(f.lon-p.lon)/2),2)))*2*6371008.8"


@query(f""", m AS (SELECT p.patient_num, arg_min(f.facility, ({_H}, f.facility)) AS facility, min({_H}) AS d FROM patients p JOIN facilities f ON p.lat IS NOT NULL GROUP BY 1)
SELECT patient_num, m.facility, round(d,3) AS distance, round(f.lat,4) AS facility_lat FROM patients LEFT JOIN m USING (patient_num) LEFT JOIN facilities f ON f.facility=m.facility""")
def sp_nearest_facility(spark, sf):
    places = views.facilities(spark, sf).withColumn("facility_lat", r("lat", 4))
    out = spatial.nearest_place(views.patients(spark, sf), places, "patient_num", "facility", exact=False, attributes=("facility_lat",))
    return out.select("patient_num", "facility", r("distance", 3).alias("distance"), "facility_lat")


@query("SELECT encounter_num, sum(nval_num) FILTER (modifier_cd='A') AS A, sum(nval_num) FILTER (modifier_cd='N') AS N, sum(nval_num) FILTER (modifier_cd='R') AS R FROM observations GROUP BY 1")
def wh_long_to_wide(spark, sf):
    return warehouse.long_to_wide(views.observations(spark, sf), ["encounter_num"], "modifier_cd", "nval_num", ["A", "N", "R"])


@query("""SELECT e.encounter_num, count(o.encounter_num) FILTER (o.start_date::DATE < e.start_date::DATE) AS pre_ed, count(o.encounter_num) FILTER (o.start_date::DATE > e.start_date::DATE) AS post_ed
FROM encounters e LEFT JOIN encounters o ON o.patient_num=e.patient_num AND o.visit_type IN ('EMER','IMP') AND abs(date_diff('day', o.start_date::DATE, e.start_date::DATE)) BETWEEN 1 AND 365 GROUP BY 1""")
def wh_before_and_after(spark, sf):
    return warehouse.before_and_after(views.encounters(spark, sf))


@query("SELECT patient_num, min(start_date) AS first_start, count(DISTINCT encounter_num) AS encounters FROM encounters WHERE encounter_num IN (SELECT encounter_num FROM observations WHERE concept_cd LIKE 'PROMO%') GROUP BY 1")
def wh_cohort(spark, sf):
    own = warehouse.cohort(views.encounters(spark, sf), views.observations(spark, sf), F.col("concept_cd").startswith("PROMO"), "encounter_num")
    return own.groupBy("patient_num").agg(F.min("start_date").alias("first_start"), F.count_distinct("encounter_num").alias("encounters"))


@query("SELECT patient_num, encounter_num, start_date, coalesce(lead(start_date) OVER (PARTITION BY patient_num ORDER BY start_date, encounter_num), start_date) AS end_date FROM encounters")
def ml_visit_periods(spark, sf):
    return warehouse.visit_periods(views.encounters(spark, sf))


@query(""", o AS (SELECT patient_num, o.start_date::DATE AS day, split_part(concept_cd,'.',1) AS code FROM observations o JOIN encounters e USING (encounter_num)),
b AS (SELECT DISTINCT patient_num, code, floor((date_diff('day', date '1970-01-01', day) + ('0x'||substr(md5(code),1,7))::BIGINT % 30)/30.0)::BIGINT AS bin FROM o),
s AS (SELECT code, count(*) AS n FROM b GROUP BY 1), p AS (SELECT x.code AS code1, y.code AS code2, count(*) AS n12 FROM b x JOIN b y ON x.patient_num=y.patient_num AND x.bin=y.bin AND x.code<y.code GROUP BY 1,2)
SELECT code1, code2, greatest(n12, 10) AS n12, round(n12/(a.n*c.n)::DOUBLE,9) AS score FROM p JOIN s a ON a.code=code1 JOIN s c ON c.code=code2""")
def co_pairs(spark, sf):
    o = views.observations(spark, sf).join(views.encounters(spark, sf).select("encounter_num", "patient_num"), "encounter_num")
    o = o.select("patient_num", F.to_date("start_date").alias("day"), F.substring_index("concept_cd", ".", 1).alias("code"))
    return warehouse.cooccurrence(o, "patient_num", "code", F.col("day"), 30, 10).withColumn("score", r("score", 9))


@query("""SELECT patient_num, year(start_date)::INT AS year, count(*) FILTER (visit_type='AMB') AS AMB, count(*) FILTER (visit_type='EMER') AS EMER, count(*) FILTER (visit_type='IMP') AS IMP, (year(start_date)-year(birth_date))::INT AS age
FROM encounters JOIN patients USING (patient_num) GROUP BY ALL""")
def py_patient_years(spark, sf):
    return warehouse.visit_years(views.encounters(spark, sf), views.patients(spark, sf), "patient_num", "start_date", "visit_type", ["AMB", "EMER", "IMP"])


@query("""SELECT visit_type, count(*) AS n, round(avg(o_totalprice),6) AS mean, min(o_totalprice) AS low, round(quantile_cont(o_totalprice,0.25),6) AS q1, round(quantile_cont(o_totalprice,0.5),6) AS median, round(quantile_cont(o_totalprice,0.75),6) AS q3, max(o_totalprice) AS high
FROM encounters JOIN orders ON o_orderkey=encounter_num GROUP BY 1""")
def st_summary(spark, sf):
    price = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("encounter_num"), "o_totalprice")
    s = warehouse.summary(views.encounters(spark, sf).join(price, "encounter_num"), ["visit_type"], "o_totalprice")
    return s.select("visit_type", "n", *[r(c).alias(c) for c in ("mean", "low", "q1", "median", "q3", "high")])


@query(""", s AS (SELECT avg(value) FILTER (measure='click') AS ma, var_samp(value) FILTER (measure='click') AS va, count(value) FILTER (measure='click') AS na, avg(value) FILTER (measure='view') AS mb, var_samp(value) FILTER (measure='view') AS vb, count(value) FILTER (measure='view') AS nb FROM readings)
SELECT round((ma-mb)/sqrt(va/na+vb/nb),6) AS t, round(pow(va/na+vb/nb,2)/(pow(va/na,2)/(na-1)+pow(vb/nb,2)/(nb-1)),4) AS df FROM s""")
def st_welch(spark, sf):
    return warehouse.welch_t(views.readings(spark, sf), "measure", "click", "view", "value").select(r("t").alias("t"), r("df", 4).alias("df"))


@query(""", s AS (SELECT avg(value) FILTER (measure='click') AS ma, var_samp(value) FILTER (measure='click') AS va, count(value) FILTER (measure='click') AS na, avg(value) FILTER (measure='purchase') AS mb, var_samp(value) FILTER (measure='purchase') AS vb, count(value) FILTER (measure='purchase') AS nb FROM readings),
w AS (SELECT (ma-mb)/sqrt(va/na+vb/nb) AS t, pow(va/na+vb/nb,2)/(pow(va/na,2)/(na-1)+pow(vb/nb,2)/(nb-1)) AS v FROM s),
x AS (SELECT abs(t)*i/2000 AS x, CASE WHEN i IN (0,2000) THEN 1 WHEN i%2=1 THEN 4 ELSE 2 END AS k, t, v FROM w, (SELECT unnest(range(2001)) AS i))
SELECT round(1-2*any_value(abs(t))/6000*sum(k*exp(lgamma((v+1)/2)-lgamma(v/2))/sqrt(v*pi())*pow(1+x*x/v,-(v+1)/2)),6) AS p FROM x""")
def st_welch_probability(spark, sf):
    """Two-sided probability of the difference; its SQL integrates the density."""
    w = warehouse.welch_t(views.readings(spark, sf), "measure", "click", "purchase", "value")
    return w.select(r(warehouse.t_probability("t", "df")).alias("p"))


@query(""", s AS (SELECT count(*) FILTER (visit_type='EMER')/count(*) FILTER (visit_type='AMB')::DOUBLE AS rate FROM encounters)
SELECT encounter_num FROM encounters, s WHERE visit_type='AMB' AND ('0x'||substr(md5(encounter_num::VARCHAR),1,7))::BIGINT/268435456.0::DOUBLE < rate""")
def st_sample(spark, sf):
    """Ambulatory visits sampled to about as many as there are emergency visits, alike in every run."""
    e = views.encounters(spark, sf)
    rate = e.agg((F.count_if(F.col("visit_type") == "EMER") / F.count_if(F.col("visit_type") == "AMB")).alias("_rate"))  # one row
    amb = e.where("visit_type = 'AMB'").select("encounter_num").crossJoin(F.broadcast(rate))
    return warehouse.hash_sample(amb, F.col("encounter_num"), F.col("_rate")).select("encounter_num")


@query("SELECT modifier_cd, round(regr_slope(l_extendedprice, l_quantity),6) AS slope, round(regr_intercept(l_extendedprice, l_quantity),4) AS intercept, round(corr(l_extendedprice, l_quantity),6) AS r FROM (SELECT *, l_returnflag AS modifier_cd FROM lineitem) GROUP BY 1")
def st_line_fit(spark, sf):
    fit = warehouse.line_fit(views.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "modifier_cd"), ["modifier_cd"], "l_extendedprice", "l_quantity")
    return fit.select("modifier_cd", r("slope").alias("slope"), r("intercept", 4).alias("intercept"), r("r").alias("r"))


@query("SELECT name, value, count(*) AS n FROM (SELECT 'modifier_cd' AS name, modifier_cd AS value FROM observations UNION ALL SELECT 'concept_cd', concept_cd FROM observations UNION ALL SELECT 'visit_type', visit_type FROM encounters) GROUP BY ALL")
def pf_value_counts(spark, sf):
    return profiles.value_counts([(views.observations(spark, sf), ["modifier_cd", "concept_cd"]), (views.encounters(spark, sf), ["visit_type"])])


@query("SELECT DISTINCT modifier_cd AS value FROM observations UNION SELECT DISTINCT visit_type FROM encounters")
def pf_distinct_values(spark, sf):
    return profiles.distinct_values([(views.observations(spark, sf), "modifier_cd"), (views.encounters(spark, sf), "visit_type")])


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS index FROM events")
def pf_row_index(spark, sf):
    return profiles.row_index(views.table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "index")


@query(""", v AS (SELECT patient_num, year(start_date)::INT AS year, encounter_num FROM encounters WHERE year(start_date) IN (1996, 1999)), l AS (SELECT doc_id AS patient_num, max(quality) AS quality, y::INT AS year FROM labels, (VALUES (1996), (1999)) t(y) GROUP BY ALL)
SELECT patient_num, year, encounter_num, quality, (encounter_num IS NOT NULL)::INT AS IN_ICEES, (quality IS NOT NULL)::INT AS IN_EPR FROM v FULL JOIN l USING (patient_num, year)""")
def bn_registry_periods(spark, sf):
    """Visits and a survey for each study period."""
    v = views.encounters(spark, sf).select("patient_num", F.year("start_date").alias("year"), "encounter_num")
    s = views.table(spark, sf, "labels").groupBy(F.col("doc_id").alias("patient_num")).agg(F.max("quality").alias("quality"))
    return binning.registry_periods(v, s, "patient_num", "year", [1996, 1999])


@query("SELECT encounter_num, patient_num::VARCHAR AS patient_num, visit_type AS code, start_date::DATE AS day FROM encounters", day="day")
def fh_encounters(spark, sf):
    """Encounters written as bundle entries and parsed again."""
    e = bundles.encounters(bundles.resources(bundle_queries.visit_text(spark, sf)))
    return e.select(F.col("id").cast("long").alias("encounter_num"), F.col("patient").alias("patient_num"), F.col("class.code").alias("code"), F.to_date(F.substring("start", 1, 10)).alias("day"))
