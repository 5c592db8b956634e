"""Queries: sources and sinks, series, places, integration, surveys, fact tables and co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.operators import binning, exposure, intervals, mapping, names, spatial, visits, warehouse
from vitalair.plans import views
from vitalair.plans.catalog import query, r
from vitalair.sources import sparse_format, tables


@query("SELECT event_id, user_id::VARCHAR AS user_id, event_type, value, NULL::VARCHAR AS note FROM events")
def src_csv(spark, sf):
    """Events written as CSV and read with a partial schema."""
    path = tables.shared_folder(spark, "csv")
    tables.write_csv(views.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path)
    return tables.read_csv(spark, path, {"event_id": "long", "value": "double", "note": "string"})


@query("SELECT event_id, CASE WHEN event_id%2=0 THEN event_type END AS event_type, CASE WHEN event_id%2=1 THEN value END AS value FROM events")
def src_union(spark, sf):
    """Tables whose columns differ, as one."""
    e = views.table(spark, sf, "events")
    return tables.union_all([e.where("event_id % 2 = 0").select("event_id", "event_type"), e.where("event_id % 2 = 1").select("value", "event_id")])


@query("SELECT event_type, event_id, value FROM events")
def src_by_key(spark, sf):
    path = tables.shared_folder(spark, "by-key")
    tables.write_by_key(views.table(spark, sf, "events").select("event_type", "event_id", "value"), ["event_type"], path)
    return spark.read.parquet(path)


@query("SELECT p_partkey::VARCHAR AS p_partkey, '['||p_brand||','||p_type||']' AS list, '('||p_size||','||p_name||')' AS pair, '{brand:'||p_brand||',size:'||p_size||'}' AS named FROM part")
def src_nested_text(spark, sf):
    """Nested columns written to CSV as text."""
    p = views.table(spark, sf, "part")
    named = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.col("p_brand"))
    path = tables.shared_folder(spark, "nested")
    tables.write_csv(p.select("p_partkey", F.array("p_brand", "p_type").alias("list"), F.struct("p_size", "p_name").alias("pair"), named.alias("named")), path, sep="!")
    return tables.read_csv(spark, path, sep="!")


@query("SELECT p_partkey, p_brand AS brand, CASE WHEN p_partkey%2=0 THEN p_size::VARCHAR END AS size FROM part")
def src_sparse_rows(spark, sf):
    p = views.table(spark, sf, "part")
    text = F.concat_ws("!", F.concat(F.lit("(0,"), "p_brand", F.lit(")")), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("(2,"), "p_size", F.lit(")"))), F.lit("(9,x)"))
    m = p.select("p_partkey", tables.sparse_to_map(text, F.array(*map(F.lit, ("brand", "type", "size")))).alias("m"))
    return m.select("p_partkey", F.try_element_at("m", F.lit("brand")).alias("brand"), F.try_element_at("m", F.lit("size")).alias("size"))


@query(""", n AS (SELECT DISTINCT p_brand FROM part), k AS (SELECT p_partkey, p_brand AS name, p_size::VARCHAR AS v FROM part UNION ALL SELECT p_partkey, (SELECT min(p_brand) FROM n), p_type||', '||p_size||'!' FROM part WHERE p_brand <> (SELECT min(p_brand) FROM n))
SELECT p_partkey::VARCHAR AS p_partkey, p_name, count(*)::INT AS held, string_agg('size_of_'||name||'='||v, '|' ORDER BY name) AS cells FROM k JOIN part USING (p_partkey) GROUP BY ALL""")
def src_sparse_format(spark, sf):
    """Parts written in the sparse format with their meta files and read by the data source: entries of even keys are quoted and count from 0."""
    part = views.table(spark, sf, "part")
    names = tables.stored(warehouse.names_table(part, "p_brand"), "names")
    path = tables.shared_folder(spark, "sparse")
    listed = names.agg(F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "p_brand"))), lambda x: F.concat(F.lit('"'), x["p_brand"], F.lit('"'))), ","), F.lit("}")).alias("value"))
    listed.coalesce(1).write.text(f"{path}/colmeta")
    spark.range(1).select(F.lit("p_partkey!size_of!p_name").alias("value")).coalesce(1).write.text(f"{path}/filemeta")
    first, even = F.when(F.col("p_partkey") % 2 == 0, 0).otherwise(1), F.col("p_partkey") % 2 == 0
    note = F.concat(F.lit('"'), "p_type", F.lit(", "), F.col("p_size").cast("string"), F.lit('!"'))
    more = F.col("place") > 1
    places = F.concat_ws(",", (F.col("place") - 1 + first).cast("string"), F.when(more, first.cast("string")))
    bare = F.concat(F.lit("({"), places, F.lit("},{"), F.concat_ws(",", F.col("p_size").cast("string"), F.when(more, note)), F.lit("})"))
    entry = F.when(even, F.concat(F.lit('"'), F.replace(bare, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(bare)
    rows = part.join(names, "p_brand").select(F.concat_ws("!", F.col("p_partkey").cast("string"), entry, F.concat(F.lit('"'), "p_name", F.lit('"'))).alias("value"))
    rows.write.text(f"{path}/rows")
    spark.dataSource.register(sparse_format.SparseTable)
    read = spark.read.format("sparse_table").option("filemeta", f"{path}/filemeta").option("colmeta.size", f"{path}/colmeta").load(f"{path}/rows")
    pairs = F.transform(F.array_sort(F.map_keys("size_of")), lambda k: F.concat(k, F.lit("="), F.element_at("size_of", k)))
    return read.select("p_partkey", "p_name", F.size("size_of").alias("held"), F.array_join(pairs, "|").alias("cells"))


@query("SELECT vec_id, len([x FOR x IN embedding IF abs(x::DOUBLE)>=0.1])::INT AS held, true AS same FROM embeddings")
def src_sparse_arrays(spark, sf):
    cut = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double")) >= 0.1, x.cast("double")).otherwise(0.0))
    e = views.table(spark, sf, "embeddings").select("vec_id", cut.alias("dense")).withColumn("sparse", tables.to_sparse(F.col("dense")))
    return e.select("vec_id", F.size("sparse.indices").alias("held"), (tables.to_dense(F.col("sparse")) == F.col("dense")).alias("same"))


_DAILY = ", d AS (SELECT cell, ts::DATE AS day, max(value) AS m FROM readings GROUP BY ALL)"


def _daily(spark, sf) -> DataFrame:
    return exposure.daily(views.readings(spark, sf), ["cell"], "ts", "value").select("cell", "day", F.col("max").alias("m"))


@query(""", p AS (SELECT o_orderkey AS period, o_orderdate::DATE AS a, o_orderdate::DATE + (1 + o_orderkey%90 + CASE WHEN o_orderkey%1000=0 THEN 2000 ELSE 0 END)::INT AS b FROM orders), d AS (SELECT DISTINCT l_shipdate::DATE AS day FROM lineitem)
SELECT day, count(*) AS periods, min(period) AS least, max(period) AS largest, sum(period)::BIGINT AS total FROM d JOIN p ON day >= a AND day < b GROUP BY 1""", day="day")
def en_open_periods(spark, sf):
    """Each shipping day with the periods, one an order and of one day to six years, that hold it."""
    k, a = F.col("o_orderkey"), F.to_date("o_orderdate")
    p = views.table(spark, sf, "orders").select(k.alias("period"), a.alias("a"), F.date_add(a, (1 + k % 90 + F.when(k % 1000 == 0, 2000).otherwise(0)).cast("int")).alias("b"))
    days = views.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    met = intervals.with_periods(days, "day", p, "period", "a", "b")
    return met.groupBy("day").agg(F.count("*").alias("periods"), F.min("period").alias("least"), F.max("period").alias("largest"), F.sum("period").alias("total"))


@query(f"{_DAILY} SELECT patient_num, cell, day, m FROM patients JOIN d ON cell = patient_num%1000", day="day")
def en_region_series(spark, sf):
    p = views.patients(spark, sf).select("patient_num", (F.col("patient_num") % 1000).alias("cell"))
    return exposure.region_series(p, _daily(spark, sf), "cell").select("patient_num", "cell", "day", "m")


@query(f"{_DAILY} SELECT encounter_num, x.lag::INT AS lag, m FROM encounters e, (SELECT unnest(range(7)) AS lag) x LEFT JOIN d ON d.cell=e.patient_num%100 AND d.day=e.day-x.lag::INT")
def en_lag(spark, sf):
    v = views.encounters(spark, sf).select("encounter_num", (F.col("patient_num") % 100).alias("cell"), "day")
    return exposure.lag_exposure(v, _daily(spark, sf), ["cell"], "day", "m").select("encounter_num", "lag", "m")


@query(""", d AS (SELECT o_custkey AS k, o_orderdate::DATE AS day, sum(o_totalprice) AS m FROM orders GROUP BY ALL)
SELECT k, day, round(avg(m) OVER (PARTITION BY k, year(day)),6) AS m_avg, round(max(m) OVER (PARTITION BY k, year(day)),6) AS m_max, round(max(m) OVER (PARTITION BY k ORDER BY day RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING),6) AS m_prev_date FROM d""", day="day")
def en_calendar_year(spark, sf):
    d = views.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("m")).withColumn("year", F.year("day"))
    return exposure.with_period_statistics(d, ["k"], "day", "year", ["m"]).select("k", "day", *[r(c).alias(c) for c in ("m_avg", "m_max", "m_prev_date")])


@query("SELECT event_id, strftime(ts, '%Y/%m/%d') AS date, year(ts)::INT AS year FROM events")
def en_dates(spark, sf):
    text = exposure.slash_date(F.date_format("ts", "MMM-dd-yyyy"))
    return views.table(spark, sf, "events").select("event_id", text.alias("date"), F.year(F.to_date(text, "yyyy/MM/dd")).alias("year"))


@query(""", a AS (SELECT cell, ts::DATE AS day, max(value) AS m FROM readings WHERE measure='click' GROUP BY ALL), b AS (SELECT cell, ts::DATE AS day, max(value) AS m FROM readings WHERE measure='view' GROUP BY ALL)
SELECT cell, day, a.m, b.m AS m_2 FROM a FULL JOIN b USING (cell, day)""", day="day")
def en_merged_measures(spark, sf):
    d = exposure.daily(views.readings(spark, sf).where("measure in ('click', 'view')"), ["cell", "measure"], "ts", "value")
    one = lambda k: d.where(F.col("measure") == k).select("cell", "day", F.col("max").alias("m"))
    return exposure.merged_measures(one("click"), one("view"), ["cell", "day"])


_R = 1.2345


def _diamonds(spark, sf) -> DataFrame:
    """The sides of a diamond around each facility."""
    la, lo = F.col("lat"), F.col("lon")
    at = [(la + _R, lo), (la, lo + _R), (la - _R, lo), (la, lo - _R)]
    sides = [F.struct(a[0].alias("lat1"), a[1].alias("lon1"), b[0].alias("lat2"), b[1].alias("lon2")) for a, b in zip(at, at[1:] + at[:1])]
    return views.facilities(spark, sf).select(F.col("facility").alias("region"), F.explode(F.array(*sides)).alias("s")).select("region", "s.*")


_REGION = f", g AS (SELECT patient_num, min(facility) AS region FROM patients p JOIN facilities f ON abs(p.lat-f.lat)+abs(p.lon-f.lon) < {_R} GROUP BY 1)"


@query(f"{_REGION} SELECT patient_num, region FROM patients LEFT JOIN g USING (patient_num)")
def sp_region(spark, sf):
    return spatial.region_of(views.patients(spark, sf), _diamonds(spark, sf), "patient_num", "region")


@query(f"{_REGION} SELECT patient_num, region, s_acctbal AS income, s_name AS name FROM g JOIN supplier ON s_suppkey=region")
def sp_region_attributes(spark, sf):
    a = views.table(spark, sf, "supplier").withColumn("id", F.concat(F.lit("15000US"), F.col("s_suppkey").cast("string")))
    at = spatial.region_of(views.patients(spark, sf), _diamonds(spark, sf), "patient_num", "region").where("region is not null")
    own = spatial.region_attributes(at, a.select(F.col("id").alias("region"), "s_acctbal", "s_name"), "region", "15000US", {"s_acctbal": "income", "s_name": "name"})
    return own


_N, _F, _RHO0 = spatial._constants()


def _sql_xy(lat: str, lon: str) -> tuple[str, str]:
    rho = f"({spatial.A * _F!r}*pow(tan(pi()/4-radians({lat})/2)/pow((1-{spatial.E!r}*sin(radians({lat})))/(1+{spatial.E!r}*sin(radians({lat}))),{spatial.E / 2!r}),{_N!r}))"
    th = f"(radians(({lon})+97)*{_N!r})"
    return f"{rho}*sin({th})", f"{_RHO0!r}-{rho}*cos({th})"


_P, _A, _B = _sql_xy("lat", "lon"), _sql_xy("lat", "lon"), _sql_xy("lat+0.5", "lon+0.3")


@query(f""", p AS (SELECT patient_num, {_P[0]} AS x, {_P[1]} AS y FROM patients WHERE lat IS NOT NULL), s AS (SELECT facility, {_A[0]} AS x1, {_A[1]} AS y1, {_B[0]} AS x2, {_B[1]} AS y2 FROM facilities),
t AS (SELECT *, greatest(0, least(1, ((x-x1)*(x2-x1)+(y-y1)*(y2-y1))/(pow(x2-x1,2)+pow(y2-y1,2)))) AS t FROM p, s), u AS (SELECT patient_num, facility, sqrt(pow(x-x1-t*(x2-x1),2)+pow(y-y1-t*(y2-y1),2)) AS d FROM t)
SELECT patient_num, round(min(d),2) AS distance, arg_min(facility, (d, facility)) AS facility FROM patients LEFT JOIN (SELECT * FROM u WHERE d<=60000) USING (patient_num) GROUP BY 1""")
def sp_nearest_line(spark, sf):
    f = views.facilities(spark, sf).select("facility", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), (F.col("lat") + 0.5).alias("lat2"), (F.col("lon") + 0.3).alias("lon2"))
    out = spatial.nearest_line(views.patients(spark, sf), f, "patient_num", "facility", 60000.0)
    return out.select("patient_num", F.when(F.col("distance") < float("inf"), r("distance", 2)).alias("distance"), "facility")


@query(""", v AS (SELECT encounter_num, patient_num, start_date, date_sub('year', birth_date, start_date::DATE)::INT AS age, encounter_num%5 AS asthma, 15.0+encounter_num%30 AS bmi, encounter_num%7 AS pm FROM encounters JOIN patients USING (patient_num))
SELECT encounter_num, age AS AgeVisit, asthma AS AsthmaVisit, 0::INT AS CroupVisit, (bmi>=30)::INT AS ObesityBMIVisit, pm::DOUBLE AS AvgDailyPM, NULL::DOUBLE AS MaxDailyOzone FROM v WHERE age<90""")
def in_visit_table(spark, sf):
    v = views.encounters(spark, sf).join(views.patients(spark, sf).select("patient_num", "birth_date"), "patient_num")
    k = F.col("encounter_num")
    v = v.select("encounter_num", "patient_num", "birth_date", "start_date", (k % 5).alias("Asthma"), (15.0 + k % 30).alias("bmi"), (k % 7).cast("double").alias("pm_avg"))
    return visits.visit_table(v, ["Asthma", "Croup"], {"pm_avg": "AvgDailyPM", "o3_max": "MaxDailyOzone"}, ["patient_num", "birth_date", "start_date"])


_PUBLISHED = {"pm25_avg_prev_date": "k%7", "o3_max_prev_date": "k%11", "CO_ppbv_prev_date": "k%13"}


@query("SELECT encounter_num, patient_num, " + ", ".join(f"{f'(encounter_num{_PUBLISHED[c][1:]})::DOUBLE' if c in _PUBLISHED else 'NULL::DOUBLE'} AS {names.column_name(n)}" for c, n in names.VISIT_NAMES.items()) + " FROM encounters JOIN patients USING (patient_num) WHERE date_sub('year', birth_date, start_date::DATE)<90")
def in_published_visits(spark, sf):
    """Visits with all published exposures under their names; those without data are empty."""
    v = views.encounters(spark, sf).join(views.patients(spark, sf).select("patient_num", "birth_date"), "patient_num").withColumn("k", F.col("encounter_num"))
    v = v.select("encounter_num", "patient_num", "birth_date", "start_date", F.lit(None).cast("double").alias("bmi"), *[F.expr(e).cast("double").alias(c) for c, e in _PUBLISHED.items()])
    out = visits.visit_table(v, [], names.VISIT_NAMES, ["birth_date", "start_date"]).drop("AgeVisit", "ObesityBMIVisit")
    return out.toDF(*map(names.column_name, out.columns))


@query(""", a AS (SELECT patient_num, lat AS a_lat FROM patients WHERE patient_num%2=0), b AS (SELECT patient_num, lon AS b_lon FROM patients WHERE patient_num%3=0)
SELECT encounter_num, patient_num, a_lat, b_lon FROM encounters LEFT JOIN (a FULL JOIN b USING (patient_num)) USING (patient_num)""")
def in_static_tables(spark, sf):
    p, k = views.patients(spark, sf), F.col("patient_num")
    a, b = p.where(k % 2 == 0).select("patient_num", F.col("lat").alias("a_lat"), "race"), p.where(k % 3 == 0).select("patient_num", F.col("lon").alias("b_lon"), "gender")
    static = tables.merge_tables([a, b], [["patient_num"]], ["full"], ["a_.*", "b_.*"])
    return tables.merge_tables([views.encounters(spark, sf).select("encounter_num", "patient_num"), static], [["patient_num"]], ["left"])


@query(""", y AS (SELECT DISTINCT patient_num, year(start_date) AS year FROM encounters) SELECT patient_num, u.year::INT AS year, (y.year IS NOT NULL)::INT AS active FROM patients CROSS JOIN (SELECT unnest([1995,1997,1999]) AS year) u LEFT JOIN y USING (patient_num, year)""")
def in_active(spark, sf):
    pairs = views.patients(spark, sf).select("patient_num", F.explode(F.array(*map(F.lit, (1995, 1997, 1999)))).alias("year"))
    return visits.active_in_period(pairs, views.encounters(spark, sf).select("patient_num", F.year("start_date").alias("year")), ["patient_num", "year"])


_AGE = "CASE WHEN c_custkey%7<>0 THEN c_custkey%110 END"


@query(f""", s AS (SELECT c_custkey, {_AGE} AS a FROM customer WHERE coalesce({_AGE},0)<90)
SELECT c_custkey, CASE WHEN a<3 THEN '0-2' WHEN a<18 THEN '3-17' WHEN a<35 THEN '18-34' WHEN a<51 THEN '35-50' WHEN a<70 THEN '51-69' WHEN a<90 THEN '70-89' END AS age,
CASE WHEN a<5 THEN '<5' WHEN a<18 THEN '5-17' WHEN a<45 THEN '18-44' WHEN a<65 THEN '45-64' WHEN a<90 THEN '65-89' END AS age2 FROM s""")
def bn_survey(spark, sf):
    k = F.col("c_custkey")
    s = views.table(spark, sf, "customer").select("c_custkey", F.when(k % 7 != 0, k % 110).alias("age"), "c_name")
    return binning.survey_rows(s, ["age"], ["c_name"])


_SURVEY = """, l AS (SELECT doc_id, 'h'||doc_id AS hk, CASE WHEN doc_id%3<>0 THEN doc_id END AS p, max(quality) AS quality FROM labels GROUP BY doc_id), v AS (SELECT DISTINCT patient_num FROM encounters WHERE year(start_date)=1996),
a AS (SELECT coalesce('p:'||p, 's:'||hk) AS person, min(hk) AS hk, min(p) AS p FROM (SELECT hk, p FROM l WHERE doc_id%2=0 UNION ALL SELECT NULL, patient_num FROM v) GROUP BY 1),
b AS (SELECT coalesce('p:'||p, 's:'||hk) AS person, min(hk) AS hk, min(p) AS p FROM (SELECT hk, p FROM l UNION ALL SELECT NULL, patient_num FROM v) GROUP BY 1),
i AS (SELECT person, row_number() OVER (ORDER BY hk NULLS LAST, p) - 1 AS index FROM a UNION ALL SELECT person, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY hk NULLS LAST, p) - 1 FROM b WHERE person NOT IN (SELECT person FROM a))"""


def _survey(spark, sf, visit_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Survey and visits of 1996 in a second run; the first knew half of the survey."""
    labels = views.table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    survey = labels.select("doc_id", F.concat(F.lit("h"), F.col("doc_id").cast("string")).alias("survey_key"), "quality")
    crosswalk = survey.where("doc_id % 3 != 0").select("survey_key", F.col("doc_id").alias("patient_num"))
    rows = views.encounters(spark, sf).where("year(start_date) = 1996").select("patient_num", F.lit(1996).alias("year"), *visit_columns).distinct()
    index, order = None, [F.asc_nulls_last("survey_key"), F.asc("patient_num")]
    for own in (survey.where("doc_id % 2 = 0"), survey):
        index = tables.stored(binning.appended_index(index, binning.persons(own, crosswalk, rows, "survey_key", "patient_num"), "person", order), "index")
    return binning.survey_tables(survey.drop("doc_id"), crosswalk, rows, index, "survey_key", "patient_num", "year", 1996)


@query(f"""{_SURVEY} SELECT hk AS survey_key, coalesce(p, patient_num) AS patient_num, i.index, (hk IS NOT NULL)::INT AS IN_EPR, (patient_num IS NOT NULL)::INT AS IN_ICEES, 1996::INT AS year, quality
FROM l FULL JOIN v ON patient_num=p JOIN i ON person=coalesce('p:'||coalesce(p, patient_num), 's:'||hk)""")
def bn_survey_patients(spark, sf):
    """Patients with a survey under an index that two runs share."""
    return _survey(spark, sf, [])[0]


@query(f"""{_SURVEY}, e AS (SELECT patient_num, encounter_num FROM encounters WHERE year(start_date)=1996) SELECT encounter_num, i.index, (hk IS NOT NULL)::INT AS IN_EPR, (patient_num IS NOT NULL)::INT AS IN_ICEES, 1996::INT AS year, quality
FROM l FULL JOIN e ON patient_num=p JOIN i ON person=coalesce('p:'||coalesce(p, patient_num), 's:'||hk)""")
def bn_survey_visits(spark, sf):
    """Visits with a survey, without patient and survey key."""
    return _survey(spark, sf, ["encounter_num"])[1]


@query(""", p AS (SELECT patient_num, 2010+patient_num%2 AS year FROM patients WHERE patient_num%3<>0), l AS (SELECT doc_id AS patient_num, max(quality) AS quality FROM labels GROUP BY 1)
SELECT patient_num, coalesce(year,2010) AS year, (year IS NOT NULL)::INT AS IN_ICEES, (l.patient_num IS NOT NULL)::INT AS IN_EPR, quality FROM p FULL JOIN l USING (patient_num)""")
def bn_registry(spark, sf):
    k = F.col("patient_num")
    p = views.patients(spark, sf).where(k % 3 != 0).select("patient_num", (2010 + k % 2).alias("year"))
    s = views.table(spark, sf, "labels").groupBy(F.col("doc_id").alias("patient_num")).agg(F.max("quality").alias("quality"))
    return binning.with_registry(p, s, "patient_num", 2010)


@query(""", o AS (SELECT encounter_num, concept_cd||'_'||modifier_cd AS k, max((instance_num, nval_num::INT))[2] AS v FROM observations GROUP BY 1, 2) SELECT encounter_num, '{'||string_agg(k||':{nval:'||v||'}', ',' ORDER BY k)||'}' AS facts FROM o GROUP BY 1""")
def wh_nested(spark, sf):
    o = views.observations(spark, sf).withColumn("nval", F.col("nval_num").cast("int")).withColumn("tval", F.lit(None).cast("string"))
    n = warehouse.nested(o, ["encounter_num"], ["concept_cd", "modifier_cd"], ["nval", "tval"], ["instance_num", "nval"])
    return n.select("encounter_num", tables.as_text(F.col("facts"), n.schema["facts"].dataType).alias("facts"))


@query("""SELECT patient_num, '['||string_agg('{"encounter":'||encounter_num||',"type":"'||visit_type||'"}', ',' ORDER BY start_date, encounter_num)||']' AS visits FROM encounters GROUP BY 1""")
def wh_patient_series(spark, sf):
    return warehouse.patient_series(views.encounters(spark, sf))


_KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("SELECT encounter_num, " + ", ".join(f"bool_or(concept_cd LIKE '{k}.%') AS {k}" for k in _KINDS) + " FROM observations GROUP BY 1")
def wh_one_hot(spark, sf):
    o = views.observations(spark, sf).select("encounter_num", F.substring_index("concept_cd", ".", 1).alias("code"))
    return warehouse.one_hot(o, ["encounter_num"], "code", _KINDS)


@query("SELECT patient_num, lat, lon FROM patients WHERE lat IS NOT NULL AND patient_num%6<>0 AND patient_num%10<>0")
def wh_single_location(spark, sf):
    k = F.col("patient_num")
    row = lambda name, c: F.struct(F.lit(name).alias("name"), F.col(c).alias("value"))
    twice = F.when(k % 6 == 0, F.array(row("lat", "lat"), row("lat", "lon"), row("lon", "lon"))).when(k % 10 == 0, F.array(row("lat", "lat"))).otherwise(F.array(row("lat", "lat"), row("lon", "lon")))
    facts = views.patients(spark, sf).where("lat is not null").select("patient_num", F.explode(twice).alias("f")).select("patient_num", "f.*")
    return warehouse.single_location(facts, "patient_num", "name", "value")


@query(""", b AS (SELECT o_orderkey AS k, 'visit' AS name FROM orders UNION ALL SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'icd' ELSE 'loinc' END FROM lineitem)
SELECT k AS encounter_num, count(*) FILTER (name='visit') AS visit, count(*) FILTER (name='icd') AS icd, count(*) FILTER (name='loinc') AS loinc FROM b GROUP BY 1""")
def wh_wide_blocks(spark, sf):
    lines = views.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "encounter_num")
    blocks = {"visit": views.encounters(spark, sf), "icd": lines.where("l_returnflag = 'R'"), "loinc": lines.where("l_returnflag != 'R'")}
    return warehouse.wide_blocks(blocks, ["encounter_num"])


@query("SELECT encounter_num, min(start_date) AS first_start, count(*) AS facts FROM observations GROUP BY 1")
def wh_earliest_start(spark, sf):
    return views.observations(spark, sf).groupBy("encounter_num").agg(F.min("start_date").alias("first_start"), F.count("*").alias("facts"))


@query("""SELECT DISTINCT p_partkey, CASE p_partkey%4 WHEN 0 THEN p_type WHEN 1 THEN 'rxnorm:'||p_partkey WHEN 2 THEN 'ICD9:'||p_size ELSE replace(p_name,' ','_') END AS code FROM part""")
def co_plain_keys(spark, sf):
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    raw = F.when(k % 4 == 0, F.concat(F.lit("MDCTN:"), "p_type", F.lit("_x_3"))).when(k % 4 == 1, F.concat(text, F.lit("_2"))).when(k % 4 == 2, F.concat(F.lit("ICD9:"), "p_size", F.lit(".41_1"))).otherwise(F.col("p_name"))
    return views.table(spark, sf, "part").select("p_partkey", mapping.plain_key(raw).alias("code")).distinct()


@query(""", o AS (SELECT patient_num, o.start_date::DATE AS day, split_part(concept_cd,'.',1) AS code FROM observations o JOIN encounters e USING (encounter_num)),
b AS (SELECT DISTINCT patient_num, width, code, floor((date_diff('day', date '1970-01-01', day) + ('0x'||substr(md5(code),1,7))::BIGINT % width)/width::DOUBLE)::BIGINT AS bin FROM o, (SELECT unnest([30, 365]) AS width))
SELECT x.width::INT AS width, x.code AS code1, y.code AS code2, count(*) AS bins, count(DISTINCT x.patient_num) AS patients FROM b x JOIN b y ON x.patient_num=y.patient_num AND x.width=y.width AND x.bin=y.bin AND x.code<y.code GROUP BY ALL""")
def co_patient_pairs(spark, sf):
    o = views.observations(spark, sf).join(views.encounters(spark, sf).select("encounter_num", "patient_num"), "encounter_num")
    o = o.select("patient_num", F.to_date("start_date").alias("day"), F.substring_index("concept_cd", ".", 1).alias("code"))
    return warehouse.patient_pairs(o, "patient_num", "code", F.col("day"), [30, 365])


@query("SELECT encounter_num FROM observations GROUP BY 1 HAVING bool_and(concept_cd LIKE 'PROMO.%')")
def co_sole_code(spark, sf):
    """Visits all of whose codes are of one kind."""
    return warehouse.with_only(views.observations(spark, sf), ["encounter_num"], F.col("concept_cd").startswith("PROMO."))


@query("""SELECT visit_type, round(avg(log10(o_totalprice)),6) AS mean_log, count(DISTINCT encounter_num) AS visits, count(DISTINCT patient_num) AS patients FROM encounters JOIN orders ON o_orderkey=encounter_num JOIN patients USING (patient_num)
WHERE birth_date + INTERVAL 60 YEAR > start_date GROUP BY 1""")
def st_cohort(spark, sf):
    """Cohort below an age at the visit, by visit type."""
    price = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("encounter_num"), "o_totalprice")
    v = views.encounters(spark, sf).join(price, "encounter_num").join(views.patients(spark, sf).select("patient_num", "birth_date"), "patient_num")
    young = warehouse.younger_than(v, "birth_date", "start_date", 60)
    return young.groupBy("visit_type").agg(r(F.avg(F.log10("o_totalprice"))).alias("mean_log"), F.count_distinct("encounter_num").alias("visits"), F.count_distinct("patient_num").alias("patients"))
