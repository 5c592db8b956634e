"""Queries: files with differing columns, environmental tables, cross-walks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalair.operators import exposure, quantiles, visits
from vitalair.plans import views
from vitalair.plans.catalog import query, r
from vitalair.sources import tables


@query("SELECT DISTINCT event_type, coalesce(v, 'none') AS value FROM (SELECT event_type, value::DECIMAL(10,2)::VARCHAR AS v FROM events WHERE event_id%2=0 UNION ALL SELECT event_type, NULL FROM events WHERE event_id%2=1)")
def src_concatenated(spark, sf):
    """CSV files with differing columns: those of a pattern, filled, repeated rows once."""
    e, path = views.table(spark, sf, "events"), tables.shared_folder(spark, "concat")
    tables.write_csv(e.where("event_id % 2 = 0").select("event_type", F.col("value").cast("decimal(10,2)").cast("string").alias("value"), "user_id"), f"{path}/a")
    tables.write_csv(e.where("event_id % 2 = 1").select("event_type", "user_id"), f"{path}/b")
    out = tables.concatenated(spark, [f"{path}/a", f"{path}/b"], "event_type|value", "none", file_column="file", distinct=True)
    return out.select("event_type", "value")


@query("SELECT row, col, count(*) AS n, round(sum(value),4) AS total FROM (SELECT (user_id%10)::INT AS row, (user_id%7)::INT AS col, value FROM events) GROUP BY ALL")
def src_by_cell(spark, sf):
    """Readings in one folder a grid cell."""
    path = tables.shared_folder(spark, "cells")
    e = views.table(spark, sf, "events").select((F.col("user_id") % 10).cast("int").alias("row"), (F.col("user_id") % 7).cast("int").alias("col"), "ts", "value")
    tables.write_by_key(e, ["row", "col"], path)
    return spark.read.parquet(path).groupBy("row", "col").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query("SELECT p_partkey, p_brand, p_size FROM part")
def src_json_lines(spark, sf):
    """Nested rows as lines of JSON and back."""
    p = views.table(spark, sf, "part").select("p_partkey", F.struct("p_brand", "p_size").alias("kind"), F.array("p_type").alias("types"))
    path = tables.shared_folder(spark, "json")
    tables.write_documents(p, path)
    return tables.read_documents(spark, path, p.schema).select("p_partkey", "kind.p_brand", "kind.p_size")


_A = ", a AS (SELECT user_id%20 AS FIPS, ts::DATE AS day, max(value) AS pm FROM events WHERE event_type='click' GROUP BY ALL), b AS (SELECT user_id%20 AS FIPS, ts::DATE AS day, max(value) AS o3 FROM events WHERE event_type='view' AND value>50 GROUP BY ALL)"


def _measures(spark, sf):
    e = views.table(spark, sf, "events").select((F.col("user_id") % 20).alias("FIPS"), F.to_date("ts").alias("day"), "event_type", "value")
    a = e.where("event_type = 'click'").groupBy(F.col("FIPS").cast("double").cast("string").alias("FIPS"), "day").agg(F.max("value").alias("pm (ug/m3)"))
    b = e.where("event_type = 'view'").groupBy(F.col("FIPS").cast("double").cast("string").alias("FIPS"), "day").agg(F.max(F.when(F.col("value") > 50, F.col("value"))).alias("o3 (ppb)"))
    return a, b


@query(f"{_A} SELECT FIPS, day, pm, o3 FROM a FULL JOIN b USING (FIPS, day)", day="day")
def en_merged_fields(spark, sf):
    """Two measure files: rows with nulls go, regions become numbers, units leave the names; full outer."""
    a, b = _measures(spark, sf)
    a, b = exposure.plain_measures(a, "FIPS", ["pm (ug/m3)"]), exposure.plain_measures(b, "FIPS", ["o3 (ppb)"])
    return exposure.merged_measures(a, b, ["FIPS", "day"], "full")


@query(f"{_A} SELECT FIPS, day, pm, pm+1 AS pm_2, 1.0::DOUBLE AS lat FROM a", day="day")
def en_side_by_side(spark, sf):
    a = exposure.plain_measures(_measures(spark, sf)[0], "FIPS", ["pm (ug/m3)"]).withColumn("lat", F.lit(1.0))
    return exposure.side_by_side(a, a.withColumn("pm", F.col("pm") + 1).withColumn("lat", F.lit(2.0)), ["FIPS", "day"], ["lat"])


@query(", d AS (SELECT cell, ts::DATE AS day, avg(value) AS m FROM readings GROUP BY ALL) SELECT cell, day, 2024::INT AS year, round(min(m) OVER p,6) AS m_min, round(stddev(m) OVER p,6) AS m_stddev, NULL::DOUBLE AS BENZ FROM d WINDOW p AS (PARTITION BY cell)", day="day")
def en_year_statistics(spark, sf):
    """Chosen statistics per year; a required column that the files lack is null; years of the study window."""
    d = exposure.daily(views.readings(spark, sf), ["cell"], "ts", "value").select("cell", "day", F.col("avg").alias("m")).withColumn("year", F.year("day"))
    d = d.where(F.col("year").isin(exposure.study_years("2024-01-01T05:00:00", "2025-01-01T05:00:00", -5)))
    d = tables.with_absent(exposure.with_period_statistics(d, ["cell"], "day", "year", ["m"], ("min", "stddev")), {"BENZ": "double"})
    return d.select("cell", "day", "year", r("m_min").alias("m_min"), r("m_stddev").alias("m_stddev"), "BENZ")


@query("SELECT cell AS id, ts::DATE AS start_date, value AS pm25 FROM readings WHERE ts::DATE BETWEEN date '2024-01-05' AND date '2024-01-09'", day="start_date")
def en_gathered_cells(spark, sf):
    d = views.readings(spark, sf).withColumn("day", F.to_date("ts"))
    return exposure.gathered_cells(d, {"cell": "id", "day": "start_date", "value": "pm25"}, "day", "2024-01-05", "2024-01-09")


@query("SELECT encounter_num, year(start_date)::INT AS year, patient_num FROM encounters")
def in_period_files(spark, sf):
    """Visits with the year from the file or from the date's text, in one folder a year."""
    path = tables.shared_folder(spark, "periods")
    v = views.encounters(spark, sf).select("encounter_num", "patient_num", F.when(F.col("encounter_num") % 3 != 0, F.year("start_date")).alias("year"), F.date_format("start_date", "yyyy-MM-dd").alias("day"))
    out = tables.not_empty(exposure.with_year(v, "year", "day").select("encounter_num", "patient_num", "year"))
    if out is None:
        return v.select("encounter_num", "year", "patient_num")
    tables.write_by_key(out, ["year"], path)
    return spark.read.parquet(path).select("encounter_num", "year", "patient_num")


@query("""SELECT patient_num, coalesce((quality=0)::INT,0) AS quality_0, coalesce((quality=1)::INT,0) AS quality_1, (a.doc_id IS NOT NULL)::INT AS confirmed, (b.doc_id IS NOT NULL)::INT AS in_registry FROM patients
LEFT JOIN (SELECT doc_id, quality FROM labels WHERE doc_id%2=0) a ON a.doc_id=patient_num LEFT JOIN (SELECT doc_id FROM labels WHERE doc_id%3=0) b ON b.doc_id=patient_num""")
def in_two_registries(spark, sf):
    labels = views.table(spark, sf, "labels").withColumnRenamed("doc_id", "patient_num")
    return visits.crosswalk(views.patients(spark, sf).select("patient_num"), labels.where("patient_num % 2 = 0").select("patient_num", "quality"), labels.where("patient_num % 3 = 0").select("patient_num", "toxic"), "patient_num", "quality", ["0", "1"])


@query("SELECT DISTINCT o_custkey AS patient_num FROM orders UNION SELECT doc_id FROM labels")
def pf_patient_list(spark, sf):
    orders = views.table(spark, sf, "orders").select(F.col("o_custkey").alias("patient_num"))
    return visits.patient_list(None, [orders, views.table(spark, sf, "labels").select(F.col("doc_id").alias("patient_num"))], "patient_num")


@query("""SELECT name, count(v) AS n, round(avg(v),4) AS mean, round(stddev(v),4) AS std, min(v) AS low, round(quantile_cont(v,0.25),4) AS q1, round(quantile_cont(v,0.5),4) AS median, round(quantile_cont(v,0.75),4) AS q3, max(v) AS high
FROM (SELECT 'l_quantity' AS name, l_quantity AS v FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem) GROUP BY 1""")
def pf_summaries(spark, sf):
    """Columns of many values: count, mean, deviation, extremes and exact quartiles."""
    long = views.table(spark, sf, "lineitem").select(F.expr("stack(3, 'l_quantity', l_quantity, 'l_extendedprice', l_extendedprice, 'l_tax', l_tax) AS (name, v)"))
    s = long.groupBy("name").agg(r(F.avg("v"), 4).alias("mean"), r(F.stddev("v"), 4).alias("std"), F.min("v").alias("low"), F.max("v").alias("high"))
    q = quantiles.exact_quantiles(long, ["name"], "v", [0.25, 0.5, 0.75])
    return s.join(q, "name").select("name", "n", "mean", "std", "low", *[r(F.col("quantiles")[i], 4).alias(c) for i, c in enumerate(("q1", "median", "q3"))], "high")
