"""Queries: bins for models, trees and networks on visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.operators import models, visits, warehouse
from vitalair.plans import views
from vitalair.sources import tables
from vitalair.plans.catalog import query, r

_COUNTS = """, c AS (SELECT e.encounter_num, count(o.encounter_num) FILTER (o.start_date::DATE < e.start_date::DATE) AS pre_ed, count(o.encounter_num) FILTER (o.start_date::DATE > e.start_date::DATE) AS post_ed
FROM encounters e LEFT JOIN encounters o ON o.patient_num=e.patient_num AND o.visit_type IN ('EMER','IMP') AND abs(date_diff('day', o.start_date::DATE, e.start_date::DATE)) BETWEEN 1 AND 365 GROUP BY 1)"""


def _visits(spark, sf) -> DataFrame:
    e = views.encounters(spark, sf)
    both = e.join(views.patients(spark, sf).select("patient_num", "birth_date"), "patient_num").join(warehouse.before_and_after(e), "encounter_num")
    return both.select(
        "encounter_num", models.age_bin(F.col("birth_date"), F.col("start_date"), [5, 18, 45, 65]).alias("age_bin"), models.visit_count_bin(F.col("pre_ed")).cast("int").alias("pre_bin"),
        models.visit_count_bin(F.col("post_ed")).cast("int").alias("post_bin"), (F.col("visit_type") == "EMER").cast("int").alias("emergency"), F.month("start_date").alias("month"),
    )


@query(f"""{_COUNTS} SELECT encounter_num, least(pre_ed,3)::INT AS pre_bin, least(post_ed,3)::INT AS post_bin, list_sum([(date_diff('day', birth_date, start_date::DATE)/365.25>=k)::INT FOR k IN [5,18,45,65]])::INT AS age_bin
FROM encounters JOIN patients USING (patient_num) JOIN c USING (encounter_num)""")
def ml_bins(spark, sf):
    return _visits(spark, sf).select("encounter_num", "pre_bin", "post_bin", "age_bin")


@query(None)
def ml_tree(spark, sf):
    """Class of later emergency visits by a tree, for every visit."""
    v = _visits(spark, sf)
    return models.scored(models.fit_tree(v, ["age_bin", "pre_bin", "emergency", "month"], "post_bin"), v)


@query(None)
def ml_network(spark, sf):
    """Whether an order line was returned, by a feed-forward network on quantity, discount and age of the line."""
    kind = lambda k: (F.col("l_returnflag") == k).cast("double")
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", F.unix_date(F.to_date("l_shipdate")).cast("double").alias("day"), kind("R").alias("returned"), (1 - kind("R")).alias("kept"))
    return models.scored(models.fit_network(rows, ["l_quantity", "l_discount", "day"], ["kept", "returned"], [6], epochs=20), rows)


def _scoring(spark, sf) -> DataFrame:
    """All visits with visits of the year before and after from one window, exposure or its default, code flags."""
    e = views.encounters(spark, sf).withColumn("cell", F.col("patient_num") % 100)
    x = views.readings(spark, sf).where("value > 30").groupBy("cell", F.to_date("ts").alias("day")).agg(r(F.avg("value")).alias("pm"))
    o = views.observations(spark, sf).where("modifier_cd = 'A'").withColumn("code", F.substring_index("concept_cd", ".", 1))
    around = warehouse.before_and_after(views.encounters(spark, sf))
    out = models.scoring_rows(e, around, x, warehouse.one_hot(o, ["encounter_num"], "code", ["PROMO", "SMALL"]), "encounter_num", ["cell", "day"], "pm", 2.5)
    return out.select("encounter_num", "pre_ed", "post_ed", "pm", "PROMO", "SMALL")


@query(f"""{_COUNTS}, x AS (SELECT cell, ts::DATE AS day, round(avg(value),6) AS pm FROM readings WHERE value > 30 GROUP BY ALL), f AS (SELECT encounter_num, bool_or(concept_cd LIKE 'PROMO%') AS PROMO, bool_or(concept_cd LIKE 'SMALL%') AS SMALL FROM observations WHERE modifier_cd='A' GROUP BY 1)
SELECT encounter_num, pre_ed, coalesce(pm, 2.5) AS pm, coalesce(PROMO, false) AS PROMO, coalesce(SMALL, false) AS SMALL FROM encounters e JOIN c USING (encounter_num) LEFT JOIN x ON x.cell = e.patient_num % 100 AND x.day = e.day LEFT JOIN f USING (encounter_num)""")
def ml_scoring_rows(spark, sf):
    """All visits with what the tree scores: visits of the year before, exposure or its default, code flags."""
    return _scoring(spark, sf).drop("post_ed")


@query(None)
def ml_pruned_tree(spark, sf):
    """All visits scored by a pruned tree on what ml_scoring_rows gives: the class of later emergency visits."""
    flags = [F.col(c).cast("int").alias(c) for c in ("PROMO", "SMALL")]
    after = models.visit_count_bin(F.col("post_ed")).cast("double").alias("post_bin")
    rows = tables.stored(_scoring(spark, sf).select("encounter_num", "pre_ed", "pm", *flags, after), "scoring")
    tree = models.fit_pruned(rows, ["pre_ed", "pm", "PROMO", "SMALL"], "post_bin", "encounter_num")
    return rows.withColumn("predicted", models.tree_class(tree))


@query(""", a AS (SELECT cell, ts::DATE AS day, max(value) AS pm FROM readings WHERE measure='click' GROUP BY ALL), b AS (SELECT cell, ts::DATE AS day, max(value) AS o3 FROM readings WHERE measure='view' GROUP BY ALL)
SELECT encounter_num, pm, o3 FROM encounters e LEFT JOIN a ON a.cell = e.patient_num % 100 AND a.day = e.day LEFT JOIN b ON b.cell = e.patient_num % 100 AND b.day = e.day""")
def in_two_exposures(spark, sf):
    """Visits with two environmental tables by patient and day."""
    e = views.encounters(spark, sf).withColumn("cell", F.col("patient_num") % 100)
    top = lambda m, n: views.readings(spark, sf).where(F.col("measure") == m).groupBy("cell", F.to_date("ts").alias("day")).agg(F.max("value").alias(n))
    for m, n in (("click", "pm"), ("view", "o3")):
        e = visits.with_exposure(e, top(m, n), ["cell", "day"])
    return e.select("encounter_num", "pm", "o3")
