"""Domain views over the given tables: patients, encounters, observations, readings, facilities, regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def patients(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    lost = k % 11 == 0
    return table(spark, sf_dir, "customer").select(
        k.alias("patient_num"), F.date_add(F.lit("1930-01-01").cast("date"), (k * 97 % 25000).cast("int")).alias("birth_date"),
        F.element_at(F.array(*map(F.lit, ["male", "female", "other"])), (k % 3 + 1).cast("int")).alias("gender"),
        F.element_at(F.array(*map(F.lit, ["2106-3", "2054-5", "2028-9", "2076-8", "1002-5", "Unknown", "x"])), (k % 7 + 1).cast("int")).alias("race"),
        F.when(~lost, 25 + (k * 37 % 2400) / 100).alias("lat"), F.when(~lost, -120 + (k * 91 % 5000) / 100).alias("lon"),
    )


def encounters(spark, sf_dir) -> DataFrame:
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "EMER").when(F.col("o_orderpriority") == "2-HIGH", "IMP").otherwise("AMB")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("encounter_num"), F.col("o_custkey").alias("patient_num"), F.col("o_orderdate").alias("start_date"), kind.alias("visit_type"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int")).alias("day"),
    )


def observations(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.col("l_orderkey").alias("encounter_num"), F.concat("p_type", F.lit("."), "p_size").alias("concept_cd"), F.col("l_returnflag").alias("modifier_cd"),
        F.col("l_linenumber").alias("instance_num"), F.col("l_quantity").alias("nval_num"), F.col("l_shipdate").alias("start_date"),
    )


def readings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("cell"), F.col("event_type").alias("measure"), "ts", "value")


def facilities(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("facility"), (24 + (k * 53 % 2600) / 100).alias("lat"), (-121 + (k * 71 % 5200) / 100).alias("lon"))


#: The same views for the SQL that results are checked against.
SQL = """
patients AS (SELECT c_custkey AS patient_num, date '1930-01-01' + (c_custkey*97%25000)::INT AS birth_date, ['male','female','other'][c_custkey%3+1] AS gender,
  ['2106-3','2054-5','2028-9','2076-8','1002-5','Unknown','x'][c_custkey%7+1] AS race,
  CASE WHEN c_custkey%11<>0 THEN 25+(c_custkey*37%2400)/100.0::DOUBLE END AS lat, CASE WHEN c_custkey%11<>0 THEN -120+(c_custkey*91%5000)/100.0::DOUBLE END AS lon FROM customer),
encounters AS (SELECT o_orderkey AS encounter_num, o_custkey AS patient_num, o_orderdate AS start_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'EMER' WHEN '2-HIGH' THEN 'IMP' ELSE 'AMB' END AS visit_type, date '2024-01-01' + (o_orderkey%30)::INT AS day FROM orders),
observations AS (SELECT l_orderkey AS encounter_num, p_type||'.'||p_size AS concept_cd, l_returnflag AS modifier_cd, l_linenumber AS instance_num, l_quantity AS nval_num, l_shipdate AS start_date
  FROM lineitem JOIN part ON l_partkey=p_partkey),
readings AS (SELECT user_id AS cell, event_type AS measure, ts, value FROM events),
facilities AS (SELECT s_suppkey AS facility, 24+(s_suppkey*53%2600)/100.0::DOUBLE AS lat, -121+(s_suppkey*71%5200)/100.0::DOUBLE AS lon FROM supplier)
"""
