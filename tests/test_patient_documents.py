"""Patient documents on facts of one key that meet on one day or lack a value, against their SQL."""

import shutil

import duckdb
from pyspark.sql import functions as F

from vitalair.plans import registry


def test_last_instant_and_missing_values(spark, sf, tmp_path):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    at = lambda c, hours: F.col(c) + F.expr(f"interval {hours} hours")
    later = lines.where("l_orderkey % 3 = 0").withColumns({"l_shipdate": at("l_shipdate", 5), "l_quantity": F.col("l_quantity") - 1})  # less, but later that day
    empty = lines.where("l_orderkey % 5 = 0").withColumns({"l_shipdate": at("l_shipdate", 30), "l_quantity": F.lit(None).cast("double")})  # last, without a value
    never = lines.where("l_orderkey % 7 = 0").withColumns({"l_linenumber": F.col("l_linenumber") + 100, "l_quantity": F.lit(None).cast("double")})
    lines.where("l_orderkey % 11 != 0").unionByName(later).unionByName(empty).unionByName(never).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    for t in ("orders", "part", "customer", "supplier", "events"):
        shutil.copy(f"{sf}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    c = duckdb.connect()
    for t in ("orders", "part", "customer", "supplier", "events", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet{'/*.parquet' if t == 'lineitem' else ''}'")
    names = ["patient_num", "observations", "seen", "visits", "stays"]
    want = c.execute(f"SELECT {', '.join(names)} FROM ({registry.oracle_sql()['wh_patient_documents']})").fetchall()
    got = registry.queries()["wh_patient_documents"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want)
