"""Join of points in time with a table of half-open intervals that may overlap and differ in length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_intervals(rows: DataFrame, intervals: DataFrame, at: Column, start: str, end: str, keys: list[str] | None = None) -> DataFrame:
    """Rows with the other columns of each interval [start, end) that holds `at`, of the row's own keys if there are any.

    at, start and end are whole numbers (days, microseconds). An interval is dealt to
    the two buckets it can touch at the level where a bucket is as wide as the next
    power of two; a row asks one bucket at each level that occurs, so both sides
    meet by an equi-join and the bounds decide. A level with few buckets (long
    intervals) would bring all rows to few keys: there, intervals are copied to
    places and rows dealt over them, so a level has as many keys as there are
    partitions. Rows and intervals with a null bound, and empty intervals, meet none.
    """
    keys = keys or []
    clash = [c for c in intervals.columns if c in rows.columns and c not in keys]
    if clash:
        raise ValueError(f"columns of both tables: {clash}")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = F.col(start), F.col(end)
    leveled = intervals.where(a < b).withColumn("_level", F.ceil(F.log2((b - a).cast("double"))).cast("int"))
    found = leveled.groupBy("_level").agg(F.min(start).alias("lo"), F.max(end).alias("hi")).orderBy("_level").collect()  # 64 rows at most
    places = {r["_level"]: 1 if keys else max(1, n // ((int(r["hi"]) >> r["_level"]) - (int(r["lo"]) >> r["_level"]) + 1)) for r in found}
    if not places:
        return rows.join(intervals.limit(0), keys or F.lit(False))
    own = F.element_at(F.create_map(*[F.lit(x) for p in places.items() for x in p]), F.col("_level"))
    down = lambda c, k: F.floor(c / F.pow(F.lit(2.0), k)).cast("long")
    spread = leveled.withColumn("_bucket", F.explode(F.array_distinct(F.array(down(a, F.col("_level")), down(b - 1, F.col("_level"))))))
    spread = spread.withColumn("_place", F.explode(F.sequence(F.lit(0), own - 1)))
    deal = F.xxhash64(*rows.columns)
    asked = F.array(*[F.named_struct(F.lit("_level"), F.lit(k), F.lit("_bucket"), down(at, F.lit(k)), F.lit("_place"), F.pmod(deal, F.lit(p)).cast("int")) for k, p in places.items()])
    asking = rows.withColumn("_at", at).where("_at is not null").withColumn("_k", F.explode(asked)).select("*", "_k.*").drop("_k")
    met = asking.join(spread, [*keys, "_level", "_bucket", "_place"]).where((F.col("_at") >= a) & (F.col("_at") < b))
    return met.select(*rows.columns, *[c for c in intervals.columns if c not in keys])


def with_periods(df: DataFrame, day: str, periods: DataFrame, label: str, start: str, end: str) -> DataFrame:
    """A row for each period [start, end) of days that holds the day; days of no period go. Periods are a table of any size."""
    days = periods.select(F.col(label), F.unix_date(start).cast("long").alias("_start"), F.unix_date(end).cast("long").alias("_end"))
    return in_intervals(df, days, F.unix_date(day).cast("long"), "_start", "_end").drop("_start", "_end")
