"""Environmental series: daily aggregates, scores, study periods, trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily(readings: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Average, maximum, minimum and sample deviation per key and day."""
    v = F.col(value)
    return readings.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.avg(v).alias("avg"), F.max(v).alias("max"), F.min(v).alias("min"), F.stddev(v).alias("stddev"))


def step_score(value: Column, edges: list[float]) -> Column:
    """1 below the first edge, one more from each edge on; null stays null."""
    return F.when(value.isNotNull(), sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(1)))


def trailing_average(df: DataFrame, keys: list[str], day: str, value: str, days: int = 7) -> Column:
    """Average over the calendar days (d - days, d]."""
    w = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    return F.avg(value).over(w)


def study_period(day: Column, bounds: list[str], labels: list[str]) -> Column:
    """Label of the half-open period that holds the day; null outside."""
    out = F.lit(None).cast("string")
    for a, b, label in reversed(list(zip(bounds, bounds[1:], labels))):
        out = F.when((day >= F.lit(a).cast("date")) & (day < F.lit(b).cast("date")), label).otherwise(out)
    return out


STATISTICS = {"avg": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev}


def with_period_statistics(df: DataFrame, keys: list[str], day: str, period: str, measures: list[str], statistics: tuple[str, ...] = ("avg", "max")) -> DataFrame:
    """Add each measure's statistics over its period and its value on the calendar day before."""
    per = Window.partitionBy(*keys, period)
    before = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-1, -1)
    more = {}
    for m in measures:
        more |= {f"{m}_{s}": STATISTICS[s](m).over(per) for s in statistics} | {f"{m}_prev_date": F.max(m).over(before)}
    return df.withColumns(more)


def lag_exposure(visits: DataFrame, series: DataFrame, keys: list[str], day: str, measure: str, lags: int = 7) -> DataFrame:
    """One row a visit and lag: the measure so many days before the visit; null where there is none."""
    asked = visits.withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(lags - 1)))).withColumn("_day", F.date_sub(day, F.col("lag")))
    return asked.join(series.select(*keys, F.col(day).alias("_day"), measure), [*keys, "_day"], "left").drop("_day")


def region_series(patients: DataFrame, series: DataFrame, region: str) -> DataFrame:
    """The series of each patient's region; patients without region or series go."""
    return patients.join(series, region)


def slash_date(text: Column, pattern: str = "MMM-dd-yyyy") -> Column:
    """Date text in another pattern as yyyy/MM/dd; null if it isn't one."""
    return F.date_format(F.to_date(F.try_to_timestamp(text, F.lit(pattern))), "yyyy/MM/dd")


def merged_measures(a: DataFrame, b: DataFrame, keys: list[str], how: str = "full", suffix: str = "_2") -> DataFrame:
    """Two measure tables side by side; names that clash get the suffix on the second side."""
    clash = [c for c in b.columns if c in a.columns and c not in keys]
    return a.join(b.withColumnsRenamed({c: c + suffix for c in clash}), keys, how)


def study_years(start: str, end: str, offset_hours: int) -> list[int]:
    """Years of the local days of a window whose last instant is not part of it."""
    from datetime import datetime, timedelta

    shift = timedelta(hours=offset_hours)
    last = datetime.fromisoformat(end) + shift - timedelta(microseconds=1)
    return list(range((datetime.fromisoformat(start) + shift).year, last.year + 1))


def plain_measures(df: DataFrame, region: str, measures: list[str]) -> DataFrame:
    """Rows without nulls, regions as whole numbers, measures without the unit in their names (`PM2.5 (ug/m3)`)."""
    named = {m: m.split("(")[0].strip() for m in measures}
    return df.dropna().withColumn(region, F.col(region).cast("double").cast("long")).withColumnsRenamed(named)


def side_by_side(a: DataFrame, b: DataFrame, keys: list[str], places: list[str]) -> DataFrame:
    """Two yearly measure tables on their keys (inner): the second side's places go, other clashes get `_2`."""
    return merged_measures(a, b.drop(*[p for p in places if p not in keys]), keys, "inner")


def gathered_cells(cells: DataFrame, columns: dict[str, str], day: str, first: str, last: str) -> DataFrame:
    """Readings of cells: renamed columns, days from first to last."""
    return cells.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).select(*[F.col(c).alias(n) for c, n in columns.items()])


def with_year(df: DataFrame, year: str, day_text: str) -> DataFrame:
    """The year where it is missing, from the text of the day."""
    return df.withColumn(year, F.coalesce(year, F.year(F.to_date(day_text))))
