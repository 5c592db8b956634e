"""Interval joins, reads of the cells that occur, wide arrays over many names."""

import random

import pytest
from pyspark.sql import functions as F

from vitalair.operators import spatial, warehouse
from vitalair.operators.intervals import in_intervals, with_periods


def drawn(seed, n_rows, n_intervals):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), rng.choice([None, rng.randint(-50, 3000), 100])) for i in range(n_rows)]
    spans = []
    for k in range(n_intervals):
        a = rng.randint(-100, 3000)
        spans.append((k, rng.choice("ab"), a, a + rng.choice([0, 1, 2, 3, 7, 8, 9, 365, 4000, -5])))
    return rows, spans + [(9001, "a", None, 5), (9002, "b", 5, None)]


@pytest.mark.parametrize("keys", [None, ["g"]])
def test_overlapping_intervals_of_all_lengths(spark, keys):
    rows, spans = drawn(4, 300, 120)
    a = spark.createDataFrame(rows, "id long, g string, at long")
    b = spark.createDataFrame(spans, "k long, g string, lo long, hi long")
    got = in_intervals(a, b if keys else b.drop("g"), F.col("at"), "lo", "hi", keys)
    want = [(i, g, at, k, lo, hi) for i, g, at in rows for k, h, lo, hi in spans if at is not None and lo is not None and hi is not None and lo <= at < hi and (not keys or g == h)]
    assert sorted(tuple(r[c] for c in ("id", "g", "at", "k", "lo", "hi")) for r in got.collect()) == sorted(want) and len(want) > 300


def test_ten_thousand_periods(spark):
    rng = random.Random(8)
    spans = sorted({(a, a + rng.randint(1, 400)) for a in (rng.randint(0, 200_000) for _ in range(10_000))})
    rows = [rng.randint(-10, 200_500) for _ in range(2_000)]
    b = spark.createDataFrame([(k, *x) for k, x in enumerate(spans)], "k long, lo long, hi long")
    got = in_intervals(spark.createDataFrame([(x,) for x in rows], "at long"), b, F.col("at"), "lo", "hi").groupBy("at").agg(F.count("*").alias("n"), F.sum("k").alias("s"))
    want = {}
    for x in rows:
        own = [k for k, (lo, hi) in enumerate(spans) if lo <= x < hi]
        if own:
            n, s = want.get(x, (0, 0))
            want[x] = (n + len(own), s + sum(own))
    assert {r.at: (r.n, r.s) for r in got.collect()} == want


def test_one_long_period_spreads_the_rows(spark):
    a = spark.range(0, 4000).withColumnRenamed("id", "at")
    b = spark.createDataFrame([("all", -10, 100_000)], "label string, lo long, hi long")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = in_intervals(a, b, F.col("at"), "lo", "hi")
    assert met.count() == 4000
    deal = a.select(F.pmod(F.xxhash64("at"), F.lit(n)).alias("p")).groupBy("p").count().collect()
    assert len(deal) == n


def test_empty_tables_and_clashes(spark):
    a = spark.createDataFrame([(1, "2020-01-01")], "id long, day string").withColumn("day", F.to_date("day"))
    b = spark.createDataFrame([("x", "2019-01-01", "2021-01-01")], "label string, a string, b string").select("label", F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert [tuple(r)[::2] for r in with_periods(a, "day", b, "label", "a", "b").collect()] == [(1, "x")]
    assert with_periods(a, "day", b.limit(0), "label", "a", "b").count() == 0
    assert with_periods(a.limit(0), "day", b, "label", "a", "b").count() == 0
    with pytest.raises(ValueError):
        in_intervals(a, b.withColumn("id", F.lit(1)), F.col("id"), "id", "id")


def leaves_of(plan):
    return [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]


def test_only_files_of_cells_that_occur_are_opened(spark, tmp_path):
    cells = [(y, r, c, float(r * c + d)) for y, rows, cols in ((2010, 112, 148), (2011, 299, 459)) for r in range(1, rows, 5) for c in range(1, cols, 5) for d in range(2)]
    spatial.write_grid_series(spark.createDataFrame(cells, "year int, row int, col int, m double").coalesce(1), f"{tmp_path}/cells")
    series = spark.read.parquet(f"{tmp_path}/cells")
    points = spark.createDataFrame([(1, 35.9132, -79.0558), (2, 40.0, -97.0), (3, 0.0, 0.0), (4, None, None)], "id long, lat double, lon double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = spatial.grid_series(points, series, "id", [2009, 2010, 2011])
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan()
        scan = next(x for x in leaves_of(plan) if "cells" in x.toString())
        opened = scan.metrics().apply("numFiles").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "PartitionFilters: [" in plan.toString() and "block" in plan.toString().split("PartitionFilters: [")[1].split("]")[0]
    blocks = {(y, (r - 1) // 8 * 1000 + (c - 1) // 8) for y, r, c in ((2010, 40, 116), (2010, 49, 72), (2011, 120, 347), (2011, 145, 214))}
    assert 0 < opened <= 8 * len(blocks) and len(series.inputFiles()) > 500
    at = {1: {2010: (40, 116), 2011: (120, 347)}, 2: {2010: (49, 72), 2011: (145, 214)}}
    want = [(i, y, r, c, m) for i, own in at.items() for y, r, c, m in cells if own[y] == (r, c)]
    assert sorted((r.id, r.year, r.row, r.col, r.m) for r in rows) == sorted(want)
    plain = spatial.grid_series(points, series.drop("block"), "id", [2010, 2011])
    assert sorted((r.id, r.year, r.row, r.col, r.m) for r in plain.collect()) == sorted(want)


def test_fifty_thousand_names(spark):
    rng = random.Random(2)
    facts = [(k, f"name{rng.randrange(50_000):05d}", rng.randint(1, 3), float(rng.randint(0, 9))) for k in range(6) for _ in range(400)]
    names = sorted({f"name{i:05d}" for i in range(50_000)})
    df = spark.createDataFrame(facts, "id long, name string, instance_num int, v double")
    table = warehouse.names_table(spark.createDataFrame([(n,) for n in names], "name string"), "name")
    first = {}
    for k, n, i, v in facts:
        first[k, n] = min(first.get((k, n), (99, 0)), (i, v))
    got = warehouse.wide_by_name(df, ["id"], "name", ["v"], table)
    assert "name00042" not in got._jdf.queryExecution().toString()
    for r in got.collect():
        want = [None] * 50_000
        for (k, n), (_, v) in first.items():
            if k == r.id:
                want[int(n[4:])] = v
        assert r.v == want
