import math
import random

import pytest
from pyspark.sql import functions as F

from vitalair.operators.quantiles import exact_quantiles
from vitalair.operators.spatial import geodesic, nearest_geodesic, nearest_line, nearest_place
from vitalair.operators.warehouse import hash_sample, t_probability


def test_known_geodesics(spark):
    rows = [(0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 0.0), (10.0, 20.0, 10.0, 20.0), (89.9, 0.0, 89.9, 180.0), (1.0, 179.9, 1.0, -179.9)]
    got = [r[0] for r in spark.createDataFrame(rows, "a double, b double, c double, d double").select(geodesic("a", "b", "c", "d")).collect()]
    assert abs(got[0] - 111319.491) < 0.001 and abs(got[1] - 110574.389) < 0.001 and got[2] == 0
    assert abs(got[3] - 2 * 11169.395) < 1 and abs(got[4] - 22260.5) < 10


def test_nearest_of_all_within_reach(spark):
    rng = random.Random(3)
    spot = lambda: (rng.choice([rng.uniform(-90, 90), rng.uniform(80, 90), rng.uniform(-2, 2)]), rng.choice([rng.uniform(-180, 180), rng.uniform(178, 180), rng.uniform(-180, -178)]))
    points = [(i, *spot()) for i in range(60)] + [(60, None, 3.0)]
    places = [(i, *spot()) for i in range(150)] + [(150, 91.0, 0.0), (151, None, None)]
    p, q = spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(places, "place long, lat double, lon double")
    all_ = p.crossJoin(q.where("lat between -90 and 90").withColumnsRenamed({"lat": "lat2", "lon": "lon2"})).where("lat is not null")
    best = {}
    for r in all_.select("id", "place", geodesic("lat", "lon", "lat2", "lon2").alias("d")).collect():
        if r.d is not None and r.d <= 400_000:
            best[r.id] = min(best.get(r.id, (math.inf, 0)), (r.d, r.place))
    got = {r.id: (r.distance, r.place) for r in nearest_geodesic(p, q, "id", "place", 400_000.0).collect()}
    assert len(got) == 61 and {k: v for k, v in got.items() if v[0] is not None} == best and len(best) > 20
    # However far: the search widens until every point has its nearest place.
    every = {}
    for r in all_.select("id", "place", geodesic("lat", "lon", "lat2", "lon2").alias("d")).collect():
        if r.d is not None:
            every[r.id] = min(every.get(r.id, (math.inf, 0)), (r.d, r.place))
    far = {r.id: (r.distance, r.place) for r in nearest_place(p, q.where("place < 4"), "id", "place").collect() if r.id < 60}
    few = {}
    for r in all_.where("place < 4").select("id", "place", geodesic("lat", "lon", "lat2", "lon2").alias("d")).collect():
        few[r.id] = min(few.get(r.id, (math.inf, 0)), (r.d if r.d is not None else math.inf, r.place))
    assert far == few and max(d for d, _ in few.values()) > 2_000_000
    got = {r.id: (r.distance, r.place) for r in nearest_place(p, q, "id", "place").collect() if r.id < 60}
    assert got == every
    assert nearest_geodesic(p, q.limit(0), "id", "place", 1000.0).where("place is null").count() == 61


def test_probabilities_of_known_quantiles(spark):
    rows = [(0.0, 5.0), (12.7062047, 1.0), (2.2281389, 10.0), (-1.9623391, 1000.0), (6.0, 30.0), (None, 3.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "t double, df double").select(t_probability("t", "df")).collect()]
    assert [round(x, 6) for x in got[:4]] == [1.0, 0.05, 0.05, 0.05] and abs(got[4] / 1.4109e-06 - 1) < 0.05 and got[5] is None


def test_sample_repeats(spark):
    df = spark.range(4000)
    one = {r.id for r in hash_sample(df, F.col("id"), 0.25).collect()}
    assert one == {r.id for r in hash_sample(df.repartition(7), F.col("id"), 0.25).collect()} and 850 < len(one) < 1150
    assert hash_sample(df, F.col("id"), 0).count() == 0 and hash_sample(df, F.col("id"), 1).count() == 4000


def test_quantiles_of_crowded_values(spark):
    rng = random.Random(2)
    rows = [(k % 3, float(rng.choice([1, 2, rng.randint(0, 10**6)])) if k % 50 else None) for k in range(5000)]
    df = spark.createDataFrame(rows, "k long, v double")
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, (0.0, 0.1, 0.5, 0.77, 1.0)))).alias("q")).collect()}
    got = {r.k: r.quantiles for r in exact_quantiles(df, ["k"], "v", [0.0, 0.1, 0.5, 0.77, 1.0]).collect()}
    assert got.keys() == want.keys() and all(abs(a - b) < 1e-6 * max(1, b) for k in want for a, b in zip(got[k], want[k]))
    assert exact_quantiles(df.where("v < 0"), [], "v", [0.5]).count() == 0


def test_long_segments_make_few_copies(spark):
    """A segment across 10 degrees at a radius of 500 m, found from its middle."""
    line = spark.createDataFrame([(1, 30.0, -100.0, 40.0, -90.0, "major")], "line long, lat1 double, lon1 double, lat2 double, lon2 double, kind string")
    points = spark.createDataFrame([(1, 30.0, -100.0), (2, 40.001, -90.0), (3, 10.0, -90.0), (4, None, None)], "id long, lat double, lon double")
    got = {r.id: (r.distance, r.line, r.kind) for r in nearest_line(points, line, "id", "line", 500.0, ("kind",)).collect()}
    assert got[1] == (0.0, 1, "major") and 50 < got[2][0] < 150 and got[3] == got[4] == (math.inf, None, None)


def test_quantiles_of_more_values_than_the_sketch_holds(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=60_000), np.full(30_000, 0.25), rng.integers(0, 5, 20_000).astype(float), rng.exponential(1e6, 90_000)])
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "k int, v double").repartition(7)
    shares = [0.0, 0.001, 0.2, 0.25, 0.4, 0.5, 0.75, 0.999, 1.0]
    every = exact_quantiles(df, [], "v", shares).first()
    assert every.n == len(values) and np.allclose(every.quantiles, np.quantile(values, shares), rtol=1e-12)
    for r in exact_quantiles(df, ["k"], "v", shares).collect():
        assert np.allclose(r.quantiles, np.quantile(values[r.k :: 2], shares), rtol=1e-12)


@pytest.mark.parametrize("few", [50_000, 1])
def test_no_task_holds_all_rows_of_a_frequent_key(spark, few):
    """Rows meet their brackets where they lie, or in parts of a key; by key they are never shuffled."""
    from vitalair.operators import quantiles

    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("_v"))
    brackets = spark.createDataFrame([(k, [1.0], [2.0]) for k in range(3)], "k long, _low array<double>, _high array<double>")
    met = quantiles._with_brackets(rows, brackets, ["k"], few)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20_000 and len(sizes) == 4 and max(sizes) < 10_000
    plan = exact_quantiles(rows.withColumnRenamed("_v", "v"), ["k"], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
