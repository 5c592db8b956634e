"""Every registered query of the library proper against its SQL, on the smallest tables."""

import duckdb
import pytest

from vitalair.plans import registry

TABLES = "region nation customer supplier part orders lineitem events labels embeddings".split()


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def same(x):
    return None if x is None or x != x else round(float(x), 6) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(name, spark, sf, duck):
    got = registry.queries()[name](spark, sf)
    columns = sorted(got.columns)
    if name not in registry.oracle_sql():
        assert got.count()
        return
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    rows = [tuple(map(same, r)) for r in got.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted((tuple(map(same, r)) for r in want), key=repr)
    assert rows


def test_projection_check_values(spark):
    from pyspark.sql import functions as F

    from vitalair.operators.spatial import grid_cell

    df = spark.createDataFrame([(35.9132, -79.0558), (40.0, -97.0), (25.0, -120.0), (0.0, 0.0)], "lat double, lon double")
    got = [(r.a, r.b) for r in df.select(grid_cell(F.col("lat"), F.col("lon"), 2010).alias("a"), grid_cell(F.col("lat"), F.col("lon"), 2011).alias("b")).collect()]
    assert [(a and tuple(a), b and tuple(b)) for a, b in got] == [((40, 116), (120, 347)), ((49, 72), (145, 214)), ((10, 6), (30, 18)), (None, None)]


def test_quantile_bins_with_equal_edges_are_null(spark):
    from vitalair.operators.binning import quantile_bins

    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "v double")
    assert {r.b for r in quantile_bins(df, "v", 4, "b").collect()} == {None}
