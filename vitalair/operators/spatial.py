"""Places: projection, grid cells, nearest points."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalair.operators import quadtree
from vitalair.sources.tables import stored

#: WGS84 and the Lambert conformal conic projection (parallels 33 and 45, origin 40 N 97 W), in degrees and metres.
A, FLATTENING = 6378137.0, 1 / 298.257223563
LAT1, LAT2, LAT0, LON0 = 33.0, 45.0, 40.0, -97.0
FALSE_ORIGIN = (-2556000.0, -1728000.0)
GRIDS = {2010: (148, 112, 36000.0), 2011: (459, 299, 12000.0)}

E = math.sqrt(FLATTENING * (2 - FLATTENING))


def _constants() -> tuple[float, float, float]:
    m = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - (E * math.sin(math.radians(d))) ** 2)
    t = lambda d: math.tan(math.pi / 4 - math.radians(d) / 2) / ((1 - E * math.sin(math.radians(d))) / (1 + E * math.sin(math.radians(d)))) ** (E / 2)
    n = (math.log(m(LAT1)) - math.log(m(LAT2))) / (math.log(t(LAT1)) - math.log(t(LAT2)))
    f = m(LAT1) / (n * t(LAT1) ** n)
    return n, f, A * f * t(LAT0) ** n


def projected(lat: Column, lon: Column) -> tuple[Column, Column]:
    """x and y in metres."""
    n, f, rho0 = _constants()
    phi, s = F.radians(lat), F.sin(F.radians(lat))
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s * E) / (1 + s * E), F.lit(E / 2))
    rho, theta = F.pow(t, F.lit(n)) * (A * f), F.radians(lon - LON0) * n
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def grid_cell(lat: Column, lon: Column, year: int) -> Column:
    """struct(row, col) of the year's grid; null outside."""
    cols, rows, width = GRIDS[year]
    x, y = projected(lat, lon)
    col, row = F.floor((x - FALSE_ORIGIN[0]) / width) + 1, F.floor((y - FALSE_ORIGIN[1]) / width) + 1
    return F.when(col.between(1, cols) & row.between(1, rows), F.struct(row.cast("int").alias("row"), col.cast("int").alias("col")))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres on a sphere of 6371008.8 m."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return F.asin(F.sqrt(h)) * (2 * 6371008.8)


def region_of(points: DataFrame, edges: DataFrame, key: str, region: str, draw: int = quadtree.DRAW) -> DataFrame:
    """Least region whose polygon holds the point (even-odd rule, so holes and several rings count); null if none or without a place.

    edges: one row a side, (region, lat1, lon1, lat2, lon2). Different places are dealt
    to the leaves of a quadtree that is fine where places or sides are dense. A leaf
    gets the sides that a ray to the east from it can cross. Those that every such
    ray crosses are summed up to a parity; where no others are left the leaf lies
    wholly inside or outside the region, and its places test no side.
    """
    named = edges.select(F.col(region).alias("region"), *[F.col(c).cast("double") for c in ("lat1", "lon1", "lat2", "lon2")])
    named = named.join(named.groupBy("region").agg(F.min(F.least("lon1", "lon2")).alias("west_most")), "region")
    at = stored(points.where("lat is not null and lon is not null").select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).distinct(), "locations")
    middles = named.select(((F.col("lat1") + F.col("lat2")) / 2).alias("lat"), ((F.col("lon1") + F.col("lon2")) / 2).alias("lon"))
    box = at.agg(*[f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for f, n in ((F.min, "lo"), (F.max, "hi"))])  # one row
    inside_box = F.col("lat").between(F.col("lo_lat"), F.col("hi_lat")) & F.col("lon").between(F.col("lo_lon"), F.col("hi_lon"))
    near = middles.join(F.broadcast(box), F.lit(True)).where(inside_box).select("lat", "lon")
    tree = quadtree.fitted(at.unionByName(near), "lon", "lat", draw)
    if tree is None:
        return points.select(key).withColumn(region, F.lit(None).cast(edges.schema[region].dataType))
    east, low, high = F.greatest("lon1", "lon2"), F.least("lat1", "lat2"), F.greatest("lat1", "lat2")
    slack = 1e-9 * (tree.width + tree.height)
    # A leaf has all sides that matter there or none of the region: leaves west of it all are left out.
    known = quadtree.touched(named, tree, F.col("west_most"), east, low, high).where(F.col("east") >= F.col("west_most") - slack)
    fixed = (F.least("lon1", "lon2") > F.col("east") + slack) & (low <= F.col("south") - slack) & (high >= F.col("north") + slack)
    cover = stored(known.select("leaf", "region", fixed.alias("fixed"), "lat1", "lon1", "lat2", "lon2"), "cover")
    parity = cover.groupBy("leaf", "region").agg((F.count_if(F.col("fixed")) % 2).alias("odd"), F.count_if(~F.col("fixed")).alias("sides"))
    dealt = stored(quadtree.with_leaf(at, tree, "lon", "lat"), "dealt")
    whole = dealt.join(parity.where("sides = 0 and odd = 1").select("leaf", "region"), "leaf").select("lat", "lon", "region")
    tests = cover.where("not fixed").join(parity.where("sides > 0").select("leaf", "region", "odd"), ["leaf", "region"])
    spans = (F.col("lat1") > F.col("lat")) != (F.col("lat2") > F.col("lat"))
    cut = F.col("lon1") + (F.col("lat") - F.col("lat1")) / (F.col("lat2") - F.col("lat1")) * (F.col("lon2") - F.col("lon1"))
    crossed = F.coalesce((spans & (F.when(spans, cut) > F.col("lon"))).cast("int"), F.lit(0))
    counted = dealt.join(tests, "leaf").groupBy("lat", "lon", "region").agg(((F.sum(crossed) + F.max("odd")) % 2).alias("odd")).where("odd = 1").select("lat", "lon", "region")
    found = whole.unionByName(counted).groupBy("lat", "lon").agg(F.min("region").alias(region))
    own = points.select(key, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    return own.join(found, ["lat", "lon"], "left").select(key, region)


def region_attributes(located: DataFrame, attributes: DataFrame, region: str, prefix: str, names: dict[str, str]) -> DataFrame:
    """Attributes of each row's region, found under prefix + region id, with new names; rows without any go."""
    own = attributes.select(F.col(region).alias("_region"), *[F.col(k).alias(v) for k, v in names.items()])
    return located.withColumn("_region", F.concat(F.lit(prefix), F.col(region).cast("string"))).join(own, "_region").drop("_region")


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to a segment in the plane."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - x1) * dx + (y - y1) * dy) / square))).otherwise(0.0)
    return F.sqrt(F.pow(x - x1 - t * dx, F.lit(2)) + F.pow(y - y1 - t * dy, F.lit(2)))


def nearest_line(points: DataFrame, lines: DataFrame, key: str, line: str, radius: float, attributes: tuple[str, ...] = (), draw: int = quadtree.DRAW) -> DataFrame:
    """Nearest segment within a radius in metres of the projected plane: distance, line and its attributes; infinity and null if none.

    lines: one row a segment, (line, lat1, lon1, lat2, lon2, attributes). Different
    places are dealt to the leaves of a quadtree that is fine where they are dense.
    A segment is cut into stretches of one radius at most, and each meets the
    leaves within a radius. Of those a leaf keeps the ones that can be nearest to
    some place in it: in a dense town, whose leaves are small, a few.
    """
    a, b = projected(F.col("lat1"), F.col("lon1")), projected(F.col("lat2"), F.col("lon2"))
    flat = lines.select(F.struct(F.col(line).alias("line"), *attributes).alias("own"), a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), F.lit(2)) + F.pow(F.col("y2") - F.col("y1"), F.lit(2)))
    parts = flat.withColumn("n", F.greatest(F.ceil(length / radius), F.lit(1))).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    end = lambda c, k: F.col(f"{c}1") + (F.col(f"{c}2") - F.col(f"{c}1")) * k / F.col("n")
    sides = [f(end(c, F.col("k") - 1), end(c, F.col("k"))) + d for c in "xy" for f, d in ((F.least, -radius), (F.greatest, radius))]
    p = projected(F.col("lat"), F.col("lon"))
    places = points.where("lat is not null and lon is not null").select("lat", "lon").distinct().withColumn("x", p[0]).withColumn("y", p[1])
    at = stored(places, "locations")
    tree = quadtree.fitted(at, "x", "y", draw)
    if tree is None:
        found = at.select("lat", "lon").crossJoin(flat.select("own").limit(0)).withColumn("m", F.struct(F.lit(None).cast("double").alias("distance"), "own")).select("lat", "lon", "m")
    else:
        met = quadtree.touched(parts, tree, *sides).select("leaf", "own", "x1", "y1", "x2", "y2", "west", "south", "east", "north").distinct()
        half = F.sqrt(F.pow(F.col("east") - F.col("west"), F.lit(2)) + F.pow(F.col("north") - F.col("south"), F.lit(2))) / 2 * (1 + 1e-6) + 1e-3
        off = segment_distance((F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2, *map(F.col, ("x1", "y1", "x2", "y2")))
        met = stored(met.select("leaf", "own", "x1", "y1", "x2", "y2", off.alias("off"), half.alias("half")), "lines-by-leaf")
        least = met.groupBy("leaf").agg(F.min("off").alias("least"))
        kept = met.join(least, "leaf").where((F.col("off") - F.col("half") <= F.col("least") + F.col("half")) & (F.col("off") - F.col("half") <= radius))
        d = segment_distance(*map(F.col, ("x", "y", "x1", "y1", "x2", "y2")))
        near = quadtree.with_leaf(at, tree, "x", "y").join(kept.drop("off", "half", "least"), "leaf").withColumn("distance", d).where(F.col("distance") <= radius)
        found = near.groupBy("lat", "lon").agg(F.min(F.struct("distance", "own")).alias("m"))
    out = points.select(key, "lat", "lon").join(found, ["lat", "lon"], "left")
    return out.select(key, F.coalesce("m.distance", F.lit(float("inf"))).alias("distance"), F.col("m.own.line").alias(line), *[F.col(f"m.own.{c}").alias(c) for c in attributes])


@F.pandas_udf(T.DoubleType())
def geodesic(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """Metres between two points along the ellipsoid (Vincenty's inverse formula, to a millimetre).

    Points nearly opposite on the globe, where the formula doesn't settle, give null.
    """
    import numpy as np

    f, b = FLATTENING, A * (1 - FLATTENING)
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(x.to_numpy(float)))) for x in (lat1, lat2))
    turn = np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
    turn = (turn + np.pi) % (2 * np.pi) - np.pi
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam, settled = turn.copy(), np.zeros(len(turn), bool)
    with np.errstate(all="ignore"):
        for _ in range(50):
            sin_s = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
            cos_s = s1 * s2 + c1 * c2 * np.cos(lam)
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s > 0, c1 * c2 * np.sin(lam) / sin_s, 0.0)
            cos2_a = 1 - sin_a**2
            mid = np.where(cos2_a > 1e-15, cos_s - 2 * s1 * s2 / cos2_a, 0.0)
            c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
            new = turn + (1 - c) * f * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
            settled |= np.abs(new - lam) < 1e-12
            lam = np.where(settled, lam, new)  # a pair's result must not depend on its batch
            if settled.all():
                break
        k = cos2_a * (A**2 - b**2) / b**2
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        off = small * sin_s * (mid + small / 4 * (cos_s * (2 * mid**2 - 1) - small / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)))
        return pd.Series(np.where(settled, b * big * (sigma - off), np.nan)).replace({np.nan: None}).astype("Float64")


HALF = 20_040_000.0  # metres, half the globe


def _reaches(places: DataFrame) -> list[float]:
    """A first reach that holds about a dozen places, by their mean density; then four times as far until half the globe."""
    ok = places.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    n, south, north, west, east = ok.agg(F.count("*"), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    if not n:
        return [HALF]
    area = 6_371_000.0**2 * math.radians(east - west) * (math.sin(math.radians(north)) - math.sin(math.radians(south)))
    first = min(HALF, max(1_000.0, math.sqrt(12 * area / (math.pi * n))))
    return [first * 4**i for i in range(12) if first * 4**i < HALF] + [HALF]


def _candidates(at: DataFrame, places: DataFrame, place: str, reach: float, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Rows of at (lat, lon) with the places that a circle of that radius can hold, and their distance `_sphere` on the sphere.

    Places are copied to the cells that the circle can touch, around the date line
    and the poles too, and met by an equi-join on the cell.
    """
    angle = reach / (A * (1 - E * E))  # the ellipsoid's meridian curves most at the equator
    height = min(180.0, math.degrees(angle))
    n = max(1, int(360 / height))
    width = 360 / n
    ratio = F.lit(math.sin(min(angle, math.pi / 2))) / F.cos(F.radians("_lat"))
    half = F.when(F.abs("_lat") + height >= 90, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.01)
    band = lambda c: F.floor(c / height)
    slot = lambda c: F.floor(c / width)
    ok = places.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).select(F.struct(F.col(place).alias("id"), *attributes).alias("_place"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    ok = ok.withColumn("_a", F.explode(F.sequence(band(F.col("_lat") - height), band(F.col("_lat") + height))))
    around = F.sequence(slot(F.col("_lon") - half), slot(F.col("_lon") + half))
    ok = ok.withColumn("_b", F.explode(F.array_distinct(F.transform(around, lambda x: F.pmod(x, F.lit(n))))))
    met = at.withColumn("_a", band(F.col("lat"))).withColumn("_b", F.pmod(slot(F.col("lon")), F.lit(n))).join(ok, ["_a", "_b"])
    return met.withColumn("_sphere", haversine(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))).drop("_a", "_b")


def nearest_place(points: DataFrame, places: DataFrame, key: str, place: str, exact: bool = True, attributes: tuple[str, ...] = (), reaches: list[float] | None = None) -> DataFrame:
    """(key, distance, place, attributes of the place): the nearest place of each point, however far; null without coordinates or places.

    exact is along the ellipsoid, else on the sphere. Distinct locations are
    searched up to the first reach, which the density of the places sets; those
    without a hit within it go on to the next one, on wider cells. The sphere's
    distance, never 0.6 % off, leaves few places for the exact one. Ties go to the
    least place; places outside the ranges of coordinates are left out.
    """
    left, found = stored(points.where("lat is not null and lon is not null").select("lat", "lon").distinct(), "locations"), None
    for reach in reaches or _reaches(places):
        met = _candidates(left, places, place, reach, attributes)
        if exact:
            met = met.where(F.col("_sphere") <= reach * 1.006 + 1).withColumn("_least", F.min("_sphere").over(Window.partitionBy("lat", "lon"))).where("_sphere <= _least * 1.012 + 1")
            met = met.withColumn("distance", geodesic("lat", "lon", "_lat", "_lon"))
        else:
            met = met.withColumn("distance", F.col("_sphere"))
        best = met.where(F.col("distance") <= reach).groupBy("lat", "lon").agg(F.min(F.struct("distance", "_place")).alias("m")).select("lat", "lon", "m.*")
        best = stored(best, "nearest")
        found = best if found is None else found.unionByName(best)
        left = left.join(best.select("lat", "lon"), ["lat", "lon"], "left_anti")
        if left.isEmpty():
            break
    out = points.select(key, "lat", "lon").join(found, ["lat", "lon"], "left")
    return out.select(key, "distance", F.col("_place.id").alias(place), *[F.col(f"_place.{c}").alias(c) for c in attributes])


def nearest_geodesic(points: DataFrame, places: DataFrame, key: str, place: str, reach: float) -> DataFrame:
    """nearest_place along the ellipsoid, up to `reach` metres only; null beyond."""
    return nearest_place(points, places, key, place, reaches=[reach])


BLOCK = 8  # cells a side of a folder of the grid


def cell_block(row: Column, col: Column) -> Column:
    return (F.floor((row - 1) / BLOCK) * 1000 + F.floor((col - 1) / BLOCK)).cast("int")


def write_grid_series(series: DataFrame, path: str) -> None:
    """Series (year, row, col, ...) in folders by year and block of cells, rows and columns in order within a file; a block with very many rows has several writers."""
    salt = F.pmod(F.xxhash64(*series.columns), F.lit(8))
    dealt = series.withColumn("block", cell_block(F.col("row"), F.col("col"))).repartition("year", "block", salt)
    dealt.sortWithinPartitions("year", "block", "row", "col").write.partitionBy("year", "block").parquet(path)


def grid_series(points: DataFrame, series: DataFrame, key: str, years: list[int]) -> DataFrame:
    """The series (year, row, col, ...) of each point's cell in each year's grid; years without a grid and points outside it give no rows.

    One table of all cells stands for a file a cell. Where it is laid out by
    write_grid_series, the points' blocks (a grid has some hundreds, so the driver
    may hold them) prune its folders, and the cell is an equi-join.
    """
    lat, lon = F.col("lat"), F.col("lon")
    cells = [F.struct(F.lit(y).alias("year"), grid_cell(lat, lon, y).alias("c")) for y in years if y in GRIDS]
    if not cells:
        return points.select(key).join(series.drop("block"), F.lit(False))
    at = points.select(key, F.explode(F.array(*cells)).alias("g")).where("g.c is not null").select(key, "g.year", "g.c.row", "g.c.col")
    if "block" not in series.columns:
        return at.join(series.where(F.col("year").isin([y for y in years if y in GRIDS])), ["year", "row", "col"])
    at = at.withColumn("block", cell_block(F.col("row"), F.col("col")))
    blocks: dict[int, list[int]] = {}
    for r in at.select("year", "block").distinct().collect():
        blocks.setdefault(r["year"], []).append(r["block"])
    wanted = F.lit(False)
    for year, own in blocks.items():
        wanted = wanted | ((F.col("year") == year) & F.col("block").isin(sorted(own)))
    return at.join(series.where(wanted), ["year", "block", "row", "col"]).drop("block")
