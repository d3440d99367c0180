"""Distances on the ellipsoid, and radius joins over crowded places."""

import random
from math import asin, atan, atan2, cos, radians, sin, sqrt, tan

import pytest
from pyspark.sql import functions as F

from plazalake.functions import geo
from plazalake.operators import geoquality, search


def vincenty(lat1, lng1, lat2, lng2):
    """The inverse formula, iterated; None where it does not settle."""
    a, f = geo.AXIS_M, geo.FLATTENING
    b = a * (1 - f)
    u1, u2, dl = atan((1 - f) * tan(radians(lat1))), atan((1 - f) * tan(radians(lat2))), radians(lng2 - lng1)
    lam = dl
    for _ in range(300):
        ss = sqrt((cos(u2) * sin(lam)) ** 2 + (cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam)) ** 2)
        if ss == 0:
            return 0.0
        cs = sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam)
        s, sa = atan2(ss, cs), cos(u1) * cos(u2) * sin(lam) / ss
        c2a = 1 - sa * sa
        c2m = cs - 2 * sin(u1) * sin(u2) / c2a if c2a > 1e-15 else 0.0
        c = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        before, lam = lam, dl + (1 - c) * f * sa * (s + c * ss * (c2m + c * cs * (2 * c2m * c2m - 1)))
        if abs(lam - before) < 1e-13:
            break
    else:
        return None
    k2 = c2a * (a * a - b * b) / (b * b)
    big = 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2)))
    small = k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2)))
    d = small * ss * (c2m + small / 4 * (cs * (2 * c2m**2 - 1) - small / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m**2 - 3)))
    return b * big * (s - d)


def test_ellipsoid_against_vincenty(spark):
    rng = random.Random(3)
    pairs = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(3000)]
    for step in (1e-6, 1e-4, 1e-2, 1):  # near ones
        pairs += [(a := rng.uniform(-89, 89), b := rng.uniform(-179, 179), a + rng.uniform(-step, step), b + rng.uniform(-step, step)) for _ in range(300)]
    pairs += [(0.0, 0.0, 0.0, 0.0), (90.0, 0.0, 90.0, 77.0), (90.0, 0.0, -89.0, 0.0), (0.0, 0.0, 0.0, 90.0), (0.0, 179.9, 0.0, -179.9), (0.0, 0.0, 0.0, 180.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double, c double, d double")
    got = {r["i"]: r["m"] for r in df.select("i", geo.ellipsoid_m(*(F.col(c) for c in "abcd")).alias("m")).collect()}
    checked = 0
    for i, p in enumerate(pairs):
        want = vincenty(*p)
        if want is not None:
            assert abs(got[i] - want) <= max((1e-5 if want < 17e6 else 1e-4 if want < 19.9e6 else 1e-3) * want, 1e-6), (p, got[i], want)
            checked += 1
        assert 0 <= got[i] < 20.04e6
    assert checked > 4000
    assert df.select(geo.ellipsoid_m(F.lit(None).cast("double"), F.col("b"), F.col("c"), F.col("d")).alias("m")).filter("m IS NOT NULL").count() == 0


@pytest.fixture(scope="module")
def crowd(spark):
    """30 % of the rows at one point, a dense town, the date line, a pole, points that are not set."""
    rng = random.Random(6)
    rows = [(i, 19.4, -99.1) for i in range(2400)] + [(10_000 + i, 19.4 + rng.gauss(0, 0.2), -99.1 + rng.gauss(0, 0.2)) for i in range(4000)]
    rows += [(20_000 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(900)] + [(30_000 + i, rng.uniform(-1, 1), rng.choice([-1, 1]) * (180 - rng.random() * 0.3)) for i in range(400)]
    rows += [(40_000 + i, 89.9 + rng.random() * 0.1, rng.uniform(-180, 180)) for i in range(300)] + [(50_000, None, 1.0), (50_001, 0.0, 0.0), (50_002, 91.0, 0.0)]
    queries = [(i, 19.4 + rng.gauss(0, 0.2), -99.1 + rng.gauss(0, 0.2)) for i in range(20)] + [(100, 19.4, -99.1), (101, 0.0, 180.0), (102, 0.1, -179.95), (103, 89.97, 10.0), (104, -45.0, 45.0)]
    left = spark.createDataFrame(rows, "listing_id long, lat double, lng double").repartition(5)
    return left, spark.createDataFrame(queries, "query_id long, q_lat double, q_lng double")


@pytest.mark.parametrize("model", sorted(geo.MODELS))
@pytest.mark.parametrize("metres", [300, 15_000, 900_000])
def test_crowded_cells_equal_all_pairs(crowd, model, metres):
    left, right = crowd
    ok, distance = geo.point_ok(F.col("lat"), F.col("lng")), geo.MODELS[model](*(F.col(c) for c in ("lat", "lng", "q_lat", "q_lng")))
    want = sorted(map(tuple, left.filter(ok).crossJoin(right).filter(distance <= metres).select("query_id", "listing_id").collect()))
    for cell_rows in (150, 10**6):
        got = geoquality.radius_join(left, right, metres, model, cell_rows)
        assert got.columns == ["listing_id", "lat", "lng", "query_id", "q_lat", "q_lng", "distance_m"]
        assert sorted(map(tuple, got.select("query_id", "listing_id").collect())) == want


def test_no_cell_holds_a_crowd(spark, crowd, monkeypatch):
    left, right = crowd
    placed, whole = [], geoquality._placed
    monkeypatch.setattr(geoquality, "_placed", lambda *a: placed.append(whole(*a)) or placed[-1])
    geoquality.radius_join(left, right, 15_000, cell_rows=150)
    cells = placed[0].groupBy("_level", "_y", "_x", "_salt").count()
    assert cells.agg(F.max("count")).first()[0] <= 2 * 150  # salts are dealt by hash, so nearly even
    assert cells.agg(F.sum("count")).first()[0] == 8000


def test_search_by_ellipsoid(crowd):
    left, _ = crowd
    for lat, lng, metres in ((19.4, -99.1, 20_000), (0.0, 180.0, 30_000), (89.95, 0.0, 8_000)):
        distance = geo.ellipsoid_m(F.col("lat"), F.col("lng"), F.lit(lat), F.lit(lng))
        want = {r[0] for r in left.filter(geo.point_ok(F.col("lat"), F.col("lng")) & (distance <= metres)).select("listing_id").collect()}
        got = search.search(left, limit=None, near=(lat, lng), radius_m=metres, model="ellipsoid")
        assert {r["listing_id"] for r in got.collect()} == want and want
