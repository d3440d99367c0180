"""Coordinate quality: centroids by city, staged resolution, suspect flags, radius joins."""

from __future__ import annotations

from collections.abc import Mapping
from math import pi, sin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.functions import geo
from plazalake.functions.text import place_key
from plazalake.sources.scratch import stored


def centroids(df: DataFrame, least: int = 5, accuracy: int | None = None) -> DataFrame:
    """Median point of each (city, province) with at least ``least`` points. ``accuracy`` takes the
    approximate median, for groups too large for the exact one."""
    median = (lambda c: F.percentile_approx(c, 0.5, accuracy)) if accuracy else (lambda c: F.percentile(c, F.lit(0.5)))
    good = df.filter(geo.point_ok(F.col("lat"), F.col("lng")))
    return good.groupBy("city", "province").agg(F.count(F.lit(1)).alias("n"), median("lat").alias("lat"), median("lng").alias("lng")).filter(F.col("n") >= least)


def unambiguous_cities(points: DataFrame, most_km: float = 40.0) -> DataFrame:
    """Cities all of whose centroids lie near the one of the first province: median of medians."""
    anchor = points.groupBy("city").agg(F.min_by(F.struct("lat", "lng"), "province").alias("_a"))
    far = geo.approx_km(F.col("lat"), F.col("lng"), F.col("_a.lat"), F.col("_a.lng"))
    grouped = points.join(anchor, "city").groupBy("city").agg(
        F.bool_and(far <= most_km).alias("_near"), F.percentile("lat", F.lit(0.5)).alias("lat"), F.percentile("lng", F.lit(0.5)).alias("lng")
    )
    return grouped.filter("_near").drop("_near")


def resolve_cities(df: DataFrame, points: DataFrame, cities: DataFrame) -> DataFrame:
    """A centroid for each row by (city, province), else the city alone, else the part before "/",
    else the one city that starts with the name. stage tells which step found it. The last step
    meets the beginnings of all known names, so it stays an equality join. Each distinct place is
    resolved once, as a stored table, which the rows meet in one join."""
    c = lambda d, p: d.select(*(x for x in ("city", "province") if x in d.columns), F.struct("lat", "lng").alias(p))
    places = df.select("city", "province").distinct().withColumn("_cut", F.trim(F.substring_index("city", "/", 1)))
    one = places.join(c(points, "_p1"), ["city", "province"], "left").join(c(cities, "_p2"), "city", "left")
    one = one.join(c(cities, "_p3").withColumnRenamed("city", "_cut"), "_cut", "left")
    # every name that a city's goes on from, so that a frequent first word pairs nothing by itself
    words = F.split("city", " ")
    shorter = F.explode(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")))
    known = cities.filter(F.contains("city", F.lit(" "))).select(F.struct("lat", "lng").alias("_p"), shorter.alias("city"))
    prefix = places.select("city").distinct().join(known, "city")
    single = prefix.groupBy("city").agg(F.count(F.lit(1)).alias("_n"), F.any_value("_p").alias("_p4")).filter("_n = 1").drop("_n")
    out = one.join(single, "city", "left")
    found = F.coalesce("_p1", "_p2", "_p3", "_p4")
    stage = F.when(F.col("_p1").isNotNull(), 1).when(F.col("_p2").isNotNull(), 2).when(F.col("_p3").isNotNull(), 3).when(F.col("_p4").isNotNull(), 4).otherwise(0)
    resolved = stored(out.select(F.col("city").alias("_city"), F.col("province").alias("_province"), stage.alias("stage"), found["lat"].alias("c_lat"), found["lng"].alias("c_lng")))
    same = F.col("city").eqNullSafe(F.col("_city")) & F.col("province").eqNullSafe(F.col("_province"))
    return df.join(resolved, same, "left").select(*df.columns, "stage", "c_lat", "c_lng")


def repeated_points(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Points rounded to six decimals with how many provinces use them, by ``place_key`` with ``aliases``; a
    missing one counts once."""
    return _repeated(df.withColumn("province", place_key(F.coalesce("province", F.lit("")), aliases)))


def _repeated(df: DataFrame) -> DataFrame:
    cell = lambda c: F.floor(F.col(c) * 1e6 + 0.5).cast("long").alias(f"{c}6")
    good = df.filter(geo.point_ok(F.col("lat"), F.col("lng")))
    return good.groupBy(cell("lat"), cell("lng")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.coalesce("province", F.lit(""))).alias("provinces"))


def suspect_flags(df: DataFrame, most_km: float = 40.0, donors: DataFrame | None = None, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with a point and the array ``suspect`` of their flags: repe, sin-centroide, lejos. A row
    without flags is clean; rows are marked and never deleted.

    Names of cities and provinces meet by ``place_key`` with ``aliases``, so spellings of one place do not
    count as two. ``donors`` (city, province, lat, lng) give the centroids, best those of other corpora, as
    a filler point would support itself; without them the rows are their own. An empty city donates none."""
    def named(rows: DataFrame, *columns: str) -> DataFrame:
        """Rows with a point, by the keys of their names, as a stored table, since several steps read them and would
        make them again; each distinct spelling is looked at once."""
        kept = rows.filter(geo.point_ok(F.col("lat"), F.col("lng")))
        kept = kept.select(*columns, "lat", "lng", *(F.coalesce(c, F.lit("")).alias(f"_{c}") for c in ("city", "province")))
        keys = stored(kept.select("_city", "_province").distinct().select("*", *(place_key(F.col(f"_{c}"), aliases).alias(c) for c in ("city", "province"))))
        return stored(kept.join(keys, ["_city", "_province"]).drop("_city", "_province"))

    good = named(df, "source", "listing_id")
    points = stored(centroids((good if donors is None else named(donors)).filter("city <> ''")))
    repeated = _repeated(good).filter("provinces >= 2").select("lat6", "lng6", F.lit(True).alias("_rep"))
    keyed = good.withColumn("lat6", F.floor(F.col("lat") * 1e6 + 0.5).cast("long")).withColumn("lng6", F.floor(F.col("lng") * 1e6 + 0.5).cast("long"))
    placed = resolve_cities(keyed, points, stored(unambiguous_cities(points, most_km))).join(repeated, ["lat6", "lng6"], "left")
    far = geo.approx_km(F.col("lat"), F.col("lng"), F.col("c_lat"), F.col("c_lng")) > most_km
    # the three flag names are fixed values of the data format
    flags = F.array_compact(F.array(F.when(F.col("_rep"), "repe"), F.when(F.col("c_lat").isNull(), "sin-centroide"), F.when(far, "lejos")))
    return placed.select("source", "listing_id", flags.alias("suspect"))


#: Levels below the grid's cells, each of which cuts a cell in four.
LEVELS = 6
#: At most so many cells of a level are cut, so that what goes to every task stays small.
MOST_CUT = 10_000


def radius_join(left: DataFrame, right: DataFrame, metres: float, model: str = "sphere", cell_rows: int = 50_000) -> DataFrame:
    """Pairs of listings and query points (query_id, q_lat, q_lng) within ``metres``.

    Both sides meet on grid cells about as large as the radius, the query side in all nine around it.
    Rows of cells are as high as the radius; each has its own number of cells, fewer towards the poles,
    which close around the globe. A cell with more than ``cell_rows`` listings (or a ten-thousandth of all,
    if that is more) is cut in four, level by level, and a query goes to those parts only that its radius can
    reach. Listings of one point cannot be cut: their cell is dealt over salts, to which its queries go. So
    no task holds more than a cell's share of listings, however they crowd.
    """
    height, fine = metres / 111_000.0 * geo.SLACK, 1 << LEVELS

    def with_cells(df: DataFrame) -> DataFrame:
        # the most that two points within the radius differ in longitude, in this row and its neighbours
        top = F.least(F.lit(90.0), F.greatest(F.abs(F.col("_y") - 1), F.abs(F.col("_y") + 2)) * height)
        ratio = sin(min(metres / geo.EARTH_M, 3.14) / 2) / F.greatest(F.cos(F.radians(top)), F.lit(1e-9))
        width = F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0)))) * geo.SLACK
        return df.withColumn("_cells", F.greatest(F.floor(360 / width), F.lit(1)).cast("long"))

    def column(lng: Column, parts: int) -> Column:
        return F.pmod(F.floor((lng + 180) / 360 * F.col("_cells") * parts).cast("long"), F.col("_cells") * parts)

    a = left.filter(geo.point_ok(F.col("lat"), F.col("lng"))).withColumn("_fy", F.floor(F.col("lat") / height * fine).cast("long"))
    a = with_cells(a.withColumn("_y", F.shiftright("_fy", LEVELS))).withColumn("_fx", column(F.col("lng"), fine)).drop("_y", "_cells")
    cut = _crowded(a, cell_rows)
    steps = F.array(*(F.lit(s).cast("long") for s in (-1, 0, 1)))
    b = with_cells(right.withColumn("_y", F.explode(F.transform(steps, lambda s: F.floor(F.col("q_lat") / height).cast("long") + s))))
    b = b.withColumn("_x", column(F.col("q_lng"), 1))
    b = b.withColumn("_x", F.explode(F.array_distinct(F.transform(steps, lambda s: F.pmod(F.col("_x") + s, F.col("_cells"))))))
    if cut is None:
        a = a.withColumns({"_y": F.shiftright("_fy", LEVELS), "_x": F.shiftright("_fx", LEVELS)})
        keys = ["_y", "_x"]
    else:
        a, b = _placed(a, cut), _sent(b, cut, metres, height)
        keys = ["_level", "_y", "_x", "_salt"]
    distance = geo.MODELS[model](F.col("lat"), F.col("lng"), F.col("q_lat"), F.col("q_lng"))
    met = a.join(b, keys).withColumn("distance_m", distance).filter(F.col("distance_m") <= metres)
    return met.drop("_fy", "_fx", "_cells", *keys)


def _crowded(cells: DataFrame, cell_rows: int) -> DataFrame | None:
    """(level, y, x, n) of the cells of all levels that hold too many rows, as a stored table; None if
    there are none. Parts of a cell that is not here are not here either."""
    whole = cells.groupBy(*(F.shiftright(f"_f{c}", LEVELS) for c in "yx")).agg(F.count(F.lit(1)).alias("n"))
    if (whole.agg(F.max("n")).first()[0] or 0) <= cell_rows:  # mostly: then there is nothing to cut
        return None
    counts = cells.groupBy("_fy", "_fx").agg(F.count(F.lit(1)).alias("n"))
    levels = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), *(F.shiftright(f"_f{c}", LEVELS - i).alias(c) for c in "yx")) for i in range(LEVELS + 1))))
    nodes = stored(counts.select(levels.alias("node"), "n").groupBy("node.level", "node.y", "node.x").agg(F.sum("n").alias("n")).filter(F.col("n") > cell_rows))
    total = cells.count()
    return nodes.filter(F.col("n") > max(cell_rows, total // MOST_CUT)).withColumn("salts", F.ceil(F.col("n") / max(cell_rows, total // MOST_CUT)).cast("int"))


def _at(cut: DataFrame, level: int) -> DataFrame:
    """The cells of a level that are cut, with the number of salts; at most ``MOST_CUT`` rows."""
    return F.broadcast(cut.filter(F.col("level") == level).select(F.col("y").alias("_cy"), F.col("x").alias("_cx"), F.col("salts").alias("_salts")))


def _placed(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Rows in the first cell on their way down that is not cut, or in a salt of the last one."""
    rows = rows.withColumn("_level", F.lit(0))
    for level in range(LEVELS + 1):
        y, x = (F.shiftright(f"_f{c}", LEVELS - level) for c in "yx")
        rows = rows.join(_at(cut, level), (F.col("_cy") == y) & (F.col("_cx") == x), "left")
        if level < LEVELS:
            rows = rows.withColumn("_level", F.col("_level") + F.col("_cy").isNotNull().cast("int")).drop("_cy", "_cx", "_salts")
    # by content, so that a task that runs again deals its rows alike
    content = F.xxhash64(*(c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))))
    salt = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(content, F.col("_salts")).cast("int"))
    here = {f"_{c}": F.expr(f"shiftright(_f{c}, {LEVELS} - _level)") for c in "yx"}
    return rows.withColumns({**here, "_salt": salt}).drop("_cy", "_cx", "_salts")


def _sent(queries: DataFrame, cut: DataFrame, metres: float, height: float) -> DataFrame:
    """Queries (a row for each cell around them) in the parts of cut cells that their radius can reach, and in
    all salts of the last ones."""
    up = F.lit(metres / geo.EARTH_M * 180 / pi * geo.SLACK)
    ratio = sin(min(metres / geo.EARTH_M, 3.14) / 2) / F.greatest(F.cos(F.radians(F.least(F.lit(90.0), F.abs("q_lat") + up))), F.lit(1e-9))
    b = queries.withColumn("_side", F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0)))) * geo.SLACK).withColumn("_level", F.lit(0))
    for level in range(LEVELS):
        part = height / (2 << level)
        width = 360 / (F.col("_cells") * (2 << level))

        def reached(node: Column) -> Column:
            low = node["y"] * part
            away = F.abs(F.pmod((node["x"] + 0.5) * width - 180 - F.col("q_lng") + 180, F.lit(360.0)) - 180)
            return (low <= F.col("q_lat") + up) & (low + part >= F.col("q_lat") - up) & (away <= F.col("_side") + width / 2)

        parts = F.array(*(F.struct(F.lit(level + 1).alias("level"), (F.col("_y") * 2 + dy).alias("y"), (F.col("_x") * 2 + dx).alias("x")) for dy in (0, 1) for dx in (0, 1)))
        same = F.array(F.struct(F.col("_level").alias("level"), F.col("_y").alias("y"), F.col("_x").alias("x")))
        b = b.join(_at(cut, level), (F.col("_level") == level) & (F.col("_cy") == F.col("_y")) & (F.col("_cx") == F.col("_x")), "left")
        b = b.withColumn("_node", F.explode(F.when(F.col("_cy").isNull(), same).otherwise(F.filter(parts, reached)))).drop("_cy", "_cx", "_salts")
        b = b.withColumns({"_level": F.col("_node.level"), "_y": F.col("_node.y"), "_x": F.col("_node.x")}).drop("_node")
    b = b.join(_at(cut, LEVELS), (F.col("_level") == LEVELS) & (F.col("_cy") == F.col("_y")) & (F.col("_cx") == F.col("_x")), "left")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    return b.withColumn("_salt", salts).drop("_cy", "_cx", "_salts", "_side")


def nearest(left: DataFrame, right: DataFrame, metres: float, k: int, model: str = "sphere") -> DataFrame:
    """The ``k`` nearest listings of each query point, by rank; a task keeps ``k`` of a query before they meet."""
    w = Window.partitionBy("query_id").orderBy("distance_m", "listing_id")
    return radius_join(left, right, metres, model).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
