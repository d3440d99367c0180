"""Sources and sinks: JSON lines with broken rows, appends, overwrites, sidecars, an empty table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.operators import geoquality, load
from plazalake.plans.audit_queries import a10_suspect_flags
from plazalake.plans.registry import ORACLES, query
from plazalake.plans.search_queries import NORM, OK, L, listings
from plazalake.sources import listings as src
from plazalake.sources.scratch import new_path

KEY = "CAST(listing_id AS BIGINT)"
#: Every 23rd line is cut off, and every 29th has no url.
GOOD = f"{KEY} % 23 <> 0 AND {KEY} % 29 <> 0"


def json_lines(spark, d) -> list[str]:
    """The listings as JSON lines, a folder for each of two sources."""
    root, k = new_path(spark), F.col("listing_id").cast("long")
    point = F.struct("lat", "lng").alias("coordinates")
    rows = listings(spark, d).select(
        k.alias("k"), F.to_json(F.struct(
            F.col("listing_id").alias("listingId"), F.when(k % 29 != 0, F.col("url")).alias("url"), "title", "operation", "price", "currency", F.col("property_type").alias("propertyType"),
            F.col("area_m2").alias("areaM2"), "city", "province", F.when(k % 2 == 0, F.concat(F.lit("+52 55 "), F.lpad("listing_id", 8, "0"))).alias("agentPhone"), point,
            F.date_format("listed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("listedAt"),
        )).alias("value"))
    rows = rows.withColumn("value", F.when(F.col("k") % 23 == 0, F.substring("value", 1, 30)).otherwise(F.col("value")))
    paths = [f"{root}/odd.jsonl", f"{root}/even.jsonl"]
    for path, rest in zip(paths, (1, 0)):
        rows.filter(F.col("k") % 2 == rest).select("value").write.text(path)
    return paths


def _sources(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(L + f"SELECT CASE WHEN {KEY} % 2 = 0 THEN 'even' ELSE 'odd' END AS source, count(*) FILTER (WHERE {GOOD}) AS good, count(*) FILTER (WHERE NOT ({GOOD})) AS rejected FROM listings_v GROUP BY 1")
def s1_json_lines(spark, d):
    good, rejected = src.read_listings(spark, json_lines(spark, d))
    both = _sources(good).withColumnRenamed("n", "good").join(_sources(rejected).withColumnRenamed("n", "rejected"), "source", "full_outer")
    return both.select("source", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("rejected", F.lit(0)).alias("rejected"))


@query(L + f"SELECT 'even' AS source, listing_id, url, price, {NORM} AS norm, sha256(concat('salt', '+5255', lpad(listing_id, 8, '0'))) AS agent_phone, CASE WHEN {OK} THEN lat END AS lat, CASE WHEN {OK} THEN lng END AS lng, strftime(listed_at, '%Y-%m-%d') AS listed FROM listings_v WHERE {GOOD} AND {KEY} % 2 = 0")
def s2_table_of_one_source(spark, d):
    good, _ = src.read_listings(spark, json_lines(spark, d), ["even"])
    shown = F.date_format("listed_at", "yyyy-MM-dd").alias("listed")
    return src.to_table(good, "salt").select("source", "listing_id", "url", F.col("price").cast("double"), "norm", "agent_phone", "lat", "lng", shown)


@query(L + "SELECT source, count(*) AS n, count(*) FILTER (WHERE price IS NULL) AS unpriced FROM listings_v GROUP BY 1")
def s8_append(spark, d):
    path, k = new_path(spark), F.col("listing_id").cast("long")
    for part in (0, 1):
        src.append(listings(spark, d).filter(k % 2 == part), path)
    return spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("price").isNull()).alias("unpriced"))


@query(L + f"SELECT listing_id, price FROM listings_v WHERE {KEY} % 3 = 0")
def s10_overwrite(spark, d):
    path, k = new_path(spark), F.col("listing_id").cast("long")
    for rest in (1, 0):
        src.overwrite(listings(spark, d).filter(k % 3 == rest).select("listing_id", "price"), path)
    return spark.read.parquet(path)


def s9_sidecar(spark, d):
    v, path = listings(spark, d), new_path(spark)
    load.write_sidecar(v.filter(OK), geoquality.suspect_flags(v), path)
    marked = spark.read.parquet(path)
    return marked.groupBy(F.array_join("suspect", "+").alias("suspect")).agg(F.count(F.lit(1)).alias("n"))


query(ORACLES[a10_suspect_flags.__name__])(s9_sidecar)  # no row is lost, so the counts are those of the flags


@contextmanager
def _analysed(spark, d, name):
    """A table made empty, filled and analysed, and its path."""
    path = new_path(spark)
    src.create_empty(spark, path)
    rows = listings(spark, d)
    blank = src.T.StructType.fromDDL(src.TABLE_SCHEMA)
    full = rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in blank))
    src.append(full, path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({src.TABLE_SCHEMA}) USING parquet PARTITIONED BY (source) LOCATION '{path}'")
    try:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        src.analyze(spark, name)
        yield path
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay


@query(L + "SELECT source, count(*) AS n, count(price) AS priced FROM listings_v GROUP BY 1")
def s11_s12_table(spark, d):
    """The table is read by its declared columns."""
    with _analysed(spark, d, "plazalake_s12") as path:
        return spark.read.schema(src.TABLE_SCHEMA).parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("priced"))


@query(L + """, c AS (SELECT 'price' AS "column", CAST(price AS DOUBLE) AS v FROM listings_v UNION ALL SELECT 'area_m2', area_m2 FROM listings_v UNION ALL SELECT 'bedrooms', NULL FROM listings_v)
    SELECT "column", min(v) AS least, max(v) AS most, count(*) - count(v) AS nulls FROM c GROUP BY 1""")
def s11_statistics(spark, d):
    """The statistics themselves; the counts of distinct values are approximate and left out."""
    with _analysed(spark, d, "plazalake_s11"):
        found = src.column_statistics(spark, "plazalake_s11", ["price", "area_m2", "bedrooms"])
    return found.select("column", *(F.col(c).cast("double").alias(c) for c in ("least", "most")), "nulls")
