"""Sources and sinks: tolerant JSON lines, sitemaps, logs, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: JSON keys in the order of the table columns they load.
RAW_SCHEMA = (
    "listingId string, url string, title string, imageUrl string, operation string, price double, currency string, propertyType string, areaM2 double, "
    "plotAreaM2 double, builtAreaM2 double, bedrooms int, bathrooms int, location string, city string, province string, agencyName string, agentPhone string, "
    "postingCode string, description string, condition string, photos array<string>, coordinates struct<lat:double,lng:double>, coordsExact boolean, "
    "priceIsPerM2 boolean, listedAt string, observedAt string"
)
TABLE_SCHEMA = (
    "source string, listing_id string, url string, title string, operation string, price decimal(18,2), currency string, property_type string, area_m2 double, "
    "plot_area_m2 double, built_area_m2 double, bedrooms int, bathrooms int, location string, city string, province string, agency_name string, agent_phone string, "
    "description string, image_url string, price_is_per_m2 boolean, listed_at timestamp, observed_at timestamp, lat double, lng double, norm string, cell long"
)


def read_listings(spark: SparkSession, paths: Sequence[str], sources: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of JSON-lines files, one file (or folder of part files) a source, named by the
    part of its name before the first dot. Broken lines and rows without id or url are rejected, not
    fatal; paths that are not there are, all of them named in the error."""
    if missing := missing_paths(spark, paths):
        raise FileNotFoundError(f"missing: {', '.join(missing)}")
    schema = T.StructType.fromDDL(RAW_SCHEMA).add("_corrupt", "string")
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(list(paths))
    rows = rows.withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), r"([^/.]+)\.[^/]*(?:/part-[^/]*)?$", 1))
    if sources:
        rows = rows.filter(F.col("source").isin(list(sources)))
    bad = F.col("_corrupt").isNotNull() | F.coalesce(F.col("listingId"), F.lit("")).isin("") | F.coalesce(F.col("url"), F.lit("")).isin("")
    return rows.filter(~bad).drop("_corrupt"), rows.filter(bad)


def missing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that match no file, in the order given."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(conf).globStatus(p))

    return [p for p in paths if not there(p)]


def to_table(rows: DataFrame, salt: str) -> DataFrame:
    """The table's columns from JSON rows: types, search key, point, and phones as salted digests."""
    from plazalake.functions import geo
    from plazalake.functions.text import phone, search_key, utc_time
    from plazalake.sources.layout import cell

    good = geo.point_ok(F.col("coordinates.lat"), F.col("coordinates.lng"))
    c = F.col
    return rows.select(
        "source", c("listingId").alias("listing_id"), "url", "title", "operation", c("price").cast("decimal(18,2)"), "currency", c("propertyType").alias("property_type"),
        c("areaM2").alias("area_m2"), c("plotAreaM2").alias("plot_area_m2"), c("builtAreaM2").alias("built_area_m2"), "bedrooms", "bathrooms", "location", "city", "province",
        c("agencyName").alias("agency_name"), phone(c("agentPhone"), salt).alias("agent_phone"), "description", c("imageUrl").alias("image_url"), c("priceIsPerM2").alias("price_is_per_m2"),
        utc_time(c("listedAt")).alias("listed_at"), utc_time(c("observedAt")).alias("observed_at"), F.when(good, c("coordinates.lat")).alias("lat"), F.when(good, c("coordinates.lng")).alias("lng"),
        search_key("location", "city", "province", "title").alias("norm"), cell(c("coordinates.lat"), c("coordinates.lng")).alias("cell"),
    )


def decoded(rows: DataFrame) -> DataFrame:
    """Rows with lat and lng as one ``coordinates``, null unless both are there, and ``photos`` never null."""
    both = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    photos = F.col("photos").cast("array<string>") if "photos" in rows.columns else F.lit(None).cast("array<string>")
    packed = rows.withColumn("coordinates", F.when(both, F.struct(*(F.col(c).cast("double").alias(c) for c in ("lat", "lng")))))
    return packed.withColumn("photos", F.coalesce(photos, F.array().cast("array<string>"))).drop("lat", "lng")


def encoded(rows: DataFrame) -> DataFrame:
    """The way back from ``decoded``: lat and lng as columns, and no photos as null, so JSON leaves them out."""
    flat = rows.withColumns({"lat": F.col("coordinates.lat"), "lng": F.col("coordinates.lng")})
    return flat.withColumn("photos", F.when(F.size("photos") > 0, F.col("photos"))).drop("coordinates")


def union_corpora(corpora: Sequence[DataFrame]) -> DataFrame:
    """All rows of corpora with differing columns; absent ones are null."""
    out = corpora[0]
    for c in corpora[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    return sitemap_urls(spark.read.text(path))


def sitemap_urls(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(F.regexp_extract_all("value", F.lit("<loc>([^<]+)</loc>"), 1)).alias("url"))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("source").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a whole result; the path must not be read by the same plan."""
    df.write.mode("overwrite").parquet(path)


def create_empty(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], TABLE_SCHEMA).write.partitionBy("source").parquet(path)


def analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """What ``analyze`` stored of each column: column, least, most (as text), nulls, about (distinct values, approximate).
    Values are null where the table was not analysed."""
    out = []
    for name in columns:
        told = spark.sql(f"DESCRIBE EXTENDED {table} `{name}`")
        value = lambda info: F.nullif(F.max(F.when(F.col("info_name") == info, F.col("info_value"))), F.lit("NULL"))
        out.append(told.agg(F.lit(name).alias("column"), value("min").alias("least"), value("max").alias("most"), value("num_nulls").cast("long").alias("nulls"), value("distinct_count").cast("long").alias("about")))
    return union_corpora(out)
