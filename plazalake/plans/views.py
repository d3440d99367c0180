"""Listing-shaped views over the driver's tables. The same text runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

VIEWS = {
    "listings_v": """
SELECT o_orderpriority AS source, CAST(o_orderkey AS STRING) AS listing_id,
       CONCAT('https://', LOWER(c_mktsegment), '.example.com/item/', CAST(o_orderkey AS STRING), '?ref=x#top') AS url,
       CONCAT(c_name, ' Ñandú m²') AS title,
       CASE WHEN o_orderstatus = 'F' THEN 'rent' ELSE 'sale' END AS operation,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 0.0E0 ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 11 = 0 THEN 'USD' ELSE 'MXN' END AS currency,
       c_mktsegment AS property_type, CAST(o_orderkey % 500 AS DOUBLE) AS area_m2,
       CONCAT('Álvaro Obregón ', CAST(c_custkey % 40 AS STRING)) AS city,
       CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE n_name END AS province,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 0.0E0 WHEN o_orderkey % 29 = 0 THEN 19.39068E0
            ELSE 15.0E0 + n_nationkey * 0.6E0 + (c_custkey % 40) * 0.01E0 + (o_orderkey % 100) * 0.001E0 END AS lat,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 0.0E0 WHEN o_orderkey % 29 = 0 THEN -99.283699E0
            ELSE -115.0E0 + n_nationkey * 1.0E0 + (c_custkey % 40) * 0.01E0 - (o_orderkey % 100) * 0.001E0 END AS lng,
       o_orderdate AS listed_at,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderdate + INTERVAL '7' DAY END AS observed_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "observations_v": """
SELECT CAST(l_orderkey AS STRING) AS listing_id, l_shipdate AS observed_at, l_extendedprice AS price,
       l_partkey AS tie1, l_suppkey AS tie2, l_linenumber AS tie3,
       CASE WHEN l_returnflag = 'R' THEN 'rent' ELSE 'sale' END AS operation,
       CASE WHEN l_quantity > 25 THEN NULL ELSE 15.0E0 + (l_partkey % 1000) * 0.01E0 END AS lat,
       CASE WHEN l_quantity > 25 THEN NULL ELSE -115.0E0 + (l_suppkey % 1000) * 0.01E0 END AS lng
FROM lineitem""",
    "pages_v": """
SELECT p_partkey AS page_id,
       CONCAT('https://shop.example.com/', REPLACE(LOWER(p_brand), '#', '-'), '/MLM-', CAST(p_partkey AS STRING), '-', REPLACE(p_name, ' ', '-'), '-_JM?u=1') AS url,
       CONCAT('<html><script type="application/ld+json">{bad json</script>',
              '<script type="application/ld+json">{"@graph":[{"@type":"RealEstateListing","name":"', p_name,
              '","offers":{"price":', CAST(CAST(FLOOR(p_retailprice) AS INT) AS STRING), ',"priceCurrency":"MXN"}}]}</script>',
              '<script id="preloadedData">window.S = {"paging":{"total":', CAST(p_size * 30 AS STRING),
              ',"totalPages":', CAST(p_size AS STRING), '}}; window.x = {};</script>',
              '<div class="card" data-id="', CAST(p_partkey AS STRING), '"><span class="price">$ ',
              CAST(CAST(FLOOR(p_retailprice) AS INT) AS STRING), ' MXN</span><li>', CAST(p_size AS STRING), ' m² construidos</li></div></html>') AS html
FROM part""",
    "log_v": """
SELECT ts, event_id AS seq, user_id AS run_id,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
       CASE event_type WHEN 'signup' THEN 'run start' WHEN 'error' THEN 'aborted mid-sweep'
            WHEN 'purchase' THEN 'token minted' ELSE CONCAT('page ', CAST(event_id % 100 AS STRING)) END AS msg
FROM events""",
    "checkpoints_v": """
SELECT CONCAT('q', CAST(user_id AS STRING)) AS query, event_id AS seq,
       CASE WHEN event_type = 'error' AND event_id % 50 = 0 THEN NULL ELSE CAST(FLOOR(value) AS INT) END AS pos
FROM events""",
    "segments_v": """
SELECT DISTINCT CONCAT(c_mktsegment, '_', n_name, '_', r_name) AS segment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}


def register(spark: SparkSession, sf_dir: str) -> SparkSession:
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return register(spark, sf_dir).sql(VIEWS[name])


def with_views(*names: str) -> str:
    """The WITH clause that an oracle over these views starts with."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + " "
