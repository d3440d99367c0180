"""Audits, geo quality, price shards and run logs over the derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from plazalake.functions import geo, text
from plazalake.operators import audit, geoquality, runlog, shards
from plazalake.plans.registry import query
from plazalake.plans.search_queries import DIST, OK, L, listings, with_ellipsoid
from plazalake.plans.views import register, view, with_views
from plazalake.streaming import flows

G = with_views("log_v")
C = with_views("checkpoints_v")
S = with_views("segments_v")


def log(spark, d):
    return view(spark, d, "log_v")


def provinces(spark):
    return spark.table("nation").filter("n_nationkey < 20").select(F.col("n_name").alias("label")).union(spark.sql("SELECT 'NOWHERE' AS label"))


@query(L + ", s AS (SELECT coalesce(nullif(province, ''), '(missing)') AS label, count(*) AS n FROM listings_v GROUP BY 1), e AS (SELECT n_name AS label FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 'NOWHERE') SELECT coalesce(s.label, e.label) AS label, coalesce(n, 0) AS n, CASE WHEN e.label IS NULL THEN 'unexpected' WHEN s.label IS NULL THEN 'absent' ELSE 'covered' END AS status FROM s FULL JOIN e ON s.label = e.label")
def a1_j9_coverage(spark, d):
    return audit.coverage(listings(spark, d), "province", provinces(spark))


@query(L + "SELECT count(*) AS n, count(DISTINCT {'a': city}) AS ids, count(DISTINCT {'a': city, 'b': operation}) AS pairs, count(*) - count(DISTINCT {'a': city, 'b': operation}) AS repeated, count(DISTINCT {'a': city, 'b': operation}) - count(DISTINCT {'a': city}) AS both_operations FROM listings_v")
def a2_identity_counts(spark, d):
    return audit.identity_counts(listings(spark, d), "city", "operation")


@query(L + ", o AS (SELECT CASE WHEN CAST(listing_id AS BIGINT) % 2 = 0 THEN concat(city, '|sale') ELSE city END AS k, CASE WHEN CAST(listing_id AS BIGINT) % 4 = 0 THEN NULL ELSE operation END AS o FROM listings_v) SELECT count(*) AS n, count(DISTINCT k) AS ids, count(DISTINCT {'a': k, 'b': o}) AS pairs, count(*) - count(DISTINCT {'a': k, 'b': o}) AS repeated, count(DISTINCT {'a': k, 'b': o}) - count(DISTINCT k) AS both_operations FROM o")
def a2_identity_with_nulls(spark, d):
    k = F.col("listing_id").cast("long")
    rows = listings(spark, d).select(F.when(k % 2 == 0, F.concat("city", F.lit("|sale"))).otherwise(F.col("city")).alias("k"), F.when(k % 4 != 0, F.col("operation")).alias("o"))
    return audit.identity_counts(rows, "k", "o")


@query(L + "SELECT 'price' AS column_name, round(100 * avg(CASE WHEN price <> 0 THEN 1 ELSE 0 END), 4) AS percent FROM listings_v UNION ALL SELECT 'province', round(100 * avg(CASE WHEN province <> '' THEN 1 ELSE 0 END), 4) FROM listings_v UNION ALL SELECT 'area_m2', round(100 * avg(CASE WHEN area_m2 <> 0 THEN 1 ELSE 0 END), 4) FROM listings_v UNION ALL SELECT 'observed_at', round(100 * avg(CASE WHEN observed_at IS NOT NULL THEN 1 ELSE 0 END), 4) FROM listings_v")
def a3_fill(spark, d):
    return audit.fill(listings(spark, d), ["price", "province", "area_m2", "observed_at"])


@query(L + "SELECT city AS label, count(*) AS n FROM listings_v GROUP BY city ORDER BY n DESC, label LIMIT 10")
def a4_t3_top_categories(spark, d):
    return audit.top_categories(listings(spark, d), "city", 10)


@query(L + "SELECT province, operation, property_type, CAST(GROUPING(province) * 4 + GROUPING(operation) * 2 + GROUPING(property_type) AS BIGINT) AS level, count(*) AS n FROM listings_v GROUP BY GROUPING SETS ((province), (operation), (property_type), ())")
def a5_grouping_sets(spark, d):
    return audit.dimension_counts(listings(spark, d), ["province", "operation", "property_type"])


@query(L + f"SELECT property_type, count(*) FILTER (WHERE {OK}) AS pins, count(*) FILTER (WHERE price < 1000) AS low, count(*) FILTER (WHERE property_type = 'BUILDING' AND area_m2 > 0) AS plots FROM listings_v GROUP BY property_type")
def a6_conditional_counts(spark, d):
    plots = (F.col("property_type") == "BUILDING") & (F.col("area_m2") > 0)
    return audit.conditional_counts(listings(spark, d), "property_type", pins=geo.point_ok(F.col("lat"), F.col("lng")), low=F.col("price") < 1000, plots=plots)


CENTROIDS = f"cen AS (SELECT city, province, count(*) AS n, median(lat) AS lat, median(lng) AS lng FROM listings_v WHERE {OK} GROUP BY city, province HAVING count(*) >= 5)"
CITIES = "anchor AS (SELECT city, arg_min(lat, province) AS alat, arg_min(lng, province) AS alng FROM cen GROUP BY city), cit AS (SELECT c.city, median(lat) AS lat, median(lng) AS lng FROM cen c JOIN anchor a ON a.city = c.city GROUP BY c.city HAVING bool_and(sqrt(power((lat - alat) * 111, 2) + power((lng - alng) * 100 * cos(radians(lat)), 2)) <= {km}))"


@query(L + f", {CENTROIDS} SELECT city, province, n, round(lat, 6) AS lat, round(lng, 6) AS lng FROM cen")
def a7_centroids(spark, d):
    return geoquality.centroids(listings(spark, d)).select("city", "province", "n", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


@query(L + f", {CENTROIDS}, {CITIES.format(km=1500)} SELECT city, round(lat, 6) AS lat, round(lng, 6) AS lng FROM cit")
def a8_unambiguous_cities(spark, d):
    got = geoquality.unambiguous_cities(geoquality.centroids(listings(spark, d)), 1500.0)
    return got.select("city", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


REPEATED = f"rep AS (SELECT CAST(floor(lat * 1e6 + 0.5) AS BIGINT) AS lat6, CAST(floor(lng * 1e6 + 0.5) AS BIGINT) AS lng6, count(*) AS n, count(DISTINCT coalesce(province, '')) AS provinces FROM listings_v WHERE {OK} GROUP BY 1, 2)"


@query(L + f", {REPEATED} SELECT * FROM rep WHERE provinces >= 2")
def a9_repeated_points(spark, d):
    return geoquality.repeated_points(listings(spark, d)).filter("provinces >= 2")


@query(L + f""", {CENTROIDS}, {CITIES.format(km=40)}, {REPEATED}, g AS (SELECT *, CAST(floor(lat * 1e6 + 0.5) AS BIGINT) AS lat6, CAST(floor(lng * 1e6 + 0.5) AS BIGINT) AS lng6 FROM listings_v WHERE {OK}),
    pre AS (SELECT DISTINCT g.city, c.lat, c.lng FROM (SELECT DISTINCT city FROM g) g JOIN cit c ON starts_with(c.city, concat(g.city, ' ')) QUALIFY count(*) OVER (PARTITION BY g.city) = 1),
    p AS (SELECT g.*, coalesce(c.lat, t.lat, pre.lat) AS clat, coalesce(c.lng, t.lng, pre.lng) AS clng, r.provinces >= 2 AS rp FROM g LEFT JOIN cen c ON c.city = g.city AND c.province = g.province LEFT JOIN cit t ON t.city = g.city LEFT JOIN pre ON pre.city = g.city LEFT JOIN rep r ON r.lat6 = g.lat6 AND r.lng6 = g.lng6)
    SELECT suspect, count(*) AS n FROM (SELECT concat_ws('+', CASE WHEN rp THEN 'repe' END, CASE WHEN clat IS NULL THEN 'sin-centroide' END, CASE WHEN sqrt(power((lat - clat) * 111, 2) + power((lng - clng) * 100 * cos(radians(lat)), 2)) > 40 THEN 'lejos' END) AS suspect FROM p) GROUP BY suspect""")
def a10_suspect_flags(spark, d):
    flags = geoquality.suspect_flags(listings(spark, d))
    return flags.groupBy(F.array_join("suspect", "+").alias("suspect")).agg(F.count(F.lit(1)).alias("n"))


#: Spellings of one place in the rows to check; the donors' corpora spell it plainly.
SPELT = "SELECT source, listing_id, lat, lng, CASE WHEN CAST(listing_id AS BIGINT) % 3 = 0 THEN CONCAT(UPPER(city), ' ') ELSE city END AS city, CASE WHEN CAST(listing_id AS BIGINT) % 4 = 0 THEN CONCAT(' ', LOWER(province), ',') WHEN CAST(listing_id AS BIGINT) % 4 = 1 THEN 'N. 7' ELSE province END AS province FROM listings_v WHERE source < '3'"
_KEY = r"trim(regexp_replace(replace(strip_accents(lower(coalesce({0}, ''))), ',', ' '), '\s+', ' ', 'g'))"
_ALIASED = f"CASE {_KEY} WHEN 'n. 7' THEN 'nation_7' ELSE {_KEY} END"
_NAMED = "SELECT listing_id, lat, lng, " + ", ".join(_ALIASED.format(c) + f" AS {c}" for c in ("city", "province"))


@query(L + f""", s AS ({SPELT}), listings2 AS ({_NAMED} FROM s WHERE {OK}), donors AS ({_NAMED} FROM listings_v WHERE source >= '3' AND {OK}), {CENTROIDS.replace('listings_v', 'donors')}, {CITIES.format(km=40)}, {REPEATED.replace('listings_v', 'listings2')},
    g AS (SELECT *, CAST(floor(lat * 1e6 + 0.5) AS BIGINT) AS lat6, CAST(floor(lng * 1e6 + 0.5) AS BIGINT) AS lng6 FROM listings2),
    p AS (SELECT g.*, coalesce(c.lat, t.lat) AS clat, coalesce(c.lng, t.lng) AS clng, r.provinces >= 2 AS rp FROM g LEFT JOIN cen c ON c.city = g.city AND c.province = g.province LEFT JOIN cit t ON t.city = g.city LEFT JOIN rep r ON r.lat6 = g.lat6 AND r.lng6 = g.lng6)
    SELECT listing_id, concat_ws('+', CASE WHEN rp THEN 'repe' END, CASE WHEN clat IS NULL THEN 'sin-centroide' END, CASE WHEN sqrt(power((lat - clat) * 111, 2) + power((lng - clng) * 100 * cos(radians(lat)), 2)) > 40 THEN 'lejos' END) AS suspect FROM p""")
def a10_suspect_by_donors(spark, d):
    rows, donors = register(spark, d).sql(f"{L}, s AS ({SPELT}) SELECT * FROM s"), listings(spark, d).filter("source >= '3'")
    flags = geoquality.suspect_flags(rows, donors=donors, aliases={"n. 7": "nation_7"})
    return flags.select("listing_id", F.array_join("suspect", "+").alias("suspect"))


@query(L + f", {CENTROIDS}, {CITIES.format(km=1500)}, q AS (SELECT listing_id, CASE WHEN CAST(listing_id AS BIGINT) % 5 = 0 THEN concat(city, '/x') ELSE city END AS city, province FROM listings_v) SELECT listing_id, CASE WHEN c.city IS NOT NULL THEN 1 WHEN t.city IS NOT NULL THEN 2 WHEN u.city IS NOT NULL THEN 3 ELSE 0 END AS stage FROM q LEFT JOIN cen c ON c.city = q.city AND c.province = q.province LEFT JOIN cit t ON t.city = q.city LEFT JOIN cit u ON u.city = split_part(q.city, '/', 1)")
def j7_resolve_cities(spark, d):
    points = geoquality.centroids(listings(spark, d))
    rows = listings(spark, d).select("listing_id", F.when(F.col("listing_id").cast("long") % 5 == 0, F.concat("city", F.lit("/x"))).otherwise(F.col("city")).alias("city"), "province")
    return geoquality.resolve_cities(rows, points, geoquality.unambiguous_cities(points, 1500.0)).select("listing_id", "stage")


QUERY_POINTS = "q AS (SELECT n_nationkey AS query_id, 15.0E0 + n_nationkey * 0.6E0 AS q_lat, -115.0E0 + n_nationkey * 1.0E0 AS q_lng FROM nation)"


def _points(spark):
    return spark.sql("SELECT n_nationkey AS query_id, 15.0E0 + n_nationkey * 0.6E0 AS q_lat, -115.0E0 + n_nationkey * 1.0E0 AS q_lng FROM nation")


@query(L + f", {QUERY_POINTS} SELECT query_id, listing_id, round({DIST.format('lat', 'lng', 'q_lat', 'q_lng')}, 2) AS m FROM listings_v, q WHERE {OK} AND {DIST.format('lat', 'lng', 'q_lat', 'q_lng')} <= 15000")
def j8_radius_join(spark, d):
    return geoquality.radius_join(listings(spark, d), _points(spark), 15_000).select("query_id", "listing_id", F.round("distance_m", 2).alias("m"))


@query(L + f", {QUERY_POINTS} SELECT query_id, listing_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY m, listing_id) AS rank FROM (SELECT query_id, listing_id, {DIST.format('lat', 'lng', 'q_lat', 'q_lng')} AS m FROM listings_v, q WHERE {OK}) WHERE m <= 30000) WHERE rank <= 3")
def t2_nearest_by_query(spark, d):
    return geoquality.nearest(listings(spark, d), _points(spark), 30_000, 3).select("query_id", "listing_id", "rank")


NEAR_POINTS = f"(SELECT listing_id, query_id, em FROM {with_ellipsoid('(SELECT * FROM listings_v, q WHERE ' + OK + ')', 'q_lat', 'q_lng')})"


@query(L + f", {QUERY_POINTS} SELECT query_id, listing_id, round(em, 2) AS m FROM {NEAR_POINTS} WHERE em <= 15000")
def j8_radius_join_ellipsoid(spark, d):
    """Cells of over 1,000 listings are cut, so that the given tables reach the quadtree too."""
    return geoquality.radius_join(listings(spark, d), _points(spark), 15_000, "ellipsoid", cell_rows=1_000).select("query_id", "listing_id", F.round("distance_m", 2).alias("m"))


@query(L + f", {QUERY_POINTS} SELECT query_id, listing_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY em, listing_id) AS INT) AS rank FROM {NEAR_POINTS} WHERE em <= 30000 QUALIFY rank <= 3")
def t2_nearest_by_query_ellipsoid(spark, d):
    return geoquality.nearest(listings(spark, d), _points(spark), 30_000, 3, "ellipsoid").select("query_id", "listing_id", "rank")


@query(L + ", g AS (SELECT property_type, count(*) AS got FROM listings_v WHERE price > 100000 GROUP BY 1), a AS (SELECT property_type, count(*) AS advertised FROM listings_v GROUP BY 1) SELECT a.property_type, advertised, coalesce(got, 0) AS got, coalesce(got, 0) < advertised * 0.9 AS short FROM a LEFT JOIN g ON a.property_type = g.property_type")
def a11_completeness(spark, d):
    v = listings(spark, d)
    return audit.completeness(v.filter("price > 100000"), v.groupBy("property_type").agg(F.count(F.lit(1)).alias("advertised")), "property_type")


@query("SELECT event_type AS phase, count(*) AS requests, CAST(sum(event_id % 1000) AS BIGINT) AS size, round(CAST(sum(event_id % 1000) AS DOUBLE) / count(*), 6) AS per_request, round(CAST(sum(event_id % 1000) AS DOUBLE) / sum(sum(event_id % 1000)) OVER (), 8) AS share FROM events GROUP BY event_type")
def a12_transfer(spark, d):
    register(spark, d)
    return audit.transfer(spark.sql("SELECT event_type, event_id % 1000 AS size FROM events"), "event_type", "size")


@query(L + "SELECT property_type AS category, count(*) AS n, CAST(ceil(count(*) / 48.0) AS BIGINT) AS pages, round(ceil(count(*) / 48.0) * 0.3, 6) AS mb, round(ceil(count(*) / 48.0) * 1.5 / 3600, 8) AS hours FROM listings_v GROUP BY ROLLUP (property_type)")
def a13_sizing(spark, d):
    return audit.sizing(listings(spark, d), "property_type", 48, 0.3, 1.5)


@query(L + "SELECT city, label, n FROM (SELECT city, province AS label, count(*) AS n, row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, province) AS rn FROM listings_v GROUP BY city, province) WHERE rn = 1")
def a14_dominant_label(spark, d):
    return audit.dominant_label(listings(spark, d), "city", "province")


@query(S + "SELECT split_part(segment, '_', 1) AS root, len(string_split(segment, '_')) AS depth, count(*) AS n FROM segments_v GROUP BY 1, 2")
def a15_depths(spark, d):
    return audit.depth_counts(view(spark, d, "segments_v"))


@query("SELECT user_id % 50 AS batch, count(*) AS served, count(DISTINCT event_id % 97) AS fresh, count(*) - count(DISTINCT event_id % 97) AS overlap, round(CAST(count(DISTINCT event_id % 97) AS DOUBLE) / count(*), 8) AS yield FROM events GROUP BY 1")
def a16_yield(spark, d):
    register(spark, d)
    return audit.fetch_yield(spark.sql("SELECT user_id % 50 AS batch, event_id % 97 AS id FROM events"), "batch", "id").withColumn("yield", F.round("yield", 8))


@query("SELECT event_type AS verdict, count(*) AS n FROM events GROUP BY 1")
def a17_verdicts(spark, d):
    return audit.verdicts(register(spark, d).table("events"), F.col("event_type"))


@query(L + "SELECT city, string_agg(DISTINCT operation, ',' ORDER BY operation) AS categories, count(DISTINCT operation) AS n FROM listings_v GROUP BY city HAVING count(DISTINCT operation) > 1")
def a18_overlap(spark, d):
    return audit.overlap(listings(spark, d), "city", "operation")


@query(L + "SELECT city, count(*) FILTER (WHERE province <> '') AS labelled, count(*) FILTER (WHERE province = 'NATION_7') AS matching, count(*) FILTER (WHERE province = 'NATION_7') * 2 >= count(*) FILTER (WHERE province <> '') AS applied FROM listings_v GROUP BY city")
def f11_majority(spark, d):
    return audit.majority_applied(listings(spark, d), "city", F.col("province"), F.lit("NATION_7"))


@query(L + "SELECT city, count(*) AS n, count(*) FILTER (WHERE price < 50000 OR price > 300000) AS outside, count(*) FILTER (WHERE price < 50000 OR price > 300000) <= greatest(2, count(*) // 4) AS applied FROM listings_v WHERE currency = 'MXN' AND price <> 0 GROUP BY city")
def f12_range(spark, d):
    return audit.range_applied(listings(spark, d), "city", 50_000, 300_000).filter("n > 0")


@query(L + "SELECT listing_id, nullif(province, '') IS NOT DISTINCT FROM nullif(CASE WHEN CAST(listing_id AS BIGINT) % 2 = 0 THEN province END, '') AS applied FROM listings_v")
def f13_parameters(spark, d):
    v = listings(spark, d)
    return audit.parameters_applied(v, F.col("province"), F.when(F.col("listing_id").cast("long") % 2 == 0, F.col("province"))).select("listing_id", "applied")


BEFORE = "cnt AS (SELECT price, count(*) AS n FROM listings_v WHERE price IS NOT NULL GROUP BY price), bef AS (SELECT price, n, coalesce(sum(n) OVER (ORDER BY price ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cnt)"


@query(L + f", {BEFORE} SELECT CAST(floor(before / 500) AS BIGINT) AS shard, min(price) AS lo, max(price) AS hi, CAST(sum(n) AS BIGINT) AS n FROM bef GROUP BY 1")
def p3_price_shards(spark, d):
    return shards.price_shards(listings(spark, d), "price", 500)


@query(L + "SELECT price, count(*) AS n, count(*) - 48 AS excess FROM listings_v WHERE price IS NOT NULL GROUP BY price HAVING count(*) > 48")
def p4_degenerate_prices(spark, d):
    return shards.degenerate_prices(listings(spark, d), "price", 48)


@query(L + "SELECT city, count(*) AS n, count(*) > 48 AS split FROM listings_v GROUP BY city")
def p1_needs_split(spark, d):
    return shards.needs_split(listings(spark, d), "city", 48)


@query(L + """, s AS (SELECT property_type, list(price ORDER BY price) AS v, count(*) AS n FROM listings_v WHERE price IS NOT NULL GROUP BY 1), k AS (SELECT *, least(greatest(CAST(ceil(n / 40.0) AS BIGINT), 2), 60) AS k FROM s WHERE n > 1),
    i AS (SELECT property_type, v, n, k, unnest(range(1, k)) AS i FROM k) SELECT DISTINCT property_type, cut FROM (SELECT property_type, v[1 + CAST(round_even(i * (n - 1) / k, 0) AS BIGINT)] AS cut, v FROM i) WHERE cut > v[1] AND cut < v[-1]""")
def p2_quantile_cuts(spark, d):
    return shards.quantile_cuts(listings(spark, d), "property_type", "price")


@query(L + "SELECT listing_id, CAST(floor(p / 240) AS BIGINT) AS \"window\", CAST(floor(p % 240 / 48) AS BIGINT) AS page FROM (SELECT listing_id, row_number() OVER (ORDER BY price, listing_id) - 1 AS p FROM listings_v WHERE price IS NOT NULL)")
def p5_keyset_walk(spark, d):
    return shards.keyset_walk(listings(spark, d), "price", 48, 5).select("listing_id", "window", "page")


@query(f"""{L.replace('WITH ', 'WITH RECURSIVE ', 1)}, {BEFORE}, tot AS (SELECT sum(n) AS t FROM cnt), walk AS (SELECT 0 AS k, CAST(0 AS BIGINT) AS row0 UNION ALL
    SELECT k + 1, CAST(CASE WHEN e.before > walk.row0 THEN e.before ELSE s.before + s.n END AS BIGINT) FROM walk, tot, bef s, bef e WHERE s.before = walk.row0 AND walk.row0 + 2015 < t - 1 AND e.before <= walk.row0 + 2015 AND walk.row0 + 2015 < e.before + e.n AND CASE WHEN e.before > walk.row0 THEN e.before ELSE s.before + s.n END < t)
    SELECT k AS "window", price, row0 AS first_row, CAST(least(2016, t - row0) AS BIGINT) AS n_rows, CAST(greatest(lag(row0 + least(2016, t - row0)) OVER (ORDER BY k) - row0, 0) AS BIGINT) AS again FROM walk, tot, bef WHERE bef.before = walk.row0""")
def p5_keyset_windows(spark, d):
    return shards.keyset_windows(listings(spark, d), "price", 48, 42)


@query(L + "SELECT count(*) AS n, count(*) FILTER (WHERE price IS NULL) AS unpriced, round(CAST(count(*) FILTER (WHERE price IS NULL) AS DOUBLE) / count(*), 8) AS share FROM listings_v")
def p6_unpriced(spark, d):
    return shards.unpriced(listings(spark, d), "price").withColumn("share", F.round("share", 8))


@query(L + f", {BEFORE}, r AS (SELECT floor(before / 500) AS shard, min(price) AS lo, max(price) AS hi FROM bef GROUP BY 1) SELECT lo, lead(lo) OVER (ORDER BY lo) = hi AS meets_next FROM r")
def w10_contiguous(spark, d):
    return shards.contiguous(shards.price_shards(listings(spark, d), "price", 500), "lo", "hi").select("lo", "meets_next")


@query(L + "SELECT city, greatest(arg_max(floor(price), CAST(listing_id AS BIGINT)) FILTER (WHERE currency = 'MXN' AND price > 0), 100001) AS next_floor, max(price) FILTER (WHERE currency = 'MXN' AND price > 0) AS highest FROM listings_v GROUP BY city")
def w4_next_floor(spark, d):
    return shards.next_floor(listings(spark, d).withColumn("position", F.col("listing_id").cast("long")), "city", "position", 100_000)


@query(L + "SELECT listing_id, row_number() OVER (PARTITION BY city ORDER BY CAST(listing_id AS BIGINT)) AS position, CAST(sum(area_m2) OVER (PARTITION BY city ORDER BY CAST(listing_id AS BIGINT) ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS banked FROM listings_v")
def w11_positions(spark, d):
    return runlog.positions(listings(spark, d), "city", F.col("listing_id").cast("long"), "area_m2").select("listing_id", F.col("position").cast("long"), "banked")


RULES = "rules_v AS (SELECT run_id, seq, ts, CASE seq % 3 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'ERROR' ELSE 'INFO' END AS level, CASE WHEN seq % 11 = 0 THEN 'run start of two' WHEN seq % 11 = 1 THEN 'no run start' WHEN seq % 5 = 2 THEN 'a token minted again' WHEN seq % 37 = 3 THEN 'query aborted mid-sweep' WHEN seq % 11 = 4 THEN CONCAT('page ', CAST(seq AS STRING)) ELSE CONCAT('zone page ', CAST(seq AS STRING)) END AS msg FROM log_v)"


def rules(spark, d):
    """Lines whose level and wording tell the rules of a run's health apart."""
    return register(spark, d).sql(f"{G}, {RULES} SELECT * FROM rules_v")


LAST = "live AS (SELECT l.* FROM log_v l JOIN (SELECT run_id, max(seq) FILTER (WHERE starts_with(msg, 'run start')) AS f FROM log_v GROUP BY run_id) s ON s.run_id = l.run_id WHERE f IS NULL OR seq >= f)"


@query(G + f", {LAST} SELECT run_id, seq, msg FROM live")
def w5_since_last_start(spark, d):
    return runlog.since_last_start(log(spark, d)).select("run_id", "seq", "msg")


@query(G + "SELECT run_id, n, round(seconds, 3) AS seconds, CASE WHEN seconds > 0 THEN round((n - 1) * 3600 / seconds, 6) END AS per_hour FROM (SELECT run_id, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) AS r FROM log_v) WHERE r <= 20 GROUP BY run_id)")
def w6_recent_rate(spark, d):
    return runlog.recent_rate(log(spark, d), 20, None).select("run_id", "n", F.round("seconds", 3).alias("seconds"), F.round("per_hour", 6).alias("per_hour"))


@query(G + f", {RULES}, {LAST.replace('log_v', 'rules_v')} SELECT run_id, seq, msg FROM live")
def w5_since_last_start_by_prefix(spark, d):
    return runlog.since_last_start(rules(spark, d)).select("run_id", "seq", "msg")


@query(G + f", {RULES} SELECT run_id, n, round(seconds, 3) AS seconds, CASE WHEN seconds > 0 THEN round((n - 1) * 3600 / seconds, 6) END AS per_hour FROM (SELECT run_id, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) AS r FROM rules_v WHERE contains(msg, ' page ')) WHERE r <= 20 GROUP BY run_id)")
def w6_rate_of_progress(spark, d):
    return runlog.recent_rate(rules(spark, d), 20).select("run_id", "n", F.round("seconds", 3).alias("seconds"), F.round("per_hour", 6).alias("per_hour"))


@query(G + "SELECT run_id, count(*) AS streak, min(seq) AS first_seq FROM (SELECT *, sum(CASE WHEN level <> 'INFO' THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS island FROM log_v) WHERE level <> 'INFO' GROUP BY run_id, island HAVING count(*) >= 3")
def w7_bad_streaks(spark, d):
    return runlog.bad_streaks(log(spark, d), F.col("level") != "INFO").select("run_id", "streak", "first_seq")


@query(G + "SELECT run_id, seq FROM (SELECT *, sum(CASE WHEN level = 'WARNING' THEN 1 ELSE 0 END) OVER w AS g, count(*) OVER w AS n FROM log_v WINDOW w AS (PARTITION BY run_id ORDER BY ts, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE g = 0 AND n = 10")
def w8_dry_spells(spark, d):
    return runlog.dry_spells(log(spark, d), F.col("level") == "WARNING", 10).select("run_id", "seq")


@query(G + "SELECT run_id, seq, round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run_id ORDER BY ts, seq))) / 1e6, 3) AS gap_s FROM log_v")
def w9_gaps(spark, d):
    return runlog.gaps(log(spark, d)).select("run_id", "seq", F.round("gap_s", 3).alias("gap_s"))


@query(C + "SELECT query, bool_or(pos IS NULL) AS done, CASE WHEN NOT bool_or(pos IS NULL) THEN arg_max(pos, seq) FILTER (WHERE pos IS NOT NULL) END AS pos FROM checkpoints_v GROUP BY query")
def w3_fold_checkpoints(spark, d):
    return runlog.fold_checkpoints(view(spark, d, "checkpoints_v"))


@query(C + "SELECT query, pos, count(*) AS n FROM checkpoints_v GROUP BY query, pos")
def s7_checkpoint_tokens(spark, d):
    token = F.when(F.col("pos").isNull(), F.col("query")).otherwise(F.concat("query", F.lit("@"), "pos"))
    lines = view(spark, d, "checkpoints_v").select(F.concat(F.lit("  "), token, F.lit("  ")).alias("value"))
    return runlog.parse_checkpoints(lines).groupBy("query", "pos").agg(F.count(F.lit(1)).alias("n"))


@query(G + "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, level, msg FROM log_v WHERE seq % 10 <> 0")
def s6_run_log(spark, d):
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), F.col("level"), F.lit("   "), F.col("msg"))
    lines = log(spark, d).select(F.when(F.col("seq") % 10 == 0, F.concat(F.lit("junk "), line)).otherwise(line).alias("value"))
    return runlog.parse_log(lines).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "level", "msg")


@query(G + f", {LAST}, m AS (SELECT max(ts) AS now FROM log_v) SELECT run_id, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1e6, 3) AS idle_s, count(*) FILTER (WHERE contains(msg, 'token minted') AND ts > TIMESTAMP '2024-01-31' - INTERVAL 10 MINUTE) AS marks, count(*) FILTER (WHERE level = 'WARNING' AND contains(msg, 'aborted')) AS aborted, CASE WHEN (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1e6 > 600 OR count(*) FILTER (WHERE contains(msg, 'token minted') AND ts > TIMESTAMP '2024-01-31' - INTERVAL 10 MINUTE) > 3 OR count(*) FILTER (WHERE level = 'WARNING' AND contains(msg, 'aborted')) > 0 THEN 1 ELSE 0 END AS code FROM live GROUP BY run_id")
def r8_health(spark, d):
    return runlog.health(log(spark, d), "2024-01-31 00:00:00").withColumn("idle_s", F.round("idle_s", 3))


@query(G + f", {RULES}, {LAST.replace('log_v', 'rules_v')}, m AS (SELECT max(ts) AS now FROM rules_v) SELECT run_id, round((epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(ts))) / 1e6, 3) AS idle_s, count(*) FILTER (WHERE contains(msg, 'token minted') AND ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10 MINUTE) AS marks, count(*) FILTER (WHERE level = 'WARNING' AND contains(msg, 'aborted')) AS aborted, CASE WHEN (epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(ts))) / 1e6 > 600 OR count(*) FILTER (WHERE contains(msg, 'token minted') AND ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10 MINUTE) > 3 OR count(*) FILTER (WHERE level = 'WARNING' AND contains(msg, 'aborted')) > 0 THEN 1 ELSE 0 END AS code FROM live GROUP BY run_id")
def r8_health_by_rules(spark, d):
    return runlog.health(rules(spark, d), "2024-01-30 12:00:00").withColumn("idle_s", F.round("idle_s", 3))


@query(G + "SELECT (epoch_us(w) // 1000000) AS start_s, count(*) AS n, count(*) > 3 AS alert FROM (SELECT unnest(range(time_bucket(INTERVAL 1 MINUTE, ts) - INTERVAL 9 MINUTE, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS w FROM log_v WHERE msg = 'token minted') GROUP BY w")
def r4_event_rate(spark, d):
    n = flows.event_rate(log(spark, d).filter("msg = 'token minted'"), "ts")
    return n.select(F.unix_seconds(F.col("window.start").cast("timestamp")).alias("start_s"), "n", "alert")


@query(G + "SELECT run_id, epoch_us(min(ts)) // 1000000 AS start_s, count(*) AS n FROM (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run_id ORDER BY ts, seq)) AS gap FROM log_v)) GROUP BY run_id, s")
def r5_sessions(spark, d):
    n = flows.sessions(log(spark, d), "ts", keys=["run_id"])
    return n.select("run_id", F.unix_seconds(F.col("session_window.start").cast("timestamp")).alias("start_s"), "n")


@query("SELECT user_id % 20 AS page, count(*) AS n, bool_and(ts < TIMESTAMP '2024-01-10') AS old, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-10') AS exact FROM events GROUP BY 1")
def r3_delta(spark, d):
    rows = register(spark, d).table("events").withColumn("page", F.col("user_id") % 20)
    return runlog.page_facts(rows, "page", "ts", "2024-01-10")


DAYS = "CAST(datediff('day', CAST(ts AS DATE), DATE '2025-01-01') AS INT)"


def _dated(spark, d):
    """Events on a page a day, the newest first; one in fifty has no time."""
    dated = register(spark, d).table("events").withColumn("page", F.datediff(F.lit("2025-01-01").cast("date"), F.col("ts").cast("date")))
    return dated.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))


@query(f"WITH p AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts, {DAYS} AS page FROM events), o AS (SELECT min(page) AS last FROM (SELECT page, bool_and(coalesce(ts < TIMESTAMP '2024-01-20', false)) AS old FROM p GROUP BY page) WHERE old) SELECT event_id, page FROM p, o WHERE last IS NULL OR page <= last")
def r3_delta_walk(spark, d):
    return runlog.delta_pages(_dated(spark, d), "page", "ts", "2024-01-20").select("event_id", "page")


@query(f"WITH p AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts, {DAYS} AS page FROM events), o AS (SELECT min(page) AS last FROM (SELECT page, bool_and(coalesce(ts < TIMESTAMP '2024-01-20 06:00:00', false)) AS old FROM p GROUP BY page) WHERE old) SELECT event_id, page FROM p, o WHERE (last IS NULL OR page <= last) AND ts >= TIMESTAMP '2024-01-20 06:00:00'")
def r3_delta_exact(spark, d):
    return runlog.delta_pages(_dated(spark, d), "page", "ts", "2024-01-20 06:00:00", exact=True).select("event_id", "page")


@query(G + "SELECT r.user_id AS run_id, CASE WHEN l.run_id IS NULL THEN 2 ELSE 1 END AS code FROM (SELECT DISTINCT user_id FROM events UNION SELECT -1) r LEFT JOIN (SELECT DISTINCT run_id FROM log_v WHERE run_id % 3 <> 0) l ON l.run_id = r.user_id")
def r8_health_of_missing(spark, d):
    runs = log(spark, d).select("run_id").union(spark.sql("SELECT -1L"))
    return runlog.health(log(spark, d).filter("run_id % 3 <> 0"), "2034-01-31 00:00:00", runs=runs).select("run_id", "code")


@query(L + """, pool AS (SELECT property_type, list(price ORDER BY price) AS v, count(*) AS n FROM listings_v WHERE price <> 0 AND price BETWEEN 90000 AND 250000 AND CAST(listing_id AS BIGINT) % 7 = 0 AND property_type <> 'BUILDING' GROUP BY 1),
    r AS (SELECT property_type, 90000.0 AS lo, CASE WHEN property_type < 'F' THEN 250000.0 END AS hi, count(*) AS total FROM listings_v GROUP BY 1), pool2 AS (SELECT property_type, list(price ORDER BY price) AS v, count(*) AS n FROM listings_v WHERE price >= 90000 AND CAST(listing_id AS BIGINT) % 7 = 0 AND property_type >= 'F' GROUP BY 1),
    k AS (SELECT r.*, coalesce(p.v, []) AS v, coalesce(p.n, 0) AS n, least(greatest(CAST(ceil(total / 40.0) AS BIGINT), 2), 60) AS k FROM r LEFT JOIN (SELECT * FROM pool WHERE property_type < 'F' UNION ALL SELECT * FROM pool2) p ON p.property_type = r.property_type),
    c AS (SELECT property_type, lo, hi, CASE WHEN n >= 2 THEN list_transform(range(1, k), lambda i: v[1 + CAST(round_even(i * (n - 1) / k, 0) AS BIGINT)]) WHEN hi IS NULL THEN [greatest(lo * 4, 1000)] ELSE [floor(sqrt(lo * hi))] END AS cuts FROM k),
    u AS (SELECT property_type, lo, hi, list_sort(list_distinct(list_filter(cuts, lambda c: c > lo AND (hi IS NULL OR c < hi)))) AS cuts FROM c)
    SELECT property_type, CAST(i AS INT) AS position, CASE WHEN i = 0 THEN lo ELSE cuts[i] END AS lo, CASE WHEN i = len(cuts) THEN hi ELSE cuts[i + 1] END AS hi FROM (SELECT *, unnest(range(0, len(cuts) + 1)) AS i FROM u WHERE len(cuts) > 0)""")
def p2_split_ranges(spark, d):
    v = listings(spark, d)
    ranges = v.groupBy("property_type").agg(F.lit(90_000.0).alias("lo"), F.when(F.col("property_type") < "F", 250_000.0).alias("hi"), F.count(F.lit(1)).alias("total"))
    return shards.split_ranges(ranges, v.filter("listing_id % 7 = 0 AND property_type <> 'BUILDING'"), "property_type", "price")


@query(G + "SELECT run_id, CASE WHEN seconds > 0 THEN round(greatest(1000 - run_id, 0) / 42.0 / ((n - 1) * 3600 / seconds), 6) END AS hours_left FROM (SELECT run_id, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) AS r FROM log_v) WHERE r <= 20 GROUP BY run_id)")
def w6_remaining_time(spark, d):
    return runlog.remaining(runlog.recent_rate(log(spark, d), 20, None), 1000 - F.col("run_id"), 42).select("run_id", F.round("hours_left", 6).alias("hours_left"))


PAIRS = "seg AS (SELECT DISTINCT array_to_string(p[i:], '_') AS segment FROM (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT string_split(segment, '_') AS p FROM segments_v)))"


def _edges(spark, d):
    return audit.segment_edges(view(spark, d, "segments_v"))


@query(S + f", {PAIRS} SELECT segment AS child, CASE WHEN contains(segment, '_') THEN regexp_replace(segment, '^[^_]*_', '') ELSE '' END AS parent, len(string_split(segment, '_')) AS depth FROM seg")
def c24_j14_segment_tree(spark, d):
    return _edges(spark, d)


@query(S + f""", {PAIRS}, e AS (SELECT segment AS child, CASE WHEN contains(segment, '_') THEN regexp_replace(segment, '^[^_]*_', '') ELSE '' END AS parent FROM seg), t AS (SELECT segment, CAST(length(segment) AS BIGINT) AS n FROM seg)
    SELECT e.parent, p.n, CAST(sum(c.n) AS BIGINT) AS children, p.n = sum(c.n) AS "partition" FROM e JOIN t c ON c.segment = e.child JOIN t p ON p.segment = e.parent GROUP BY e.parent, p.n""")
def j13_tree_totals(spark, d):
    e = _edges(spark, d)
    totals = e.select(F.col("child").alias("segment"), F.length("child").cast("long").alias("n"))
    return audit.tree_totals(e.select("child", "parent"), totals)
