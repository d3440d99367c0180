"""Loading, search, joins and set operations over listing views."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from plazalake.functions import geo, text
from plazalake.operators import load, search
from plazalake.plans.registry import query
from plazalake.plans.views import register, view, with_views
from plazalake.sources import layout
from plazalake.sources.listings import decoded, encoded, union_corpora
from plazalake.sources.scratch import new_path
from plazalake.sources.versions import VersionedTable

L, O = with_views("listings_v"), with_views("observations_v")
LO = with_views("listings_v", "observations_v")
#: A search key in DuckDB, for the characters that the views hold.
KEY = "regexp_replace(replace(strip_accents(lower({0})), '²', '2'), '[^\\x00-\\x7F]', '', 'g')"
NORM = KEY.format("concat_ws(' ', nullif(city, ''), nullif(province, ''), nullif(title, ''))")
OK = "coalesce(NOT (lat = 0 AND lng = 0) AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180, false)"
NEAR = (19.0, -100.0)
DIST = "2 * 6371008.8 * asin(sqrt(least(1.0, power(sin(radians({2} - {0}) / 2), 2) + cos(radians({0})) * cos(radians({2})) * power(sin(radians({3} - {1}) / 2), 2))))"
D = DIST.format("lat", "lng", *NEAR)
LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY observed_at DESC NULLS LAST, price DESC, tie1, tie2, tie3) AS rn FROM observations_v) WHERE rn = 1"


def listings(spark, d):
    return view(spark, d, "listings_v")


def observations(spark, d):
    return view(spark, d, "observations_v")


def newest_first():
    return [F.col("observed_at").desc_nulls_last(), F.col("price").desc(), "tie1", "tie2", "tie3"]


def _latest(spark, d):
    return load.latest_per_key(observations(spark, d), ["listing_id"], newest_first())


@query(L + f"SELECT listing_id, {NORM} AS norm FROM listings_v")
def c1_search_key(spark, d):
    return search.with_norm(listings(spark, d)).select("listing_id", "norm")


@query(L + "SELECT listing_id, CASE trim(regexp_replace(replace(strip_accents(lower(concat(city, ',  ', province))), ',', ' '), '\\s+', ' ', 'g')) WHEN 'alvaro obregon 3 nation_7' THEN 'ao3' ELSE trim(regexp_replace(replace(strip_accents(lower(concat(city, ',  ', province))), ',', ' '), '\\s+', ' ', 'g')) END AS k FROM listings_v")
def c2_place_key(spark, d):
    return listings(spark, d).select("listing_id", text.place_key(F.concat("city", F.lit(",  "), "province"), {"alvaro obregon 3 nation_7": "ao3"}).alias("k"))


@query(L + f"SELECT listing_id, {OK} AS ok, CASE WHEN {OK} THEN lat END AS lat, CASE WHEN {OK} THEN lng END AS lng FROM listings_v")
def c13_point_ok(spark, d):
    p = geo.point(F.col("lat"), F.col("lng"))
    return listings(spark, d).select("listing_id", geo.point_ok(F.col("lat"), F.col("lng")).alias("ok"), p["lat"].alias("lat"), p["lng"].alias("lng"))


@query(L + "SELECT listing_id, round(sqrt(power((lat - 19.0) * 111, 2) + power((lng + 100.0) * 100 * cos(radians(lat)), 2)), 4) AS km FROM listings_v")
def c16_approx_km(spark, d):
    return listings(spark, d).select("listing_id", F.round(geo.approx_km(F.col("lat"), F.col("lng"), *map(F.lit, NEAR)), 4).alias("km"))


@query(L + f"SELECT listing_id, round({D}, 2) AS m FROM listings_v")
def c17_geodesic(spark, d):
    return listings(spark, d).select("listing_id", F.round(geo.haversine_m(F.col("lat"), F.col("lng"), *map(F.lit, NEAR)), 2).alias("m"))


def with_ellipsoid(table, to_lat, to_lng):
    """SQL: the table's rows with ``em``, their metres on the ellipsoid to a point, by the same first-order formula."""
    f = "(1 / 298.257223563E0)"
    angles = f"SELECT *, atan((1 - {f}) * tan(radians(lat))) AS b1, atan((1 - {f}) * tan(radians({to_lat}))) AS b2, radians({to_lng} - lng) AS dl FROM {table}"
    squares = f"SELECT *, least(pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(dl / 2), 2), 1.0E0) AS s2 FROM ({angles})"
    metres = f"6378137.0E0 * (2 * asin(sqrt(s2)) - {f} / 2 * ((2 * asin(sqrt(s2)) - sin(2 * asin(sqrt(s2)))) * pow(sin((b1 + b2) / 2) * cos((b2 - b1) / 2), 2) / greatest(1 - s2, 1e-30) + (2 * asin(sqrt(s2)) + sin(2 * asin(sqrt(s2)))) * pow(cos((b1 + b2) / 2) * sin((b2 - b1) / 2), 2) / greatest(s2, 1e-30)))"
    return f"(SELECT *, {metres} AS em FROM ({squares}))"


@query(L + f"SELECT listing_id, round(em, 2) AS m FROM {with_ellipsoid('listings_v', *NEAR)}")
def c17_ellipsoid(spark, d):
    return listings(spark, d).select("listing_id", F.round(geo.ellipsoid_m(F.col("lat"), F.col("lng"), *map(F.lit, NEAR)), 2).alias("m"))


@query(L + f"SELECT listing_id, round(em, 2) AS m FROM {with_ellipsoid('listings_v', *NEAR)} WHERE {OK} AND em <= 400000")
def f9_radius_ellipsoid(spark, d):
    return search.search(listings(spark, d), limit=None, near=NEAR, radius_m=400_000, model="ellipsoid").select("listing_id", F.round("distance_m", 2).alias("m"))


@query(L + "SELECT listing_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[^?#]*', 0) AS bare, concat('https://x.org/item/', listing_id) AS absolute FROM listings_v")
def c18_url_pieces(spark, d):
    return listings(spark, d).select("listing_id", text.url_host(F.col("url")).alias("host"), text.url_bare(F.col("url")).alias("bare"), text.url_absolute(F.concat(F.lit("item/"), "listing_id"), "https://x.org/").alias("absolute"))


@query(L + "SELECT listing_id, coalesce(nullif(province, ''), city) AS place, left(title, 12) AS short, concat_ws(' / ', nullif(city, ''), nullif(province, '')) AS joined FROM listings_v")
def c22_text_helpers(spark, d):
    return listings(spark, d).select("listing_id", text.falsy_coalesce("province", "city").alias("place"), F.left("title", F.lit(12)).alias("short"), F.concat_ws(" / ", F.nullif("city", F.lit("")), F.nullif("province", F.lit(""))).alias("joined"))


@query(L + "SELECT source, count(*) AS n, CAST(ceil(count(*) / 30.0) AS BIGINT) AS pages, round(100.0 * count(price) / count(*), 6) AS priced FROM listings_v GROUP BY source")
def c23_sizing_arithmetic(spark, d):
    n = F.count(F.lit(1))
    return listings(spark, d).groupBy("source").agg(n.alias("n"), F.count("price").alias("c")).select("source", "n", text.ceil_div(F.col("n"), 30).alias("pages"), F.round(100.0 * F.col("c") / F.col("n"), 6).alias("priced"))


@query(L + "SELECT listing_id, CASE currency WHEN 'USD' THEN 'USD' ELSE 'MXN' END AS code, CASE WHEN property_type IN ('BUILDING', 'MACHINERY') THEN area_m2 END AS plot, CASE WHEN property_type NOT IN ('BUILDING', 'MACHINERY') THEN area_m2 END AS built FROM listings_v")
def c6_c14_currency_and_area(spark, d):
    kinds = text.area_kinds(F.col("property_type"), F.col("area_m2"), ["BUILDING", "MACHINERY"])
    return listings(spark, d).select("listing_id", text.currency_code(F.col("currency")).alias("code"), kinds["plot"].alias("plot"), kinds["built"].alias("built"))


@query(L + "SELECT listing_id, CASE WHEN contains(lower(property_type), 'auto') THEN 'car' WHEN contains(lower(property_type), 'build') THEN 'house' ELSE 'other' END AS kind FROM listings_v")
def c11_classify(spark, d):
    return listings(spark, d).select("listing_id", text.classify(F.concat("property_type", F.lit(" en venta")), [("auto", "car"), ("build", "house")], F.lit("other")).alias("kind"))


@query(L + "SELECT listing_id, CASE CAST(listing_id AS BIGINT) % 4 WHEN 0 THEN 'Shop lot' WHEN 1 THEN 'Lot' WHEN 2 THEN 'Casa' ELSE 'House Boat' END AS kind FROM listings_v")
def c11_title_or_category(spark, d):
    k = F.col("listing_id").cast("long") % 4
    title = F.when(k == 0, "Lote Comercial en Roma").when(k == 1, "Gran Lote en Roma").when(k == 2, "Casa en Lote").otherwise(" en Roma")
    return listings(spark, d).select("listing_id", text.classify_title(title, [("Lote Comercial", "Shop lot"), ("Lote", "Lot")], F.lit("house boat")).alias("kind"))


@query(L + "SELECT listing_id, CASE WHEN length(listing_id) >= 5 THEN sha256(concat('salt', '+52', '55', lpad(listing_id, 8, '0'))) ELSE '' END AS phone FROM listings_v")
def c12_phone(spark, d):
    raw = F.when(F.length("listing_id") >= 5, F.concat(F.lit("+52 (55) "), F.lpad("listing_id", 8, "0"))).otherwise(F.lit("n/a 1"))
    return listings(spark, d).select("listing_id", text.phone(raw, "salt").alias("phone"))


@query(L + "SELECT listing_id, concat('+52', lpad(listing_id, 10, '0')) AS in_link, CASE WHEN CAST(listing_id AS BIGINT) % 2 = 0 THEN concat('52', lpad(listing_id, 10, '0')) ELSE '' END AS in_page FROM listings_v")
def c12_phone_forms(spark, d):
    number = F.lpad("listing_id", 10, "0")
    link = F.concat(F.lit("https://wa.example.com/send?phone=+52"), number, F.lit("&text=x"))
    spaced = F.concat(F.lit("Tel. (52) "), F.substring(number, 1, 5), F.lit("-"), F.substring(number, 6, 5), F.lit(" hoy"))
    page = F.when(F.col("listing_id").cast("long") % 2 == 0, spaced).otherwise("none")
    return listings(spark, d).select("listing_id", text.phone_in_link(link).alias("in_link"), text.phone_in_page(page).alias("in_page"))


@query(L + "SELECT listing_id, city AS c, coalesce(nullif(province, ''), city) AS p FROM listings_v")
def c20_c21_city_and_province(spark, d):
    return listings(spark, d).select("listing_id", text.city_of(F.concat(F.lit("Calle 1, "), "city", F.lit(", MX"))).alias("c"), text.province_of(F.col("province"), F.concat(F.lit("MX, "), "city")).alias("p"))


@query(L + "SELECT listing_id, strftime(listed_at, '%Y-%m-%d %H:%M:%S') AS t FROM listings_v")
def c9_utc_time(spark, d):
    iso = F.concat(F.date_format("listed_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return listings(spark, d).select("listing_id", F.date_format(text.utc_time(iso), "yyyy-MM-dd HH:mm:ss").alias("t"))


@query(L + "SELECT listing_id, CASE WHEN CAST(listing_id AS BIGINT) % 3 = 0 THEN NULL ELSE 1600000000000 + CAST(listing_id AS BIGINT) END AS ms FROM listings_v")
def c10_uuid7(spark, d):
    ms = F.col("listing_id").cast("long") + 1_600_000_000_000
    version = F.when(F.col("listing_id").cast("long") % 3 == 0, "4").otherwise("7")
    uuid = F.concat(F.substring(F.lpad(F.lower(F.hex(ms)), 12, "0"), 1, 8), F.lit("-"), F.substring(F.lpad(F.lower(F.hex(ms)), 12, "0"), 9, 4), F.lit("-"), version, F.lit("abc-8def-0123456789ab"))
    return listings(spark, d).select("listing_id", text.uuid7_millis(uuid).alias("ms"))


@query(L + "SELECT listing_id, CASE WHEN price > 0 THEN CAST(floor(price) AS BIGINT) END AS amount, CASE WHEN price > 0 THEN currency ELSE '' END AS cur FROM listings_v")
def c3_c4_price_text(spark, d):
    shown = F.when(F.col("price") > 0, F.concat(F.when(F.col("currency") == "USD", "US$ ").otherwise("$ "), F.format_number("price", 2))).otherwise("")
    return listings(spark, d).select("listing_id", text.price_amount(shown).alias("amount"), text.price_currency(shown).alias("cur"))


@query(L + "SELECT listing_id, CAST(listing_id AS DOUBLE) AS run, CAST(listing_id AS DOUBLE) * 10 + 7 AS digits, CAST(listing_id AS INT) AS whole, TRY_CAST(CAST(lat AS VARCHAR) AS DOUBLE) AS coord FROM listings_v")
def c3_c7_c8_numbers(spark, d):
    shown = F.concat(F.lit("about "), F.format_number(F.col("listing_id").cast("long"), 0), F.lit(" m2 of 7 x"))
    joined = F.concat(F.lit("n "), "listing_id", F.lit(" and 7"))
    return listings(spark, d).select("listing_id", text.first_number(shown).alias("run"), text.first_number(joined, "digits").alias("digits"), F.floor(text.first_number(shown, "spaced")).cast("int").alias("whole"), text.coordinate(F.col("lat").cast("string")).alias("coord"))


def _filter(name: str, where: str, **criteria):
    def run(spark, d):
        out = search.with_norm(listings(spark, d)).withColumn("bedrooms", (F.col("listing_id").cast("long") % 6).cast("int"))
        for p in search.predicates(**criteria):
            out = out.filter(p)
        return out.select("listing_id")

    run.__name__ = name
    query(L + f"SELECT listing_id FROM (SELECT *, {NORM} AS norm FROM listings_v) WHERE {where}")(run)


AS_OF = datetime(1997, 1, 1)
_filter("f1_zone", "contains(norm, 'm2') AND contains(norm, 'obregon') AND contains(norm, '17')", zone="Obregón 17 m²")
_filter("f2_city", "contains(norm, 'alvaro obregon 3')", city="Álvaro Obregón 3")
_filter("f3_operation", "operation = 'rent'", operation="rent")
_filter("f4_property_type", "contains(lower(property_type), 'mobile')", property_type="MOBILE")
_filter("f5_sources", "source IN ('1-URGENT', '5-LOW')", sources=["1-URGENT", "5-LOW"])
_filter("f6_price", "price >= 50000 AND price <= 150000 AND price > 0", min_price=50000, max_price=150000)
_filter("f7_area", "area_m2 >= 100 AND area_m2 <= 250", min_area=100, max_area=250)
_filter("f7_bedrooms", "CAST(listing_id AS BIGINT) % 6 >= 3", min_bedrooms=3)
_filter("f8_recent", "observed_at >= TIMESTAMP '1997-01-01' - INTERVAL 400 DAY", as_of=AS_OF, within=timedelta(days=400))
_filter("f9_radius", f"{OK} AND {D} <= 300000", near=NEAR, radius_m=300_000)


@query(L + f"SELECT listing_id, round({D}, 2) AS m FROM listings_v WHERE {OK} AND {D} <= 100000")
def f9_clustered_radius(spark, d):
    """The table is written sorted by cell; the search reads the row groups that its cells touch."""
    path = new_path(spark)
    layout.clustered(listings(spark, d)).write.parquet(path)
    found = search.search(spark.read.parquet(path), limit=None, near=NEAR, radius_m=100_000)
    return found.select("listing_id", F.round("distance_m", 2).alias("m"))


_SPREAD = "list_sum(list_transform(range(16), lambda i: (({0} >> i) & 1) << (2 * i)))"
_STEP = "CAST(least(floor(({0} - {1}) / {2} * 65536), 65535) AS BIGINT)"


@query(L + f"SELECT listing_id, CASE WHEN {OK} THEN CAST(2 * {_SPREAD.format(_STEP.format('lat', '-90.0E0', '180.0E0'))} + {_SPREAD.format(_STEP.format('lng', '-180.0E0', '360.0E0'))} AS BIGINT) END AS cell FROM listings_v")
def b20_cell(spark, d):
    return listings(spark, d).select("listing_id", layout.cell(F.col("lat"), F.col("lng")).alias("cell"))


@query(L + f"SELECT listing_id FROM listings_v WHERE contains(title, '7') AND property_type IN ('BUILDING', 'FURNITURE') AND NOT {OK}")
def f10_keep_filters(spark, d):
    return search.keep(listings(spark, d), "7", ["BUILDING", "FURNITURE"], without_point=True).select("listing_id")


@query(L + "SELECT listing_id, price FROM listings_v WHERE operation = 'sale' AND price >= 1000 ORDER BY price DESC NULLS LAST, listing_id LIMIT 20")
def t1_dearest(spark, d):
    return search.search(search.with_norm(listings(spark, d)), operation="sale", min_price=1000).select("listing_id", "price")


@query(L + f"SELECT listing_id, round({D}, 2) AS m FROM listings_v WHERE {OK} AND {D} <= 400000 ORDER BY {D}, listing_id LIMIT 10")
def t2_nearest(spark, d):
    return search.search(listings(spark, d), limit=10, near=NEAR, radius_m=400_000).select("listing_id", F.round("distance_m", 2).alias("m"))


@query(L + "SELECT listing_id FROM listings_v ORDER BY listed_at, listing_id LIMIT 15")
def t5_first(spark, d):
    return search.first(listings(spark, d), 15).select("listing_id")


@query(L + "SELECT listing_id FROM listings_v ORDER BY md5(concat('7:', listing_id)), listing_id LIMIT 50")
def t4_sample(spark, d):
    return search.sample(listings(spark, d), 50, seed=7).select("listing_id")


@query(L + "SELECT listing_id, price, rn - 1 AS position FROM (SELECT *, row_number() OVER (ORDER BY price NULLS FIRST, listing_id) AS rn FROM listings_v) WHERE rn > 1000 AND rn <= 1050")
def t6_price_page(spark, d):
    return search.page_by_price(listings(spark, d), 20, 50).select("listing_id", "price", F.col("position").cast("long"))


@query(L + "SELECT listing_id, CASE WHEN coalesce(price, 0) = 0 THEN 'no price' ELSE concat(CAST(CAST(floor(price) AS BIGINT) AS VARCHAR), ' ', currency) END AS price_text, CASE WHEN area_m2 = 0 THEN '' ELSE concat(CAST(CAST(area_m2 AS BIGINT) AS VARCHAR), ' m2') END AS area_text, city, coalesce(province, '') AS province FROM listings_v")
def b21_display(spark, d):
    return search.display(listings(spark, d))


@query(L + f", n AS (SELECT *, {D} AS m FROM listings_v WHERE {OK}) SELECT listing_id, CASE WHEN coalesce(price, 0) = 0 THEN 'no price' ELSE concat(CAST(CAST(floor(price) AS BIGINT) AS VARCHAR), ' ', currency, CASE WHEN CAST(listing_id AS BIGINT) % 2 = 0 THEN '/m2' ELSE '' END) END AS price_text, round(m / 1000, 1) AS km FROM n")
def b21_per_area_and_distance(spark, d):
    near = listings(spark, d).filter(geo.point_ok(F.col("lat"), F.col("lng"))).withColumn("distance_m", geo.haversine_m(F.col("lat"), F.col("lng"), F.lit(NEAR[0]), F.lit(NEAR[1])))
    shown = search.display(near.withColumn("price_is_per_m2", F.col("listing_id").cast("long") % 2 == 0))
    return shown.select("listing_id", "price_text", F.regexp_replace(F.regexp_replace("distance_text", " km$", ""), ",", "").cast("double").alias("km"))


@query(L + f"SELECT source, listing_id, url, price, currency, {NORM} AS norm, CASE WHEN {OK} THEN lat END AS lat, CASE WHEN {OK} THEN lng END AS lng FROM listings_v")
def b20_load_projection(spark, d):
    p = geo.point(F.col("lat"), F.col("lng"))
    return search.with_norm(listings(spark, d)).select("source", "listing_id", "url", "price", "currency", "norm", p["lat"].alias("lat"), p["lng"].alias("lng"))


@query(L + "SELECT listing_id, CASE WHEN lat IS NOT NULL THEN concat(CAST(CAST(floor(lat * 1000) AS BIGINT) AS VARCHAR), '/', CAST(CAST(floor(lng * 1000) AS BIGINT) AS VARCHAR)) ELSE '' END AS point, 0 AS photos FROM listings_v")
def b19_row_codec(spark, d):
    coded = decoded(listings(spark, d).select("listing_id", "lat", "lng"))
    cut = lambda c: F.floor(F.col(c) * 1000).cast("string")
    return coded.select("listing_id", F.when(F.col("coordinates").isNotNull(), F.concat(cut("coordinates.lat"), F.lit("/"), cut("coordinates.lng"))).otherwise("").alias("point"), F.size("photos").alias("photos"))


@query(L + "SELECT listing_id, lat, lng, CASE WHEN CAST(listing_id AS BIGINT) % 3 = 0 THEN url END AS photo FROM listings_v")
def b19_round_trip(spark, d):
    """Rows without photos, with an empty array of them, and with one go out and come back."""
    k = F.pmod(F.col("listing_id").cast("long"), F.lit(3))
    photos = F.when(k == 0, F.array("url")).when(k == 1, F.array().cast("array<string>"))
    back = encoded(decoded(listings(spark, d).select("listing_id", "lat", "lng", photos.alias("photos"))))
    return back.select("listing_id", "lat", "lng", F.get("photos", F.lit(0)).alias("photo"))


@query(O + f"SELECT listing_id, price, tie1, tie2, tie3 FROM ({LATEST})")
def w1_latest_per_key(spark, d):
    return _latest(spark, d).select("listing_id", "price", "tie1", "tie2", "tie3")


@query(O + "SELECT listing_id, tie1, tie2, tie3 FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY observed_at, price, tie1, tie2, tie3) AS rn FROM observations_v) WHERE rn = 1")
def w2_first_per_key(spark, d):
    return load.latest_per_key(observations(spark, d), ["listing_id"], [F.col(c) for c in ("observed_at", "price", "tie1", "tie2", "tie3")]).select("listing_id", "tie1", "tie2", "tie3")


BASE = "base AS (SELECT listing_id, price, lat, lng, listed_at AS observed_at FROM listings_v WHERE CAST(listing_id AS BIGINT) % 3 <> 0), fresh AS (SELECT listing_id, price, lat, lng, observed_at FROM (" + LATEST + ") WHERE CAST(listing_id AS BIGINT) % 5 <> 0)"


def _base_and_new(spark, d):
    b = listings(spark, d).filter(F.col("listing_id").cast("long") % 3 != 0).select("listing_id", "price", "lat", "lng", F.col("listed_at").alias("observed_at"))
    n = _latest(spark, d).filter(F.col("listing_id").cast("long") % 5 != 0).select("listing_id", "price", "lat", "lng", "observed_at")
    return b, n


@query(LO + ", " + BASE + " SELECT coalesce(f.listing_id, b.listing_id) AS listing_id, CASE WHEN f.listing_id IS NOT NULL THEN f.price ELSE b.price END AS price, coalesce(f.lat, b.lat) AS lat, coalesce(f.lng, b.lng) AS lng FROM base b FULL JOIN fresh f ON b.listing_id = f.listing_id")
def j3_upsert(spark, d):
    b, n = _base_and_new(spark, d)
    return load.upsert(b, n, ["listing_id"], keep_if_null=["lat", "lng"]).select("listing_id", "price", "lat", "lng")


@query(LO + ", " + BASE + ", n AS (SELECT l.source, f.* FROM fresh f JOIN listings_v l ON l.listing_id = f.listing_id WHERE l.source < '3'), b AS (SELECT l.source, x.* FROM base x JOIN listings_v l ON l.listing_id = x.listing_id) SELECT coalesce(n.source, b.source) AS source, coalesce(n.listing_id, b.listing_id) AS listing_id, CASE WHEN n.listing_id IS NOT NULL THEN n.price ELSE b.price END AS price, coalesce(n.lat, b.lat) AS lat FROM b FULL JOIN n ON b.listing_id = n.listing_id")
def j3_upsert_version(spark, d):
    """Two sources of five are touched: the new version takes the others over as they are."""
    b, n = _base_and_new(spark, d)
    sources = listings(spark, d).select("source", "listing_id")
    table = VersionedTable(spark, new_path(spark), "source")
    table.replace(b.join(sources, "listing_id"))
    table.upsert(n.join(sources, "listing_id").filter("source < '3'"), load.KEYS, keep_if_null=["lat", "lng"])
    return table.read().select("source", "listing_id", "price", "lat")


@query(LO + ", " + BASE + " SELECT coalesce(f.listing_id, b.listing_id) AS listing_id, CASE WHEN f.listing_id IS NOT NULL AND (b.observed_at IS NULL OR f.observed_at >= b.observed_at) THEN f.price ELSE b.price END AS price FROM base b FULL JOIN fresh f ON b.listing_id = f.listing_id")
def r9_newest_wins(spark, d):
    b, n = _base_and_new(spark, d)
    return load.upsert(b, n, ["listing_id"], newest="observed_at").select("listing_id", "price")


@query(LO + "SELECT l.listing_id, coalesce(p.lat, l.lat) AS lat, coalesce(p.lng, l.lng) AS lng FROM listings_v l LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY observed_at DESC NULLS LAST, price DESC, tie1, tie2, tie3) AS rn FROM observations_v WHERE lat IS NOT NULL AND lng IS NOT NULL) WHERE rn = 1) p ON p.listing_id = l.listing_id")
def j4_patch_points(spark, d):
    return load.patch_points(listings(spark, d), observations(spark, d), ["listing_id"], newest_first()).select("listing_id", "lat", "lng")


@query(L + "SELECT listing_id, CASE WHEN CAST(listing_id AS BIGINT) % 3 = 0 THEN 1.5 ELSE lat END AS lat, CASE WHEN CAST(listing_id AS BIGINT) % 3 = 0 THEN 2.5 ELSE lng END AS lng FROM listings_v")
def j4_exclude_suspect(spark, d):
    v, k = listings(spark, d), F.col("listing_id").cast("long")
    points = v.filter(k % 3 != 2).select("listing_id", F.lit(1.5).alias("lat"), F.lit(2.5).alias("lng"), F.when(k % 3 == 1, F.array(F.lit("repe"))).otherwise(F.array().cast("array<string>")).alias("suspect"))
    return load.patch_points(v, points, ["listing_id"], exclude_suspect=True).select("listing_id", "lat", "lng")


@query(LO + "SELECT l.listing_id FROM listings_v l WHERE NOT EXISTS (SELECT 1 FROM observations_v o WHERE o.listing_id = l.listing_id AND o.price > 60000)")
def j1_new_rows(spark, d):
    return load.new_rows(listings(spark, d), observations(spark, d).filter("price > 60000"), ["listing_id"]).select("listing_id")


@query(LO + "SELECT l.listing_id, l.operation FROM listings_v l WHERE NOT EXISTS (SELECT 1 FROM observations_v o WHERE o.listing_id = l.listing_id AND o.operation = l.operation)")
def j2_new_rows_by_operation(spark, d):
    return load.new_rows(listings(spark, d), observations(spark, d), ["listing_id", "operation"]).select("listing_id", "operation")


@query(L + ", p AS (SELECT DISTINCT province FROM listings_v WHERE province <> ''), o AS (SELECT DISTINCT operation FROM listings_v), t AS (SELECT DISTINCT property_type FROM listings_v), done AS (SELECT DISTINCT province, operation, property_type FROM listings_v WHERE operation = 'rent' OR province < 'M') SELECT * FROM (SELECT province, operation, property_type FROM p CROSS JOIN o CROSS JOIN t) EXCEPT SELECT * FROM done")
def j10_work_left(spark, d):
    v = listings(spark, d)
    named = v.filter("province <> ''").select("province").distinct()
    done = v.filter("operation = 'rent' OR province < 'M'").select("province", "operation", "property_type").distinct()
    return load.work_left([named, v.select("operation").distinct(), v.select("property_type").distinct()], done)


@query(L + ", a AS (SELECT listing_id FROM listings_v WHERE CAST(listing_id AS BIGINT) % 3 <> 0), b AS (SELECT listing_id FROM listings_v WHERE CAST(listing_id AS BIGINT) % 4 <> 0) SELECT coalesce(a.listing_id, b.listing_id) AS listing_id, CASE WHEN b.listing_id IS NULL THEN 'add' WHEN a.listing_id IS NULL THEN 'delete' ELSE 'keep' END AS action FROM a FULL JOIN b ON a.listing_id = b.listing_id")
def j11_reconcile(spark, d):
    v, k = listings(spark, d), F.col("listing_id").cast("long")
    return load.reconcile(v.filter(k % 3 != 0), v.filter(k % 4 != 0), "listing_id")


@query(L + ", a AS (SELECT listing_id, price, city FROM listings_v WHERE CAST(listing_id AS BIGINT) % 3 <> 0), b AS (SELECT listing_id, CASE WHEN CAST(listing_id AS BIGINT) % 10 = 0 THEN 1.0 ELSE price END AS price, city FROM listings_v WHERE CAST(listing_id AS BIGINT) % 4 <> 0) SELECT * FROM (SELECT coalesce(a.listing_id, b.listing_id) AS listing_id, CASE WHEN a.listing_id IS NULL THEN 'added' WHEN b.listing_id IS NULL THEN 'removed' WHEN a.price IS DISTINCT FROM b.price OR a.city IS DISTINCT FROM b.city THEN 'changed' END AS change FROM a FULL JOIN b ON a.listing_id = b.listing_id) WHERE change IS NOT NULL")
def j12_snapshot_diff(spark, d):
    v, k = listings(spark, d), F.col("listing_id").cast("long")
    after = v.filter(k % 4 != 0).withColumn("price", F.when(k % 10 == 0, F.lit(1.0)).otherwise(F.col("price")))
    return load.snapshot_diff(v.filter(k % 3 != 0), after, "listing_id", ["price", "city"])


@query(L + "SELECT listing_id, source, CAST(price AS DOUBLE) AS price, city FROM listings_v WHERE operation = 'rent' UNION ALL SELECT listing_id, source, NULL, city FROM listings_v WHERE operation = 'sale'")
def s3_u1_union(spark, d):
    v = listings(spark, d)
    return union_corpora([v.filter("operation = 'rent'").select("listing_id", "source", "price", "city"), v.filter("operation = 'sale'").select("city", "listing_id", "source")])


@query(L + "SELECT DISTINCT city, province FROM listings_v")
def u2_distinct(spark, d):
    return listings(spark, d).select("city", "province").distinct()


@query(L + "SELECT n_name AS province FROM nation EXCEPT SELECT province FROM listings_v WHERE price > 1000 AND CAST(listing_id AS BIGINT) % 3 = 0 AND right(province, 1) < '5'")
def u3_except(spark, d):
    v = listings(spark, d)
    some = v.filter("price > 1000 AND listing_id % 3 = 0 AND right(province, 1) < '5'")
    return spark.table("nation").select(F.col("n_name").alias("province")).subtract(some.select("province"))


@query(L + "SELECT n_name AS province FROM nation INTERSECT SELECT province FROM listings_v WHERE price > 400000")
def u4_intersect(spark, d):
    v = listings(spark, d)
    return spark.table("nation").select(F.col("n_name").alias("province")).intersect(v.filter("price > 400000").select("province"))


@query(L + ", s AS (SELECT listing_id, lat, lng FROM listings_v WHERE CAST(listing_id AS BIGINT) % 2 = 0) SELECT s.listing_id, l.city, l.province FROM s LEFT JOIN listings_v l ON s.listing_id = l.listing_id")
def j6_sidecar(spark, d):
    v = listings(spark, d)
    points = v.filter(F.col("listing_id").cast("long") % 2 == 0).select("listing_id")
    return load.with_context(points, v, "listing_id", ["city", "province"])


@query(L + "SELECT listing_id, coalesce(nullif(CASE WHEN price > 200000 THEN province END, ''), city) AS city, coalesce(CASE WHEN CAST(listing_id AS BIGINT) % 7 = 0 THEN NULL ELSE area_m2 END, 1.0) AS area_m2 FROM listings_v")
def b22_backfill(spark, d):
    v = listings(spark, d).withColumn("found", F.when(F.col("price") > 200000, F.col("province"))).withColumn("area", F.when(F.col("listing_id").cast("long") % 7 != 0, F.col("area_m2")))
    return load.backfilled(v, city=["found", "city"]).select("listing_id", "city", F.coalesce("area", F.lit(1.0)).alias("area_m2"))


def flagship(spark, d):
    """Observations to latest rows, upserted into the base, then searched by place, price and distance."""
    base = listings(spark, d)
    fresh = _latest(spark, d).select("listing_id", F.col("price").alias("_price"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("operation").alias("_operation"))
    new = base.join(fresh, "listing_id").select(
        "source", "listing_id", "url", "title", F.col("_operation").alias("operation"), F.col("_price").alias("price"), "currency", "property_type", "area_m2", "city", "province",
        F.col("_lat").alias("lat"), F.col("_lng").alias("lng"), "listed_at", "observed_at",
    )
    merged = load.upsert(base, new, load.KEYS, keep_if_null=["lat", "lng"])
    found = search.search(search.with_norm(merged), zone="Álvaro Obregón", operation="sale", max_price=200_000, near=NEAR, radius_m=900_000)
    return found.select("listing_id", "price", "city", "province", F.round("distance_m", 2).alias("m"))


query(
    LO + f""", fresh AS ({LATEST}), m AS (SELECT l.listing_id, CASE WHEN f.listing_id IS NULL THEN l.operation ELSE f.operation END AS operation,
    CASE WHEN f.listing_id IS NULL THEN l.price ELSE f.price END AS price, l.city, l.province, l.title, coalesce(f.lat, l.lat) AS lat, coalesce(f.lng, l.lng) AS lng
    FROM listings_v l LEFT JOIN fresh f ON l.listing_id = f.listing_id)
    SELECT listing_id, price, city, province, round({D}, 2) AS m FROM m WHERE contains({NORM}, 'alvaro') AND contains({NORM}, 'obregon') AND operation = 'sale'
    AND price <= 200000 AND price > 0 AND {OK} AND {D} <= 900000 ORDER BY {D}, listing_id LIMIT 20"""
)(flagship)
