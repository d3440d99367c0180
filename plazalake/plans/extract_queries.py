"""Extraction from stored pages: hydration blobs, JSON-LD, cards, chips, urls, verdicts."""

from __future__ import annotations

import gc

from pyspark.sql import functions as F

from plazalake.functions import text
from plazalake.operators import extract, load
from plazalake.plans.registry import query
from plazalake.plans.search_queries import L, listings
from plazalake.plans.views import VIEWS, register, view, with_views
from plazalake.sources import layout
from plazalake.sources import pages as page_files
from plazalake.sources.listings import sitemap_urls
from plazalake.sources.scratch import new_path

P = with_views("pages_v")
S = with_views("segments_v")


def part(spark, d):
    """The parts over all tasks: a page or a blob made of each is far more work than its bytes in the file tell."""
    return layout.spread(register(spark, d).table("part"), "p_partkey")


def pages(spark, d):
    part(spark, d).createOrReplaceTempView("part")
    return spark.sql(VIEWS["pages_v"])


def stored(spark, d):
    return register(spark, d).table("pages")


@query(P + "SELECT page_id, CAST(json_extract(b, '$.paging.total') AS INT) AS total, CAST(json_extract(b, '$.paging.totalPages') AS INT) AS total_pages FROM (SELECT page_id, regexp_extract(html, 'window\\.S = (\\{.*?\\}\\});', 1) AS b FROM pages_v)")
def b1_b3_hydration_blob(spark, d):
    blob = extract.paging(extract.script_json(F.col("html"), "preloadedData"))
    return pages(spark, d).select("page_id", blob.alias("p")).select("page_id", "p.total", "p.total_pages")


def other_tags(spark, d):
    """The pages with other spellings of the same script tags."""
    html = F.replace("html", F.lit('<script id="preloadedData">'), F.lit("<SCRIPT data-id='x' async id='preloadedData' nonce=\"1\">"))
    html = F.replace(html, F.lit('<script type="application/ld+json">'), F.lit("<script nonce=\"a\" type='application/ld+json' data-n=1>"))
    return pages(spark, d).withColumn("html", html)


@query(P + "SELECT page_id, CAST(json_extract(b, '$.paging.total') AS INT) AS total, CAST(json_extract(b, '$.paging.totalPages') AS INT) AS total_pages FROM (SELECT page_id, regexp_extract(html, 'window\\.S = (\\{.*?\\}\\});', 1) AS b FROM pages_v)")
def b1_blob_by_id(spark, d):
    blob = extract.paging(extract.script_json(F.col("html"), "preloadedData"))
    return other_tags(spark, d).select("page_id", blob.alias("p")).select("page_id", "p.total", "p.total_pages")


@query(P + "SELECT page_id, 1000 AS position, regexp_extract(html, '\"name\":\"([^\"]*)\"', 1) AS name, CAST(regexp_extract(html, '\"price\":([0-9]+)', 1) AS INT) AS price FROM pages_v")
def b6_json_ld_by_type(spark, d):
    nodes = extract.json_ld(other_tags(spark, d), "RealEstateListing")
    return nodes.select("page_id", "position", F.get_json_object("node", "$.name").alias("name"), F.get_json_object("node", "$.offers.price").cast("int").alias("price"))


def _postings(spark, d):
    offers = F.array(*(F.struct(F.struct(F.lit(name).alias("name")).alias("operationType"), F.array(F.struct(price.alias("amount"), F.lit("MXN").alias("currency"))).alias("prices")) for name, price in (("Renta", F.lit(5.5)), ("Venta", F.when(F.col("p_size") % 5 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice"))))))
    one = F.struct(F.when(F.col("p_partkey") % 11 != 0, F.col("p_partkey").cast("string")).alias("postingId"), F.concat(F.lit("/p/"), "p_partkey").alias("url"), F.col("p_name").alias("title"), offers.alias("priceOperationTypes"))
    other = F.struct(F.concat(F.lit("x"), "p_partkey").alias("postingId"), F.lit("/q").alias("url"), F.lit("t").alias("title"), F.slice(offers, 1, 1).alias("priceOperationTypes"))
    return part(spark, d).select(F.col("p_partkey").alias("page_id"), F.to_json(F.array(other, one)).alias("postings"))


@query("SELECT p_partkey AS page_id, 0 AS position, concat('x', p_partkey) AS listing_id, '/q' AS url, CAST(NULL AS BIGINT) AS price, '' AS currency FROM part UNION ALL SELECT p_partkey, 1, CAST(p_partkey AS VARCHAR), concat('/p/', p_partkey), CASE WHEN p_size % 5 <> 0 THEN CAST(floor(p_retailprice) AS BIGINT) END, 'MXN' FROM part WHERE p_partkey % 11 <> 0")
def b4_b5_postings(spark, d):
    return extract.explode_postings(_postings(spark, d), "venta")


@query("SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 <> 0 THEN concat('x', p_partkey) END AS first_id FROM part")
def b2_find_postings(spark, d):
    blobs = _postings(spark, d).select("page_id", F.when(F.col("page_id") % 3 == 0, F.lit('{"a":[1,{"b":[]}]}')).otherwise(F.concat(F.lit('{"a":[[]],"deep":{"er":[{"list":'), "postings", F.lit("}]}}"))).alias("blob"))
    found = extract.find_postings(blobs)
    return found.select("page_id", F.get_json_object("postings", "$[0].postingId").alias("first_id"))


@query(P + "SELECT page_id, 1000 AS position, regexp_extract(html, '\"name\":\"([^\"]*)\"', 1) AS name, CAST(regexp_extract(html, '\"price\":([0-9]+)', 1) AS INT) AS price FROM pages_v")
def b6_json_ld(spark, d):
    nodes = extract.json_ld(pages(spark, d), "RealEstateListing")
    return nodes.select("page_id", "position", F.get_json_object("node", "$.name").alias("name"), F.get_json_object("node", "$.offers.price").cast("int").alias("price"))


@query(P + "SELECT regexp_extract(html, '\"name\":\"([^\"]*)\"', 1) AS name, CAST(arg_max(CAST(regexp_extract(html, '\"price\":([0-9]+)', 1) AS INT), page_id) AS INT) AS price FROM pages_v GROUP BY 1")
def b7_last_node(spark, d):
    nodes = extract.json_ld(pages(spark, d), "RealEstateListing").select(F.get_json_object("node", "$.name").alias("name"), F.col("page_id").alias("position"), "node")
    return extract.last_node_by_key(nodes, "name").select("name", F.get_json_object("node", "$.offers.price").cast("int").alias("price"))


@query(P + "SELECT page_id, 0 AS position, CAST(page_id AS VARCHAR) AS id, concat(regexp_extract(html, 'class=\"price\">([^<]*)<', 1)) AS price FROM pages_v")
def b8_cards(spark, d):
    return extract.cards(pages(spark, d), "card", {"id": "", "price": "price"})


@query(P + "SELECT page_id, 0 AS position, CAST(page_id AS VARCHAR) AS id, regexp_extract(html, 'class=\"price\">([^<]*)<', 1) AS price FROM pages_v")
def b8_cards_in_sql(spark, d):
    extract.register_functions(spark)
    return spark.sql("SELECT page_id, c.position, c.fields['id'] AS id, c.fields['price'] AS price FROM {pages}, LATERAL cards(html, 'card', 'id, price=price') c", pages=pages(spark, d))


#: A tree over the parts: the parent of k is k div 2; every 97th hangs below its own child, and every 31st has no parent.
PLACES = "SELECT p_partkey AS id, CASE WHEN p_partkey % 97 = 0 THEN p_partkey * 2 WHEN p_partkey % 31 = 0 OR p_partkey = 1 THEN NULL ELSE p_partkey {0} 2 END AS parent_id, CASE WHEN p_size % 25 = 0 THEN 'city' ELSE 'zone' END AS label, p_name AS name FROM part"


@query("WITH RECURSIVE p AS (" + PLACES.format("//") + "), up AS (SELECT id AS start, *, CAST(0 AS INT) AS depth, [id] AS seen FROM p UNION ALL SELECT up.start, p.*, up.depth + 1, list_append(seen, p.id) FROM up JOIN p ON p.id = up.parent_id WHERE up.label <> 'city' AND NOT list_contains(seen, p.id)) SELECT p.id, up.name, up.depth FROM p LEFT JOIN up ON up.start = p.id AND up.label = 'city'")
def b11_ancestor_at_any_depth(spark, d):
    places = register(spark, d).sql(PLACES.format("div"))
    return extract.ancestors(places, places, "city")


@query(P + "SELECT page_id, coalesce(CASE WHEN page_id % 2 = 0 THEN regexp_extract(html, '\"name\":\"([^\"]*)\"', 1) END, concat('card ', page_id)) AS name FROM pages_v")
def b9_detail_enrichment(spark, d):
    base = pages(spark, d).select("page_id", F.concat(F.lit("card "), "page_id").alias("name"))
    detail = extract.json_ld(pages(spark, d), "RealEstateListing").filter("page_id % 2 = 0").select("page_id", F.get_json_object("node", "$.name").alias("name"))
    return load.enriched(base, detail, "page_id", ["name"])


@query("SELECT p_partkey AS page_id, p_type AS kind, CAST(p_size AS VARCHAR) AS size, p_name AS name FROM part")
def b10_label_map(spark, d):
    e = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    specs = F.array(e("kind", F.col("p_brand")), e("size", F.col("p_size").cast("string")), e("kind", F.col("p_type")))
    m = extract.label_map(specs, F.array(e("size", F.lit("no")), e("name", F.col("p_name"))))
    return register(spark, d).table("part").select(F.col("p_partkey").alias("page_id"), m["kind"].alias("kind"), m["size"].alias("size"), m["name"].alias("name"))


@query("SELECT c_custkey AS id, r_name AS region, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE n_name END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def b11_ancestor(spark, d):
    register(spark, d)
    rows = spark.sql("SELECT c_custkey AS id, to_json(named_struct('label', 'ZONE', 'name', c_name, 'parent', named_struct('label', if(c_custkey % 3 = 0, 'STATE', 'COUNTRY'), 'name', n_name, 'parent', named_struct('label', 'REGION', 'name', r_name)))) AS j FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
    v = rows.select("id", F.parse_json("j").alias("v"))
    return v.select("id", extract.ancestor(F.col("v"), "REGION").alias("region"), extract.ancestor(F.col("v"), "COUNTRY").alias("country"))


@query("SELECT p_partkey AS page_id, concat('https://i.org/D_NQ_NP_2-MLM', p_partkey, '_1-O-', s, '.webp|https://i.org/D_NQ_NP_7-MLM8', p_partkey, '_1-O-', s, '.jpg|https://i.org/', s, '.jpg') AS photos FROM (SELECT p_partkey, concat(lpad(CAST(p_partkey AS VARCHAR), 12, '0'), 'abcdefgh') AS s FROM part)")
def b12_gallery(spark, d):
    slug = F.concat(F.lpad(F.col("p_partkey").cast("string"), 12, "0"), F.lit("abcdefgh"))
    u = lambda form, n, size, who, end: F.concat(F.lit(f"https://i.org/D_{form}{n}"), F.col("p_partkey").cast("string"), F.lit(f"_1-{size}-"), who, F.lit(end))
    other, plain = F.lit("other"), F.concat(F.lit("https://i.org/"), slug, F.lit(".jpg"))
    urls = F.array(u("NQ_NP_2X_2-MLM", "", "F", slug, ".webp"), u("NQ_NP_9-MLM", 9, "F", other, ".webp"), u("Q_NP_3-MLM", "", "V", slug, ".jpg"), u("Q_NP_7-MLM", 8, "V", slug, ".jpg"), plain, plain)
    # the form without the size prefix carries the number after the dash: 2-MLM7 is photo MLM7
    return register(spark, d).table("part").select(F.col("p_partkey").alias("page_id"), F.array_join(extract.gallery(urls, F.concat(slug, F.lit("-tail"))), "|").alias("photos"))


@query(L + "SELECT listing_id, lat, lng FROM listings_v WHERE lat IS NOT NULL AND CAST(listing_id AS BIGINT) % 4 <> 3 AND lat <> 0 UNION ALL SELECT listing_id, NULL, NULL FROM listings_v WHERE coalesce(lat, 0) <> 0 AND CAST(listing_id AS BIGINT) % 4 = 3")
def b13_coordinates(spark, d):
    v = listings(spark, d).filter("coalesce(lat, 0) <> 0")
    a, b, k = F.col("lat").cast("string"), F.col("lng").cast("string"), F.col("listing_id").cast("long") % 4
    html = F.when(k == 0, F.concat(F.lit('{"latitude":'), a, F.lit(',"longitude":'), b, F.lit("}"))).when(k == 1, F.concat(F.lit("map?center="), a, F.lit("%2C"), b)).when(k == 2, F.concat(F.lit('<i data-lat="'), a, F.lit('" data-lng="'), b, F.lit('">'))).otherwise(F.concat(F.lit('"latitude":'), a))
    p = extract.coordinates(html)
    return v.select("listing_id", p["lat"].alias("lat"), p["lng"].alias("lng"))


@query("SELECT p_partkey AS page_id, CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_partkey * 1000 + p_size AS INT) END AS n FROM part")
def b14_result_count(spark, d):
    n = F.translate(F.format_number(F.col("p_partkey") * 1000 + F.col("p_size"), 0), ",", ".")
    shown = F.when(F.col("p_size") % 4 == 0, "sin datos").otherwise(F.concat(n, F.lit(" resultados")))
    return register(spark, d).table("part").select(F.col("p_partkey").alias("page_id"), extract.result_count(shown).alias("n"))


@query("SELECT p_partkey AS page_id, CASE WHEN p_size % 3 <> 0 THEN CAST(p_partkey AS INT) END AS n FROM part")
def b14_total_attribute(spark, d):
    number = F.when(F.col("p_size") % 3 == 0, F.lit("many")).otherwise(F.col("p_partkey").cast("string"))
    html = F.concat(F.lit("<main><div class=x data-total='"), number, F.lit("'>7</div><b data-total=1>"))
    return register(spark, d).table("part").select(F.col("p_partkey").alias("page_id"), extract.total_attribute(html).alias("n"))


@query("SELECT p_partkey AS page_id, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS INT) END AS total FROM part")
def b3_paging_at_any_depth(spark, d):
    deep = F.concat(F.lit('{"a":[[{"b":{"paging":7,"c":{"paging":{"total":'), F.col("p_size").cast("string"), F.lit("}}}}]]}"))
    found = extract.find_paging(part(spark, d).select(F.col("p_partkey").alias("page_id"), F.when(F.col("p_size") % 4 == 0, F.lit('{"paging":[1]}')).otherwise(deep).alias("blob")))
    return found.select("page_id", F.get_json_object("paging", "$.total").cast("int").alias("total"))


@query("SELECT p_partkey AS page_id, concat('x', p_partkey) AS first_id FROM part")
def b2_last_branch_first(spark, d):
    first, last = F.lit('{"a":{"l":[{"postingId":"no"}]},"b":[{"c":[1]},'), F.lit('"}]}}]}')
    blobs = part(spark, d).select(F.col("p_partkey").alias("page_id"), F.concat(first, F.lit('{"d":{"l":[{"postingId":"x'), F.col("p_partkey").cast("string"), last).alias("blob"))
    return extract.find_postings(blobs).select("page_id", F.get_json_object("postings", "$[0].postingId").alias("first_id"))


@query(P + "SELECT page_id, CAST(page_id AS VARCHAR) AS id, regexp_extract(url, '^[^?]*', 0) AS url FROM pages_v")
def b15_harvest(spark, d):
    html = F.concat(F.lit("<a href='"), "url", F.lit("'><a href='"), "url", F.lit("#again'>"))
    return extract.harvest_urls(pages(spark, d).select("page_id", html.alias("html")), r"https://shop\.example\.com/[^/']+/MLM-[^']+").select("page_id", F.regexp_extract("url", r"MLM-(\d+)", 1).alias("id"), "url")


@query(L + "SELECT listing_id, operation, property_type AS kind, concat(city, ', ', province) AS address FROM listings_v")
def b16_subtitle(spark, d):
    shown = F.concat(F.lit(" "), "property_type", F.when(F.col("listing_id").cast("long") % 2 == 0, " en ").otherwise("  EN\t"), F.when(F.col("operation") == "rent", "Renta").otherwise("venta"), F.lit(", rentable"))
    s = extract.subtitle(shown)
    texts = F.array(F.lit("120,5 m²"), F.concat("city", F.lit(", "), "province"))
    return listings(spark, d).select("listing_id", s["operation"].alias("operation"), s["kind"].alias("kind"), extract.address(texts).alias("address"))


@query("SELECT p_partkey AS page_id, CAST(p_size AS DOUBLE) AS built, CAST(NULL AS DOUBLE) AS plot FROM part")
def b17_area_chips(spark, d):
    html = F.concat(F.lit("<li>1 m² construidos</li>"), "html")
    return pages(spark, d).select("page_id", extract.area_chip(html, "construidos").alias("built"), extract.area_chip(html, "totales").alias("plot"))


@query("SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'login' WHEN page_id % 6 = 1 THEN 'pow' WHEN page_id % 6 IN (2, 3) THEN 'ok' WHEN page_id % 6 = 4 THEN 'unknown' WHEN length(html) < 2000 THEN 'unknown' ELSE 'no-coords' END AS verdict FROM pages")
def b18_verdict(spark, d):
    k, wall, point = F.col("page_id") % 6, F.lit("<b>Log</b> in <i>to</i><br/>continue"), F.lit('"latitude":1.5,"longitude":2.5')
    html = F.when(k == 0, F.concat("html", wall)).when(k == 1, F.concat("html", F.lit("Verify you <b>are</b> human"))).when(k == 2, F.concat("html", wall, point))
    html = html.when(k == 3, point).when(k == 4, F.lit("<html>short</html>")).otherwise(F.col("html"))
    return stored(spark, d).select("page_id", extract.verdict(html, 2000, ("inicia sesión", "log in to continue"), (), ("verify you are human",)).alias("verdict"))


@query("SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'login' WHEN 1 THEN 'pow' WHEN 2 THEN 'pow' WHEN 3 THEN 'ok' ELSE CASE WHEN length(html) < 2000 THEN 'unknown' ELSE 'no-coords' END END AS verdict FROM pages")
def b18_verdict_by_fixed_signs(spark, d):
    """A wall cut by a tag, challenges only in the page as it is, a point that outweighs both, phrases of other sites."""
    k, wall = F.col("page_id") % 6, F.lit("<b>Ingresa</b> a<br/>tu cuenta")
    more = F.when(k == 0, wall).when(k == 1, F.lit("<script src='/bot_challenge.js'></script>")).when(k == 2, F.lit("<i data-k='_bmc'></i>"))
    more = more.when(k == 3, F.concat(wall, F.lit('_bmc "latitude":1.5,"longitude":2.5'))).when(k == 4, F.lit("")).otherwise(F.lit(""))
    return stored(spark, d).select("page_id", extract.verdict(F.concat("html", more), 2000).alias("verdict"))


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1")
def s4_stored_pages(spark, d):
    return stored(spark, d).groupBy(text.url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("chars"))


#: Folders of saved pages of either packing, in a portion.
FOLDERS = 128
#: Pages that are written, listed and read at a time; the driver holds the paths of their files and then lets them go.
PORTION = 30_000


def _saved(spark, named, path):
    """The pages written below a new folder, read back and judged."""
    for packing in ("none", "gzip"):
        part = named.filter(F.col("packing") == packing).select("html", F.concat("packing", F.lit("-"), F.pmod("number", F.lit(FOLDERS))).alias("folder"), "page")
        layout.spread(part, "folder").write.partitionBy("folder", "page").option("compression", packing).text(f"{path}/{packing}")
    found, _ = page_files.read_pages(spark, path, r"page=([^/]*)/", "*.{txt,txt.gz}")
    html = F.regexp_replace("html", "\n$", "")  # the text sink ends its lines
    return found.select(F.substring_index("url", " ", 1).cast("long").alias("page_id"), F.regexp_replace("url", "^[^ ]* ", "").alias("url"), extract.verdict(html, 2000).alias("verdict"), F.length(html).alias("n"))


@query("SELECT page_id, url, CASE WHEN length(html) < 2000 THEN 'unknown' ELSE 'no-coords' END AS verdict, CAST(length(html) AS INT) AS n FROM pages")
def s4_saved_pages(spark, d):
    """Every page as a file of its own, half of them gzipped, in folders named by url; read back and judged. These
    folders lie in others that one task writes and one moves or lists whole. A portion of the pages is done before the
    next begins, and its rows are stored; those of the last one are read from its files."""
    path, page, crc = new_path(spark), F.concat_ws(" ", "page_id", "url"), F.col("crc")
    last = max(0, (stored(spark, d).count() - 1) // PORTION)
    named = stored(spark, d).select("html", page.alias("page"), F.crc32(page.cast("binary")).alias("crc"), F.pmod(F.xxhash64(page), F.lit(last + 1)).alias("portion"))
    named = named.select("html", "page", F.floor(crc / 2).alias("number"), "portion", F.when(F.pmod(crc, F.lit(2)) == 0, "none").otherwise("gzip").alias("packing"))
    if last:
        layout.spread(named, "portion", "packing").write.partitionBy("portion", "packing").parquet(f"{path}/dealt")
        named = spark.read.schema(named.schema).parquet(f"{path}/dealt")
    done = [f"{path}/judged/{k}" for k in range(last)]
    for k in range(last):
        _saved(spark, named.filter(F.col("portion") == k), f"{path}/saved/{k}").write.parquet(done[k])
        gc.collect()  # Python's handles of Java's objects are cycles; the list of this portion's files goes with them
    rows = _saved(spark, named.filter(F.col("portion") == last), f"{path}/saved/{last}")
    return spark.read.schema(rows.schema).parquet(*done).union(rows) if last else rows


@query(S + "SELECT concat('https://x.org/', segment) AS url FROM segments_v")
def s5_sitemap(spark, d):
    xml = view(spark, d, "segments_v").groupBy(F.substring("segment", 1, 1)).agg(F.concat_ws("", F.collect_list(F.concat(F.lit("<url><loc>https://x.org/"), "segment", F.lit("</loc></url>")))).alias("value"))
    return sitemap_urls(xml)


@query("SELECT page_id, regexp_extract(url, '^[^?#]*', 0) AS bare, CASE WHEN regexp_matches(url, '/[0-9]+') THEN regexp_extract(url, '/([0-9]+)', 1) END AS id FROM pages")
def c18_c19_page_ids(spark, d):
    return stored(spark, d).select("page_id", text.url_bare(F.col("url")).alias("bare"), F.nullif(F.regexp_extract("url", r"/([0-9]+)", 1), F.lit("")).alias("id"))


@query(P + "SELECT page_id, CAST(page_id AS VARCHAR) AS number FROM pages_v")
def c19_listing_number(spark, d):
    return pages(spark, d).select("page_id", text.listing_number(F.col("url")).alias("number"))


@query(P + "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_extract(html, '\"name\":\"([^\"]*)\"', 1) END AS name FROM pages_v")
def j5_card_and_json_ld(spark, d):
    nodes = extract.json_ld(pages(spark, d).filter("page_id % 2 = 0"), "RealEstateListing").select("page_id", F.get_json_object("node", "$.name").alias("name"))
    return load.with_context(pages(spark, d).select("page_id"), nodes, "page_id", ["name"])


@query("SELECT p_partkey AS page_id, CASE p_partkey % 3 WHEN 0 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) WHEN 1 THEN concat(CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR), '.5') END AS price FROM part")
def c5_keep_fraction(spark, d):
    whole = F.floor("p_retailprice").cast("string")
    raw = F.when(F.col("p_partkey") % 3 == 0, whole).when(F.col("p_partkey") % 3 == 1, F.concat(whole, F.lit(".5"))).otherwise("true")
    v = register(spark, d).table("part").select(F.col("p_partkey").alias("page_id"), F.parse_json(raw).alias("v"))
    return v.select("page_id", text.keep_fraction(F.col("v")).alias("price"))


@query(L + "SELECT listing_id, CAST(listing_id AS BIGINT) % 2 = 0 AS per_m2, CASE CAST(listing_id AS BIGINT) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS exact FROM listings_v")
def c15_price_flags(spark, d):
    k = F.col("listing_id").cast("long")
    card = F.when(k % 2 == 0, "$ 5 por m²").when(k % 5 == 0, F.lit(None)).otherwise("$ 5")
    pin = F.when(k % 3 == 0, "true").when(k % 3 == 1, "false").when(k % 4 == 0, "")
    return listings(spark, d).select("listing_id", text.per_area(card).alias("per_m2"), text.exactness(pin).alias("exact"))


@query(with_views("observations_v") + "SELECT listing_id, count(*) AS n FROM (SELECT DISTINCT listing_id, operation FROM observations_v) GROUP BY listing_id")
def a2_pairs_by_listing(spark, d):
    return load.latest_per_key(view(spark, d, "observations_v"), ["listing_id", "operation"], [F.col("tie1")]).groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"))
