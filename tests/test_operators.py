import datetime
import gzip
import json
import random
from math import asin, cos, radians, sin, sqrt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from plazalake.functions import geo, text
from plazalake.operators import extract, geoquality, load, runlog, search, shards
from plazalake.sources import listings as src
from plazalake.streaming import flows


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("given,want", [("Ñandú  m²", "nandu  m2"), ("ØLß ﬁn ½", "l fin 12"), ("", ""), ("İzmir…", "izmir..."), ("Ａ①", "a1"), ("\U0001D400bc", "Abc"), ("🄀x", "0.x")])
def test_search_key(spark, given, want):
    assert one(spark, text.search_key(F.col("a")), a=given) == want


def test_search_key_joins_what_is_set(spark):
    assert one(spark, text.search_key("a", "b", "c"), a="X", b="", c="Y") == "x y"
    assert search.query_key("Obregón m²") == "obregon m2"


@pytest.mark.parametrize("given,want", [("  Álvaro,Obregón ", "alvaro obregon"), ("Ø", "ø"), ("CDMX", "ciudad")])
def test_place_key(spark, given, want):
    assert one(spark, text.place_key(F.col("a"), {"cdmx": "ciudad"}), a=given) == want


@pytest.mark.parametrize("mode,given,want", [("run", "$ 1,250.50 MXN", 1250.5), ("run", "none", None), ("run", "1.2.3", None), ("digits", "a 1 b 2.5", 12.5), ("spaced", "x 1 250", 1.0)])
def test_first_number(spark, mode, given, want):
    assert one(spark, text.first_number(F.col("a"), mode), a=given) == want


def test_price_text(spark):
    assert one(spark, text.price_currency(F.col("a")), a="US$ 5") == "USD"
    assert one(spark, text.price_currency(F.col("a")), a="5") == "MXN" and one(spark, text.price_currency(F.col("a")), a=" ") == ""


def test_times_and_ids(spark):
    assert one(spark, text.utc_time(F.col("a")), a="") is None
    assert str(one(spark, text.utc_time(F.col("a")).cast("string"), a="2024-05-01T10:00:00-06:00")) == "2024-05-01 16:00:00"
    assert one(spark, text.uuid7_millis(F.col("a")), a="01910000-0000-7abc-8def-0123456789ab") == 0x019100000000
    assert one(spark, text.uuid7_millis(F.col("a")), a="01910000-0000-4abc-8def-0123456789ab") is None
    assert one(spark, text.listing_number(F.col("a")), a="x/MLM-77-y") == "77"
    assert one(spark, text.phone(F.col("a"), "s", clear=True), a="+52 (55) 1234-5678") == "+525512345678"


def test_points(spark):
    ok = lambda a, b: one(spark, geo.point_ok(F.lit(a).cast("double"), F.lit(b).cast("double")))
    assert ok(90.0, -180.0) and ok(0.0, 1.0) and not ok(0.0, 0.0) and not ok(90.1, 0.0) and not ok(None, 1.0)


ROWS = [Row(listing_id=str(i), source="s", price=float(i % 7), observed_at=i, lat=None if i % 2 else 1.0, lng=None if i % 2 else 2.0) for i in range(20)]


def test_upsert_is_idempotent(spark):
    base, new = spark.createDataFrame(ROWS[:12]), spark.createDataFrame([r for r in ROWS if int(r.listing_id) >= 6])
    once = load.upsert(base, new, keep_if_null=["lat", "lng"])
    twice = load.upsert(once, new, keep_if_null=["lat", "lng"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr) and once.count() == 20


def test_latest_does_not_depend_on_order(spark):
    rows = [(i % 5, i, i * 7 % 11) for i in range(60)]
    first = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = sorted(map(tuple, load.latest_per_key(spark.createDataFrame(rows, "k int, i int, t int"), ["k"], [F.col("t").desc(), F.col("i")]).collect()))
        first = first or got
        assert got == first


def test_shards_cover_once(spark):
    rng = random.Random(1)
    prices = [rng.choice([1.0, 2.0, 5.0, None]) if rng.random() < 0.3 else rng.random() * 1000 for _ in range(700)]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = sorted(map(tuple, shards.price_shards(df, "price", 50).select("lo", "hi", "n").collect()))
    priced = [p for p in prices if p is not None]
    assert sum(n for _, _, n in got) == len(priced)
    assert all(sum(lo <= p <= hi for p in priced) == n for lo, hi, n in got)


def test_radius_join_equals_brute_force(spark):
    rng = random.Random(3)
    a = [(str(i), rng.uniform(18, 21), rng.uniform(-101, -98)) for i in range(300)]
    b = [(i, rng.uniform(18, 21), rng.uniform(-101, -98)) for i in range(20)]

    def metres(p, q):
        h = sin(radians(q[1] - p[1]) / 2) ** 2 + cos(radians(p[1])) * cos(radians(q[1])) * sin(radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371008.8 * asin(sqrt(h))

    joined = geoquality.radius_join(spark.createDataFrame(a, "listing_id string, lat double, lng double"), spark.createDataFrame(b, "query_id int, q_lat double, q_lng double"), 30_000)
    assert {(r["listing_id"], r["query_id"]) for r in joined.collect()} == {(p[0], q[0]) for p in a for q in b if metres(p, q) <= 30_000}
    plan = joined._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_search_reaches_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = spark.createDataFrame([("s", "1", "rent", 5.0, 19.0, -99.0, "x")], "source string, listing_id string, operation string, price double, lat double, lng double, norm string")
    src.append(df, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = search.search(stored, operation="rent", max_price=10, sources=["s"], near=(19.0, -99.0), radius_m=100)._jdf.queryExecution().toString()
    pushed = plan.rsplit("PushedFilters", 1)[1]
    assert all(x in pushed for x in ("EqualTo(operation,rent)", "LessThanOrEqual(price,10", "GreaterThanOrEqual(lat,"))
    assert "source" in plan.rsplit("PartitionFilters", 1)[1].split("]")[0] and "TakeOrderedAndProject" in plan


def test_tolerant_scan(spark, tmp_path):
    good = {"listingId": 7, "url": "u", "title": "Casa ñ", "price": 10.5, "agentPhone": "55 1234 5678 90", "coordinates": {"lat": 0, "lng": 0}, "listedAt": "", "observedAt": "2024-01-02T00:00:00Z"}
    lines = [json.dumps(good), "{broken", json.dumps({"url": "u"}), json.dumps({"listingId": None, "url": "u"}), json.dumps({"listingId": "8"})]
    (tmp_path / "alpha.jsonl").write_text("\n".join(lines))
    (tmp_path / "beta.2024.jsonl").write_text(json.dumps({"listingId": "9", "url": "v", "coordinates": {"lat": 19.5, "lng": -99.1}}))
    paths = [str(tmp_path / "alpha.jsonl"), str(tmp_path / "beta.2024.jsonl")]
    ok, rejected = src.read_listings(spark, paths)
    table = {r["listing_id"]: r for r in src.to_table(ok, "salt").collect()}
    assert set(table) == {"7", "9"} and rejected.count() == 4
    assert table["7"]["source"] == "alpha" and table["9"]["source"] == "beta"
    assert table["7"]["lat"] is None and table["9"]["lat"] == 19.5 and table["7"]["listed_at"] is None and table["7"]["norm"] == "casa n"
    assert len(table["7"]["agent_phone"]) == 64
    only, _ = src.read_listings(spark, paths, ["beta"])
    assert only.count() == 1


def test_sinks(spark, tmp_path):
    src.create_empty(spark, str(tmp_path / "empty"))
    df = spark.createDataFrame(ROWS[:3])
    src.append(df, str(tmp_path / "a"))
    src.append(df, str(tmp_path / "a"))
    src.overwrite(df, str(tmp_path / "o"))
    src.overwrite(df, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6 and spark.read.parquet(str(tmp_path / "o")).count() == 3
    with gzip.open(tmp_path / "m.xml.gz", "wt") as f:
        f.write("<urlset><url><loc>https://x/1</loc></url><url><loc>https://x/2</loc></url></urlset>")
    assert {r["url"] for r in src.read_sitemaps(spark, str(tmp_path / "m.xml.gz")).collect()} == {"https://x/1", "https://x/2"}


def test_cards(spark):
    html = '<div class="card" data-id="1"><span class="price">$ 5</span><b>no</b><div class="card"><p class="price"><b>$</b>\xa07</p>'
    got = [tuple(r) for r in extract.cards(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"), "card", {"id": "", "price": "price"}).collect()]
    assert got == [(1, 0, "1", "$ 5"), (1, 1, None, "$ 7")]


def test_json_ld_shapes(spark):
    wrap = lambda s: f'<script type="application/ld+json">{s}</script>'
    html = wrap("{bad") + wrap('[{"@type":["A","B"],"n":1},{"@type":"C"}]') + wrap('{"@type":"A","n":2}') + wrap('{"@graph":[{"@type":"A","n":3}]}')
    got = extract.json_ld(spark.createDataFrame([(1, html)], "page_id long, html string"), "A")
    assert sorted(json.loads(r["node"])["n"] for r in got.collect()) == [1, 2, 3]


def test_health_codes(spark):
    t = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    rows = [(1, 1, t(0), "run start"), (1, 2, t(5), "page"), (2, 1, t(0), "aborted x"), (2, 2, t(1), "run start"), (3, 1, t(1), "aborted y"), *[(4, i, t(i), "token minted") for i in range(5)]]
    log = spark.createDataFrame(rows, "run_id long, seq long, ts timestamp_ntz, msg string").withColumn("level", F.lit("WARNING"))
    code = lambda **k: {r["run_id"]: r["code"] for r in runlog.health(log, "2024-01-01 00:01:00", **k).collect()}
    assert code() == {1: 0, 2: 0, 3: 1, 4: 1}
    assert code(stall_s=10) == {1: 1, 2: 1, 3: 1, 4: 1} and code(running=False, work_left=True)[1] == 1


def test_streams_equal_batch(spark, tmp_path):
    rows = [(i % 9, f"2024-01-01 00:{i:02d}:00", i % 4 == 0) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, t string, ok boolean").select("k", F.to_timestamp("t").alias("ts"), "ok").withColumn("run_id", F.lit(1).cast("long")).withColumn("seq", F.minute("ts").cast("long"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    flows.append_available(flows.deduplicated(stream, ["k"], "ts"), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
    flows.append_available(flows.deduplicated(stream, ["k"], "ts"), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
    rate = flows.event_rate(df, "ts").agg(F.sum("n")).first()[0]
    assert rate == 300 and flows.sessions(df, "ts", "61 seconds").count() == 1 and flows.since(df, "ts", "2024-01-01 00:10:00").count() == 20


def test_keyset_windows_equal_a_walk(spark):
    rng = random.Random(8)
    prices = sorted(float(rng.choice([5, 5, 5, 7, 9, rng.randint(1, 400)])) for _ in range(900))
    got = sorted(map(tuple, shards.keyset_windows(spark.createDataFrame([(p,) for p in prices], "price double"), "price", 10, 3).select("price", "first_row", "n_rows", "again").collect()), key=lambda r: r[1])
    want, at, end = [], 0, 0
    while at < len(prices):
        n = min(30, len(prices) - at)
        want.append((prices[at], at, n, max(end - at, 0)))
        end = at + n
        if end == len(prices):
            break
        back = prices.index(prices[end - 1])
        at = back if back > at else at + prices.count(prices[at])
    assert got == want
    assert shards.keyset_windows(spark.createDataFrame([], "price double"), "price", 10, 3).count() == 0


@pytest.mark.parametrize("page,want", [
    ('{"latitude":21.84,"longitude":-102.32}', "ok"), ('"latitude":21.84,"longitude":-102.32 <p>Log in<br/>to continue', "ok"), ("<p>Log in<br/>to continue", "login"),
    ("Verify you are <b>human</b>", "pow"), ("<html>odd</html>", "unknown"), ("<html>" + "x" * 300, "no-coords"), ("Log in to continue" + "x" * 300, "login"),
])
def test_verdict_order(spark, page, want):
    assert one(spark, extract.verdict(F.col("a"), 300, ("inicia sesión", "log in to continue"), (), ("verify you are human",)), a=page) == want


def test_range_counts_priced_pesos_only(spark):
    rows = [("a", "MXN", 9.0)] * 3 + [("a", "USD", 9.0)] * 20 + [("b", "MXN", 9.0)] * 2 + [("b", "MXN", 0.0)] * 9 + [("c", "MXN", 9.0)] * 3 + [("c", "MXN", 50.0)] * 9 + [("d", "USD", 1.0)]
    from plazalake.operators import audit

    got = audit.range_applied(spark.createDataFrame(rows, "g string, currency string, price double"), "g", 10, 100).collect()
    assert {r["g"]: r["applied"] for r in got} == {"a": False, "b": True, "c": True, "d": True}


@pytest.mark.parametrize("given,want", [("Casa  EN  venta en Roma", "Casa"), (" Casa en renta", "Casa"), ("Casa", "Casa")])
def test_subtitle_kind(spark, given, want):
    assert one(spark, extract.subtitle(F.col("a"))["kind"], a=given) == want


@pytest.mark.parametrize("given,want", [
    ('{"a":{"l":[{"postingId":1}]},"b":{"l":[{"postingId":2}]}}', 2), ('{"x":[{"postingId":3}],"y":{"l":[{"postingId":4}]}}', 3), ('[[{"postingId":5}]]', None), ("[" * 5000, None), ("{", None),
])
def test_postings_depth_first(spark, given, want):
    got = extract.find_postings(spark.createDataFrame([(1, given)], "page_id long, blob string")).first()["postings"]
    assert (json.loads(got)[0]["postingId"] if got else None) == want


def test_radius_over_the_date_line_and_poles(spark):
    points = [(85.0, 179.99), (0.0, -179.999), (86.0, 10.0), (89.9, 0.0), (-89.95, 90.0), (19.0, -99.0), (0.0, 180.0), (-90.0, 0.0)]
    queries = [(85.0, -179.99), (0.0, 179.999), (86.0, 20.0), (89.9, 180.0), (-89.95, -90.0), (19.2, -99.3), (60.0, 5.0)]
    left = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points)], "listing_id string, lat double, lng double")
    right = spark.createDataFrame([(i, *q) for i, q in enumerate(queries)], "query_id int, q_lat double, q_lng double")

    def metres(a, b):
        h = sin(radians(b[0] - a[0]) / 2) ** 2 + cos(radians(a[0])) * cos(radians(b[0])) * sin(radians(b[1] - a[1]) / 2) ** 2
        return 2 * geo.EARTH_M * asin(sqrt(min(h, 1)))

    for radius in (5_000, 90_000, 3_000_000):
        want = sorted((i, str(j)) for i, q in enumerate(queries) for j, p in enumerate(points) if metres(p, q) <= radius)
        assert sorted((r["query_id"], r["listing_id"]) for r in geoquality.radius_join(left, right, radius).collect()) == want
        for i, q in enumerate(queries):
            assert sorted(r["listing_id"] for r in left.filter(geo.within(F.col("lat"), F.col("lng"), *q, radius)).collect()) == [j for k, j in want if k == i]


def test_suspect_points_are_left_out(spark):
    rows = spark.createDataFrame([("s", "1", None, None)], "source string, listing_id string, lat double, lng double")
    points = spark.createDataFrame([("s", "1", 1.0, 2.0, ["repe"])], "source string, listing_id string, lat double, lng double, suspect array<string>")
    assert load.patch_points(rows, points, exclude_suspect=True).first()["lat"] is None and load.patch_points(rows, points).first()["lat"] == 1.0


def test_missing_files_are_named(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"listingId":"1","url":"u"}\n')
    with pytest.raises(FileNotFoundError, match="b.jsonl, .*c.jsonl"):
        src.read_listings(spark, [str(tmp_path / f) for f in ("a.jsonl", "b.jsonl", "c.jsonl")])


def test_stream_queries_stand_alone():
    """Each in a session in which no stream ran before."""
    import os
    import subprocess
    import sys

    code = (
        "import sys, __spark_entry__ as e\nfrom pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', e.queries()[sys.argv[1]](s, '/root/testdata/sf0.001').count(), s.conf.get('spark.sql.streaming.stateStore.providerClass').count('RocksDB'))"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("r6_breaker", "r5_stalled"):
        said = subprocess.run([sys.executable, "-c", code, name], capture_output=True, text=True, cwd=root, timeout=300, env=os.environ | {"PYTHONPATH": root})
        assert "ROWS " in said.stdout and said.stdout.split("ROWS ")[1].split()[0] != "0", said.stderr[-2000:]
        assert said.stdout.split("ROWS ")[1].split()[1] == "0"


def test_keyset_windows_over_short_stretches(spark, monkeypatch):
    import __spark_entry__ as entry
    from tests.compare import connect, differences

    monkeypatch.setattr(shards, "STRETCH", 2)
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), sf, entry.queries()["p5_keyset_windows"], entry.oracle_sql()["p5_keyset_windows"]) is None


def test_times_do_not_take_the_zone_of_the_session(spark):
    given = ["2024-01-01T00:00:00", "2024-01-01", "2024-01-01 00:00:00.5", "2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "", "soon", None]
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Mexico_City", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r["s"] for r in df.orderBy("i").select(F.unix_millis(text.utc_time(F.col("t"))).alias("s")).collect()]
            assert got == [1704067200000, 1704067200000, 1704067200500, 1704067200000, 1704067200000, None, None, None], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_identity_of_nulls_and_joined_names(spark):
    from plazalake.operators import audit

    df = spark.createDataFrame([("x|sale", None), ("x", "sale"), ("x", "sale"), ("x", None)], "k string, o string")
    assert tuple(audit.identity_counts(df, "k", "o").first()) == (4, 2, 3, 1, 1)


def test_health_rules(spark):
    t = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    rows = [(1, 1, t(0), "ERROR", "query aborted"), (2, 1, t(0), "WARNING", "query aborted"), (3, 1, t(0), "WARNING", "aborted"), (3, 2, t(1), "INFO", "run start again"), (4, 1, t(0), "INFO", "no run start")]
    rows += [(5, i, t(i), "INFO", f"a token minted {i}") for i in range(4)]
    log = spark.createDataFrame(rows, "run_id long, seq long, ts timestamp_ntz, level string, msg string")
    assert {r["run_id"]: r["code"] for r in runlog.health(log, "2024-01-01 00:01:00").collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1}
    pages = spark.createDataFrame([(1, i, t(i), "INFO", m) for i, m in enumerate(["a page 1", "page 2", "token", "a page 3"])], "run_id long, seq long, ts timestamp_ntz, level string, msg string")
    rate = runlog.recent_rate(pages).first()
    assert (rate["n"], rate["seconds"], rate["per_hour"]) == (2, 3.0, 1200.0)


def test_suspects_by_names_of_one_place(spark):
    near = [("d", str(i), "Cancún", "Q. Roo", 21.0, -86.0) for i in range(5)] + [("d", "9", "", "Q. Roo", 50.0, 50.0)] * 6
    rows = [("m", "1", "CANCÚN ", "quintana roo", 21.1, -86.0), ("m", "2", "cancun,", "Q.  Roo", 21.1, -86.0), ("m", "3", "Cancun", "Q. Roo", 25.0, -86.0), ("m", "4", None, "Q. Roo", 25.0, -86.0), ("m", "5", "Cancun", "Yucatán", 21.1, -86.0)]
    schema = "source string, listing_id string, city string, province string, lat double, lng double"
    df, donors = spark.createDataFrame(rows, schema), spark.createDataFrame(near, schema)
    flags = lambda **k: {r["listing_id"]: r["suspect"] for r in geoquality.suspect_flags(df, **k).collect()}
    assert flags(donors=donors, aliases={"quintana roo": "q. roo"}) == {"1": ["repe"], "2": ["repe"], "3": ["lejos"], "4": ["sin-centroide"], "5": ["repe"]}
    assert flags(donors=donors.limit(0))["3"] == ["sin-centroide"]
    same = df.filter("listing_id IN ('1', '2')")
    assert [r["suspect"] for r in geoquality.suspect_flags(same, donors=donors, aliases={"quintana roo": "q. roo"}).collect()] == [[], []]


@pytest.mark.parametrize("tag", ['<script id="b">', "<script type=module id='b' async>", "<SCRIPT data-id='x' id = b>", '<script\nnonce="1"\nid="b">'])
def test_script_by_id(spark, tag):
    html = f'<script data-id="b">{{"a":0}}</script><script id="bb">{{"a":9}}</script>{tag}x = {{"a":1}}; y</script>'
    assert one(spark, extract.script_json(F.col("a"), "b").cast("string"), a=html) == '{"a":1}'


@pytest.mark.parametrize("page,want", [("Ingresa a<br/>tu  cuenta", "login"), ("<a k='_bmc'>", "pow"), ("bot_challenge <p>ingresa a tu cuenta", "login"), ("log in to continue", "unknown"), ("x" * 300, "no-coords")])
def test_verdict_by_fixed_signs(spark, page, want):
    assert one(spark, extract.verdict(F.col("a"), 300), a=page) == want


def test_postings_far_below(spark):
    deep = '{"a":' * 900 + '{"l":[{"postingId":7}]}' + "}" * 900
    got = extract.find_postings(spark.createDataFrame([(1, deep)], "page_id long, blob string")).first()["postings"]
    assert json.loads(got) == [{"postingId": 7}]


def test_places_are_resolved_once(spark):
    """Rows meet the resolved places in one join, also by null names; flags make the keys of spellings, not of rows."""
    df = spark.createDataFrame([(str(i), "s", c, p, 19.0 + i / 1e5, -99.0) for i, (c, p) in enumerate([("A", "P"), ("a", "P"), ("\u00c1", "p,")] * 5 + [("A", None), (None, "P"), (None, None), ("A/x", "Q")])], "listing_id string, source string, city string, province string, lat double, lng double")
    points = spark.createDataFrame([("A", "P", 1.0, 2.0)], "city string, province string, lat double, lng double")
    found = geoquality.resolve_cities(df, points, points.drop("province"))
    stages = {(r["city"], r["province"]): r["stage"] for r in found.collect()}
    assert found.count() == df.count() and stages == {("A", "P"): 1, ("a", "P"): 0, ("\u00c1", "p,"): 0, ("A", None): 2, (None, "P"): 0, (None, None): 0, ("A/x", "Q"): 3}
    joins = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(found) == 1
    flags = geoquality.suspect_flags(df)
    assert "translate" not in flags._jdf.queryExecution().optimizedPlan().toString()
    assert {r["listing_id"]: r["suspect"] for r in flags.collect()} == {str(i): ["sin-centroide"] if i in (16, 17) else [] for i in range(19)}
