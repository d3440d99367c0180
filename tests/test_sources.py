"""Saved pages, the spatial layout, chains of places, the table function."""

import codecs
import gzip
import glob
import random
from urllib.parse import quote

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plazalake.functions import geo
from plazalake.operators import extract, search
from plazalake.sources import layout
from plazalake.sources.pages import read_pages


def test_saved_pages(spark, tmp_path):
    url = "https://x.org/a b/ñ?q=1&r=%20#top"
    page = '<html><head><meta charset="{}"></head><body>Ñandú €</body></html>'
    good = {
        "plain": page.format("utf-8").encode(), "latin": page.format("windows-1252").encode("cp1252"), "mark": codecs.BOM_UTF8 + page.format("latin-1").encode(),
        "wide": codecs.BOM_UTF16_LE + page.format("x").encode("utf-16-le"), "none": "<p>Ñandú €</p>".encode(),
    }
    packed = gzip.compress(good["plain"])
    bad = {"cut.html.gz": packed[:-9], "latin-as-utf8.html": b"<p>\xd1and\xfa</p>", "odd.html": b'<meta charset="no-such">x', "junk.htm.gz": b"\x1f\x8bjunk"}
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name, content in good.items():
        (tmp_path / "in" / f"{quote(url, safe='')}{name}.html").write_bytes(content)
    (tmp_path / "in" / "deep" / "p%2F1.htm.gz").write_bytes(packed)
    (tmp_path / "in" / "broken%zz.html").write_bytes(b"x")
    (tmp_path / "in" / "ignored.json").write_bytes(b"{}")
    for name, content in bad.items():
        (tmp_path / "in" / name).write_bytes(content)
    found, quarantined = read_pages(spark, str(tmp_path / "in"))
    got = {r["url"]: r["html"] for r in found.collect()}
    want = {url + n: c.decode({"latin": "cp1252", "mark": "utf-8-sig", "wide": "utf-16"}.get(n, "utf-8")) for n, c in good.items()}
    assert got == want | {"p/1": good["plain"].decode(), None: "x"}
    errors = {r["path"].rsplit("/", 1)[1]: r["error"].split(":")[0] for r in quarantined.collect()}
    assert errors == {"cut.html.gz": "gzip", "latin-as-utf8.html": "utf-8", "odd.html": "charset", "junk.htm.gz": "gzip"}
    judged = found.filter("url = 'p/1'").select(extract.verdict(F.col("html"), 10).alias("v")).first()["v"]
    assert judged == "no-coords"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = [(i, 19.4 + rng.gauss(0, 2), -99.1 + rng.gauss(0, 2), 1.0) for i in range(20_000)] + [(50_000 + i, rng.uniform(-90, 90), rng.uniform(-180, 180), 1.0) for i in range(4000)]
    rows += [(60_000 + i, 10.0, 10.0, 1.0) for i in range(9000)] + [(70_000, None, 1.0, 1.0), (70_001, 90.0, 180.0, 1.0), (70_002, -90.0, -180.0, 1.0), (70_003, 0.0, 0.0, 1.0)]
    path = str(tmp_path_factory.mktemp("layout") / "table")
    df = spark.createDataFrame(rows, "listing_id long, lat double, lng double, price double")
    layout.clustered(df, 24).write.parquet(path)
    return df, path


def scanned(df):
    """Rows that the scan gives to the filter above it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text, found = plan.toString(), []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found[0], text


@pytest.mark.parametrize("near,metres", [((19.4, -99.1), 20_000), ((10.0, 10.0), 1_000), ((0.0, 180.0), 900_000), ((89.0, 0.0), 500_000), ((-40.0, 70.0), 2_000_000)])
def test_layout_skips_row_groups(spark, table, near, metres):
    df, path = table
    got = search.search(spark.read.parquet(path), limit=None, near=near, radius_m=metres)
    want = {r["listing_id"] for r in search.search(df, limit=None, near=near, radius_m=metres).collect()}
    assert {r["listing_id"] for r in got.collect()} == want
    ranges = layout.ranges(*near, metres)
    assert len(ranges) <= 32
    touched = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("cell")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            touched += bool(s and s.has_min_max and any(s.min <= b and s.max >= a for a, b in ranges))
    rows, plan = scanned(spark.read.parquet(path).filter(layout.in_ranges(F.col("cell"), ranges)))
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(cell," in plan
    if metres <= 20_000:
        assert touched < total / 2 and rows < df.count() / 2
    if near == (10.0, 10.0):
        assert len(want) == 9000 and touched > 1  # one point, several files


def test_cells(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 1e-9), (0.0, 0.0), (91.0, 0.0)]
    got = [r["c"] for r in spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lng double").orderBy("i").select(layout.cell(F.col("lat"), F.col("lng")).alias("c")).collect()]
    for (lat, lng), code in zip(points, got):
        y, x = min(int((lat + 90) / 180 * 65536), 65535), min(int((lng + 180) / 360 * 65536), 65535)
        ok = (lat, lng) != (0, 0) and abs(lat) <= 90
        assert code == (sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(16)) if ok else None)


def test_ranges_cover_every_radius():
    rng = random.Random(2)
    for _ in range(60):
        lat, lng, metres = rng.uniform(-90, 90), rng.uniform(-180, 180), 10 ** rng.uniform(1, 7)
        found = layout.ranges(lat, lng, metres)
        up, side = geo.reach(lat, metres)
        for _ in range(50):
            a, b = max(-90, min(90, lat + rng.uniform(-up, up))), (lng + rng.uniform(-side, side) + 180) % 360 - 180
            y, x = min(int((a + 90) / 180 * 65536), 65535), min(int((b + 180) / 360 * 65536), 65535)
            code = sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(16))
            assert any(low <= code <= high for low, high in found), (lat, lng, metres, a, b)


def test_chains_of_places(spark):
    chain = [(i, i + 1 if i < 12 else None, "city" if i == 12 else "zone", f"n{i}") for i in range(1, 13)]
    loop = [(20, 21, "zone", "a"), (21, 22, "zone", "b"), (22, 20, "zone", "c"), (30, 30, "zone", "own parent")]
    rest = [(40, 999, "zone", "unknown parent"), (41, None, "city", None), (42, 12, None, "no label"), (43, 44, "city", "near"), (44, None, "city", "far")]
    places = spark.createDataFrame(chain + loop + rest, "id long, parent_id long, label string, name string")
    starts = spark.createDataFrame([(i,) for i in (1, 1, 11, 12, 20, 30, 40, 41, 42, 43, 777)], "id long")
    got = {r["id"]: (r["name"], r["depth"]) for r in extract.ancestors(places, starts, "city").collect()}
    none = (None, None)
    assert got == {1: ("n12", 11), 11: ("n12", 1), 12: ("n12", 0), 20: none, 30: none, 40: none, 41: (None, 0), 42: ("n12", 1), 43: ("near", 0), 777: none}


def test_long_chains_of_places(spark):
    """A chain of more levels than a recursion allows, a city half way up it, and a long way into a loop."""
    deep = spark.range(1, 3001).selectExpr("id", "IF(id < 3000, id + 1, NULL) AS parent_id", "IF(id IN (1500, 3000), 'city', 'zone') AS label", "concat('n', id) AS name")
    loop = spark.range(5000, 5300).selectExpr("id", "IF(id < 5299, id + 1, 5200) AS parent_id", "'zone' AS label", "'l' AS name")
    got = {r["id"]: (r["name"], r["depth"]) for r in extract.ancestors(deep.union(loop), deep.union(loop), "city").collect()}
    assert got == {i: ("n1500", 1500 - i) if i <= 1500 else ("n3000", 3000 - i) for i in range(1, 3001)} | {i: (None, None) for i in range(5000, 5300)}


def test_cards_in_sql(spark):
    extract.register_functions(spark)
    html = '<div class="card" data-id="1"><b class="p">1 &amp; 2</b><div class="card" data-id="2">x<i class="p">3</i></div>'
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>none"), (4, '<div class="other" data-id="9"></div>')], "page_id long, html string")
    found = spark.sql("SELECT page_id, c.position, c.fields FROM {pages}, LATERAL cards(html, :block, 'id, price=p') c", {"block": "card"}, pages=pages).collect()
    assert sorted((r["page_id"], r["position"], r["fields"]) for r in found) == [(1, 0, {"id": "1", "price": "1 & 2"}), (1, 1, {"id": "2", "price": "3"})]
    other = spark.sql("SELECT c.fields['id'] AS id FROM {pages}, LATERAL cards(html, 'other', 'id') c", pages=pages).collect()
    assert [r["id"] for r in other] == ["9"]
