"""Running values over groups that one task must not hold."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plazalake.operators import ordered, runlog, search, shards
from plazalake.plans.audit_queries import log
from plazalake.sources import listings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    """One run with nearly all rows, some of a few rows, one without a name; null levels."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = [(1, i, start + timedelta(seconds=i * 3 + rng.randint(0, 2)), rng.choice(["INFO"] * 6 + ["ERROR", "WARNING", None]), 1.0 * rng.randint(0, 9)) for i in range(3000)]
    rows += [(r, i, start + timedelta(seconds=i), "ERROR", None) for r in (2, 3, None) for i in range(4)]
    rows += [(9, i, start, "ERROR" if i < 70 else "WARNING", 2.0) for i in range(75)]  # one moment, ordered by seq
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "run_id long, seq long, ts timestamp_ntz, level string, amount double").repartition(6)


def plain(lines):
    """All four by walking the rows of each run."""
    runs, streaks, dry, gaps, places = {}, [], [], [], []
    for r in sorted(lines.collect(), key=lambda r: (r["ts"], r["seq"])):
        runs.setdefault(r["run_id"], []).append(r)
    for run, rows in runs.items():
        streak, banked = [], 0.0
        for i, r in enumerate(rows):
            banked += r["amount"] or 0.0
            gaps.append((run, r["seq"], (r["ts"] - rows[i - 1]["ts"]).total_seconds() if i else None))
            places.append((run, r["seq"], i + 1, banked))
            if i >= 39 and not any(x["level"] == "WARNING" for x in rows[i - 39 : i + 1]):
                dry.append((run, r["seq"]))
            if r["level"] is not None and r["level"] != "INFO":
                streak.append(r["seq"])
                continue
            streaks += [(run, len(streak), streak[0])] if len(streak) >= 3 else []
            streak = []
        streaks += [(run, len(streak), streak[0])] if len(streak) >= 3 else []
    return streaks, dry, gaps, places


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("bits", [3, 6, 16])  # stretches of 8 rows, shorter than the memory of 40; of 64; none
def test_any_stretch_equals_a_walk(lines, monkeypatch, bits):
    monkeypatch.setattr(ordered, "STRETCH_BITS", bits)
    streaks, dry, gaps, places = (sorted(x, key=repr) for x in plain(lines))
    assert rows(runlog.bad_streaks(lines, F.col("level") != "INFO"), "run_id", "streak", "first_seq") == streaks
    assert rows(runlog.dry_spells(lines, F.col("level") == "WARNING"), "run_id", "seq") == dry and dry
    assert rows(runlog.gaps(lines), "run_id", "seq", "gap_s") == gaps
    assert rows(runlog.positions(lines, "run_id", F.struct("ts", "seq"), "amount"), "run_id", "seq", "position", "banked") == places


def test_no_task_holds_more_than_a_stretch(spark, lines, monkeypatch):
    monkeypatch.setattr(ordered, "STRETCH_BITS", 6)
    seen, whole = [], ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df: seen.append(whole(df)) or seen[-1])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it puts so few rows together
    try:
        runlog.gaps(lines).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    cut = seen[0].groupBy("run_id", F.shiftright("_at", 6)).count()
    assert cut.agg(F.max("count")).first()[0] <= 64
    assert seen[0].select(F.shiftright("_at", 33)).distinct().count() > 1  # the hot run is sorted over several tasks


def test_empty_log(spark, lines):
    none = lines.limit(0)
    assert runlog.gaps(none).count() == runlog.dry_spells(none, F.col("level") == "x").count() == runlog.bad_streaks(none, F.lit(True)).count() == 0


def test_table_as_one_run(spark, monkeypatch):
    one = log(spark, SF).withColumn("run_id", F.lit(7))
    want = rows(runlog.gaps(one), "seq", "gap_s")
    monkeypatch.setattr(ordered, "STRETCH_BITS", 7)
    assert rows(runlog.gaps(one), "seq", "gap_s") == want


@pytest.mark.parametrize("bits", [2, 16])
def test_contiguous_ranges(spark, monkeypatch, bits):
    monkeypatch.setattr(ordered, "STRETCH_BITS", bits)
    ranges = [(float(i), float(i + 1 + (i % 7 == 3))) for i in range(100) if i % 13] + [(None, 1.0)]
    found = shards.contiguous(spark.createDataFrame(ranges, "lo double, hi double").repartition(5), "lo", "hi")
    want = sorted(ranges, key=lambda r: (r[0] is not None, r[0] or 0.0))
    meets = [(lo, hi, after == hi) for (lo, hi), (after, _) in zip(want, want[1:])] + [(*want[-1], None)]
    assert rows(found, "lo", "hi", "meets_next") == sorted(meets, key=repr)
    assert shards.contiguous(spark.createDataFrame([], "lo double, hi double"), "lo", "hi").count() == 0


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_values_carried_over_levels(spark, monkeypatch, levels):
    monkeypatch.setattr(shards, "STRETCH", 4)
    rng = random.Random(levels)
    given = [(i, rng.choice([None, None, None, i])) for i in range(300)]
    df = spark.createDataFrame(given, "at long, value long").repartition(4)
    last, total, carried, summed = None, 0, [], []
    for at, value in given:
        carried.append((at, last))
        summed.append((at, total))
        last, total = (last if value is None else value), total + (value or 0)
    assert rows(shards.carried(df, "at", "value", "got", levels), "at", "got") == sorted(carried, key=repr)
    assert rows(shards.summed(df, "at", "value", "got", levels), "at", "got") == sorted(summed, key=repr)


def test_exact_delta(spark):
    day = lambda n: datetime(2024, 1, n)
    given = [(0, day(9)), (0, day(5)), (1, None), (1, day(2)), (2, day(8)), (2, day(1)), (3, day(1)), (3, day(3)), (4, day(9))]
    pages = spark.createDataFrame(given, "page long, ts timestamp_ntz")
    assert rows(runlog.delta_pages(pages, "page", "ts", "2024-01-06"), "page", "ts") == sorted(given[:8], key=repr)
    assert rows(runlog.delta_pages(pages, "page", "ts", "2024-01-06", exact=True), "page", "ts") == sorted([(0, day(9)), (2, day(8))], key=repr)
    assert rows(runlog.page_facts(pages, "page", "ts", "2024-01-06"), "page", "n", "old", "exact") == [(0, 2, False, 1), (1, 2, False, 0), (2, 2, False, 1), (3, 2, True, 0), (4, 1, False, 1)]
    assert runlog.delta_pages(pages.limit(0), "page", "ts", "2024-01-06", exact=True).count() == 0


def test_rows_decoded_and_encoded(spark):
    given = spark.createDataFrame([(1, 1.5, 2.5, ["a"]), (2, None, 2.5, []), (3, None, None, None)], "id long, lat double, lng double, photos array<string>")
    out = listings.decoded(given)
    assert rows(out, "id", "coordinates", "photos") == [(1, (1.5, 2.5), ["a"]), (2, None, []), (3, None, [])]
    assert rows(listings.encoded(out), "id", "lat", "lng", "photos") == [(1, 1.5, 2.5, ["a"]), (2, None, None, None), (3, None, None, None)]
    assert rows(listings.decoded(given.drop("photos")), "id", "photos") == [(1, []), (2, []), (3, [])]


def test_sample_is_repeatable(spark):
    df = spark.createDataFrame([(str(i),) for i in range(500)] + [(None,)], "listing_id string")
    one, two = (rows(search.sample(df.repartition(n), 40), "listing_id") for n in (3, 7))
    assert one == two and len(one) == 40 and one != rows(search.sample(df, 40, seed=8), "listing_id")
