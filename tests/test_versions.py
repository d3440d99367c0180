"""The versioned table and the streams that write to it: deaths, replays and restarts change nothing."""

import time

import pytest
from pyspark.sql import functions as F

from plazalake.sources.versions import Conflict, VersionedTable
from plazalake.streaming import flows

SCHEMA = "source string, listing_id long, price double"
KEYS = ["source", "listing_id"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "table"), "source")
    made.replace(spark.createDataFrame([("a b/c", 1, 1.0), ("x", 2, 2.0), ("x", 3, 3.0), (None, 4, 4.0)], SCHEMA))
    return made


def test_only_touched_partitions_are_written(spark, table):
    before = table.version()
    new = spark.createDataFrame([("x", 2, None), ("x", 9, 9.0), (None, 4, 5.0), ("new", 7, 7.0)], SCHEMA)
    after = table.upsert(new, KEYS, keep_if_null=["price"])
    assert rows(table.read()) == sorted([("a b/c", 1, 1.0), ("x", 2, 2.0), ("x", 3, 3.0), ("x", 9, 9.0), (None, 4, 5.0), ("new", 7, 7.0)], key=repr)
    moved = {n for n, c in after.partitions.items() if before.partitions.get(n) != c}
    assert moved == {"source=x", "source=__HIVE_DEFAULT_PARTITION__", "source=new"}
    assert rows(table.read(0)) == sorted([("a b/c", 1, 1.0), ("x", 2, 2.0), ("x", 3, 3.0), (None, 4, 4.0)], key=repr)
    plan = table.read().filter("source = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_death_between_write_and_switch(spark, table, monkeypatch):
    new = spark.createDataFrame([("x", 2, 8.0)], SCHEMA)
    before = rows(table.read())

    def die(self, version):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_switch", die)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(new, KEYS, stream="s", epoch=0)
    assert rows(table.read()) == before and table.numbers() == [0]
    again = VersionedTable(spark, table.root, "source")  # another process
    again.upsert(new, KEYS, stream="s", epoch=0)
    want = sorted([("a b/c", 1, 1.0), ("x", 2, 8.0), ("x", 3, 3.0), (None, 4, 4.0)], key=repr)
    assert rows(again.read()) == want
    assert len(again.vacuum()) == 1 and again.vacuum() == [] and rows(again.read()) == want
    assert len(again.vacuum(keep=1)) == 0 and again.numbers() == [1] and rows(again.read()) == want  # version 0 is still named by version 1


def test_replays_and_rivals(spark, table):
    new = spark.createDataFrame([("x", 2, 8.0)], SCHEMA)
    made = table.upsert(new, KEYS, stream="s", epoch=5)
    assert table.upsert(spark.createDataFrame([("x", 2, 0.0)], SCHEMA), KEYS, stream="s", epoch=5) == made
    assert table.upsert(new, KEYS, stream="t", epoch=0).number == made.number + 1  # another stream counts by itself
    rival = VersionedTable(spark, table.root, "source")
    with pytest.raises(Conflict):
        rival.replace(new, base=made)
    assert table.numbers() == [0, 1, 2] and rows(table.read().filter("source = 'x'")) == [("x", 2, 8.0), ("x", 3, 3.0)]
    with pytest.raises(ValueError):
        table.upsert(new, ["listing_id"])


def test_empty_commits(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "source")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(spark.createDataFrame([], SCHEMA), KEYS)
    assert table.read().count() == 0 and table.read().columns == ["source", "listing_id", "price"]
    table.upsert(spark.createDataFrame([("a", 1, 1.0)], SCHEMA), KEYS)
    table.replace(spark.createDataFrame([], SCHEMA), touched=["source=a"])
    assert table.read().count() == 0


def arrive(spark, path, batch):
    spark.createDataFrame(batch, SCHEMA + ", at long").coalesce(1).write.mode("append").parquet(path)


def test_stream_dies_after_the_commit_of_the_table(spark, tmp_path, monkeypatch):
    """The checkpoint lacks the batch that the table has: the batch runs again and commits nothing."""
    arrived, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    table = VersionedTable(spark, str(tmp_path / "t"), "source")
    for batch in ([("a", 1, 1.0, 1), ("b", 1, 1.0, 1)], [("a", 1, 2.0, 2)], [("c", 5, 5.0, 3), ("a", 1, 0.5, 0)]):
        arrive(spark, arrived, batch)
    stream = spark.readStream.schema(SCHEMA + ", at long").option("maxFilesPerTrigger", 1).parquet(arrived)
    writer = lambda: flows.upsert_versions(stream, table, KEYS, ["at"], mark, newest="at")
    whole, done = VersionedTable._switch, []

    def die_once(self, version):
        whole(self, version)
        done.append(version.number)
        if len(done) == 2:
            raise RuntimeError("executor of the driver lost")

    monkeypatch.setattr(VersionedTable, "_switch", die_once)
    with pytest.raises(Exception, match="lost"):
        writer().trigger(availableNow=True).start().awaitTermination()
    assert table.version().epochs == {mark: 1}
    writer().trigger(availableNow=True).start().awaitTermination()
    assert table.numbers() == [0, 1, 2] and table.version().epochs == {mark: 2}
    assert rows(table.read().select("source", "listing_id", "price")) == [("a", 1, 2.0), ("b", 1, 1.0), ("c", 5, 5.0)]


def test_stream_stops_after_the_first_batch_and_goes_on(spark, tmp_path):
    arrived, mark, out = (str(tmp_path / n) for n in ("in", "mark", "out"))
    for i in range(4):
        arrive(spark, arrived, [("a", i, 1.0, i), ("a", 0, 1.0, i)])
    stream = spark.readStream.schema(SCHEMA + ", at long").option("maxFilesPerTrigger", 1).parquet(arrived)
    fresh = flows.deduplicated(stream.select("source", "listing_id"), ["source", "listing_id"])
    query = flows.first_batch(fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark))
    assert query.lastProgress["batchId"] == 0 and 0 < spark.read.parquet(out).count() < 4
    flows.append_available(fresh, out, mark).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a", i) for i in range(4)]
    assert flows.state_rows(spark, mark).count() == 4


def test_state_of_a_watermark_shrinks(spark, tmp_path):
    arrived, mark, out = (str(tmp_path / n) for n in ("in", "mark", "out"))
    held = []
    for day in range(1, 8):
        batch = spark.range(100).select((F.col("id") + day * 1000).alias("event_id"), F.expr(f"timestamp'2024-01-0{day} 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("at"))
        batch.unionByName(batch).coalesce(1).write.mode("append").parquet(arrived)
        fresh = flows.deduplicated(spark.readStream.schema("event_id long, at timestamp").parquet(arrived), ["event_id"], "at", "1 day")
        flows.append_available(fresh, out, mark).awaitTermination()
        held.append(flows.state_rows(spark, mark).count())
    assert spark.read.parquet(out).count() == 700
    assert max(held) <= 200 and held[-1] < 700  # the last two days, whatever has been read


def test_state_of_ended_runs_goes(spark, tmp_path, request):
    """A list of the last 40 results for each run; after its time to live it is gone, the others stay."""
    arrived, mark, out = (str(tmp_path / n) for n in ("in", "mark", "out"))
    schema = "run_id long, seq long, ok boolean"

    def drain(batch, live_ms):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(arrived)
        with flows.state_in_rocksdb(spark):
            flows.append_available(flows.breaker(spark.readStream.schema(schema).parquet(arrived), live_ms), out, mark).awaitTermination()
            held = flows.state_rows(spark, mark, variable="recent").groupBy("key.run_id").count().collect()
        return {r["run_id"]: r["count"] for r in held}

    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(setting, "false")
    request.addfinalizer(lambda: spark.conf.unset(setting))
    assert drain([(1, i, False) for i in range(50)] + [(2, i, True) for i in range(5)], 4000) == {1: 40, 2: 5}
    time.sleep(4.5)
    assert drain([(3, 0, True)], 4000) == {3: 1}
    found = {(r["run_id"], r["seq"]): (r["streak"], r["open"]) for r in spark.read.parquet(out).collect()}
    assert found[1, 1] == (2, False) and found[1, 2] == (3, True) and found[1, 49] == (50, True) and found[2, 4] == (0, False) and len(found) == 56


def test_stalled_runs_end_and_can_stall_again(spark, tmp_path):
    arrived, mark, out = (str(tmp_path / n) for n in ("in", "mark", "out"))
    schema = "run_id long, ts timestamp"
    held = []
    for batch in ([(1, 0), (1, 100), (2, 0)], [(2, 900)], [(2, 2000), (1, 50)], [(1, 2100)], [(2, 9000)]):
        spark.createDataFrame(batch, "run_id long, s long").select("run_id", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(arrived)
        with flows.state_in_rocksdb(spark):
            flows.append_available(flows.stalled(spark.readStream.schema(schema).parquet(arrived), "ts"), out, mark).awaitTermination()
            held.append(flows.state_rows(spark, mark, variable="last").count())
    # run 1 is silent after 100 s, its late row of 50 s counts no more, it comes back at 2100 s and falls silent
    # again; rows of run 2 come before the watermark shows a gap
    assert rows(spark.read.parquet(out)) == [(1, 100_000), (1, 2_100_000)]
    assert held[-1] == 1
