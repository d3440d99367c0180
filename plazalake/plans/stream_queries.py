"""Incremental flows run as streams over the stored events until all have been read."""

from __future__ import annotations

from pyspark.sql import functions as F

from plazalake.plans.registry import query
from plazalake.sources.scratch import new_path
from plazalake.sources.versions import VersionedTable
from plazalake.streaming import flows


def events(spark, d):
    """The events table as a stream of files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{d}/events*.parquet")


def in_files(spark, d, n):
    """The events dealt over ``n`` files, of which a micro-batch reads one."""
    given, path = spark.read.parquet(f"{d}/events.parquet"), new_path(spark)
    given.repartition(n).write.parquet(path)
    return spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("SELECT DISTINCT user_id, event_type FROM events")
def r1_r2_incremental_dedup(spark, d):
    out, mark = new_path(spark), new_path(spark)
    fresh = flows.deduplicated(events(spark, d).select("user_id", "event_type"), ["user_id", "event_type"])
    for _ in range(2):  # the second run goes on from the checkpoint and finds nothing new
        flows.append_available(fresh, out, mark).awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(out)


@query("WITH n AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1), b AS (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 0 UNION SELECT -1) SELECT coalesce(n.user_id, b.user_id) AS user_id, n.event_id, coalesce(n.value, -1.0) AS value FROM b FULL JOIN n ON n.user_id = b.user_id")
def r7_stream_upsert(spark, d):
    table = VersionedTable(spark, new_path(spark), "part")
    part = (F.col("user_id") % 4).alias("part")
    stored = spark.read.parquet(f"{d}/events.parquet").filter("user_id % 2 = 0").select("user_id").union(spark.sql("SELECT -1L")).distinct()
    table.replace(stored.select("user_id", part, F.lit(None).cast("long").alias("event_id"), F.lit(-1.0).alias("value"), F.lit(None).cast("struct<ts:timestamp_ntz,event_id:long>").alias("at")))
    stream = in_files(spark, d, 3).select("user_id", part, "event_id", "value", F.struct("ts", "event_id").alias("at"))
    mark = new_path(spark)
    writer = lambda: flows.upsert_versions(stream, table, ["part", "user_id"], ["at"], mark, keep_if_null=["value"], newest="at")
    flows.first_batch(writer())  # the second run goes on in mid-input
    writer().trigger(availableNow=True).start().awaitTermination()
    return table.read().select("user_id", "event_id", "value")


@query("SELECT DISTINCT user_id, event_type FROM events")
def r2_resumed_in_mid_input(spark, d):
    out, mark = new_path(spark), new_path(spark)
    fresh = flows.deduplicated(in_files(spark, d, 4).select("user_id", "event_type"), ["user_id", "event_type"])
    writer = fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
    flows.first_batch(writer)
    flows.append_available(fresh, out, mark).awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(out)


@query("SELECT event_id, ts > (SELECT max(ts) FROM events) - INTERVAL 2 DAY AS held FROM events")
def r1_bounded_state(spark, d):
    """Every event comes twice, in slices of ascending time; each run goes on from the checkpoint. The memory
    of keys ends a day behind the watermark, which is a day behind the newest event."""
    given, arrived, out, mark = spark.read.parquet(f"{d}/events.parquet"), new_path(spark), new_path(spark), new_path(spark)
    twice = given.unionByName(given).select("event_id", F.col("ts").cast("timestamp").alias("at"))
    bounds = twice.agg(F.min("at").alias("a"), F.max("at").alias("b"), ((F.unix_micros(F.max("at")) - F.unix_micros(F.min("at"))) / 3 + 1).cast("long").alias("w")).first()
    slot = F.floor((F.unix_micros("at") - F.unix_micros(F.lit(bounds["a"]))) / bounds["w"])
    for i in range(3):
        twice.filter(slot == i).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema("event_id long, at timestamp").parquet(arrived)
        fresh = flows.deduplicated(stream, ["event_id"], "at", "1 day")
        flows.append_available(fresh, out, mark).awaitTermination()
    held = flows.state_rows(spark, mark).select("key.event_id", F.lit(True).alias("held"))
    return spark.read.schema("event_id long").parquet(out).join(held, "event_id", "left").select("event_id", F.coalesce("held", F.lit(False)).alias("held"))


@query("SELECT run_id, seq, streak, streak >= 3 OR (good = 0 AND n = 40) AS open FROM (SELECT user_id AS run_id, event_id AS seq, CASE WHEN event_type = 'error' THEN CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) - CASE WHEN island = 0 THEN 0 ELSE 1 END AS INT) ELSE 0 END AS streak, good, n FROM (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER w AS good, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 39 PRECEDING AND CURRENT ROW)))")
def r6_breaker(spark, d):
    results = events(spark, d).select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"))
    out = new_path(spark)
    with flows.state_in_rocksdb(spark):
        flows.append_available(flows.breaker(results), out, new_path(spark)).awaitTermination()
    return spark.read.schema("run_id long, seq long, streak int, open boolean").parquet(out)


@query("WITH m AS (SELECT max(ts) AS now FROM events), l AS (SELECT user_id AS run_id, max(ts) AS last FROM events GROUP BY 1) SELECT run_id, epoch_us(last) // 1000 AS last_ms FROM l, m WHERE last + INTERVAL 600 SECOND <= now - INTERVAL 60 SECOND")
def r5_stalled(spark, d):
    log = events(spark, d).select(F.col("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"))
    out = new_path(spark)
    with flows.state_in_rocksdb(spark):
        flows.append_available(flows.stalled(log, "ts"), out, new_path(spark)).awaitTermination()
    return spark.read.schema("run_id long, last_ms long").parquet(out)

