"""Run logs: rates, gaps, streaks, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.operators.ordered import running


def parse_log(lines: DataFrame) -> DataFrame:
    """(ts, level, msg) of lines ``YYYY-MM-DD HH:MM:SS LEVEL  message``; other lines are dropped."""
    line = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\s+([A-Z]+)\s+(.*)$"
    part = lambda i: F.regexp_extract("value", line, i)
    return lines.filter(F.col("value").rlike(line)).select(F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("ts"), part(2).alias("level"), part(3).alias("msg"))


def since_last_start(log: DataFrame, marker: str = "run start") -> DataFrame:
    """Rows of each run from its last message that begins with the marker on; runs without one are whole."""
    start = F.max(F.when(F.startswith("msg", F.lit(marker)), F.col("seq")))
    starts = log.groupBy("run_id").agg(start.alias("_from"))
    return log.join(starts, "run_id").filter(F.col("_from").isNull() | (F.col("seq") >= F.col("_from"))).drop("_from")


def recent_rate(log: DataFrame, rows: int = 200, progress: str | None = " page ") -> DataFrame:
    """Events an hour over each run's last ``rows`` rows whose message holds ``progress`` (None: all rows)."""
    log = log if progress is None else log.filter(F.contains("msg", F.lit(progress)))
    w = Window.partitionBy("run_id").orderBy(F.col("ts").desc(), F.col("seq").desc())
    last = log.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= rows)
    seconds = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    return last.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), (seconds / 1e6).alias("seconds")).withColumn("per_hour", F.when(F.col("seconds") > 0, (F.col("n") - 1) * 3600 / F.col("seconds")))


def remaining(rates: DataFrame, left: Column, per_page: int) -> DataFrame:
    """Hours until ``left`` rows are read at the recent rate of pages; null without a rate."""
    return rates.withColumn("hours_left", F.when(F.col("per_hour") > 0, F.greatest(left, F.lit(0)) / per_page / F.col("per_hour")))


def bad_streaks(log: DataFrame, bad: Column, alert: int = 3) -> DataFrame:
    """Runs of consecutive bad rows, as long as the alert level or longer. A null is not bad."""
    marked = log.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    islands = running(marked, "run_id", ["ts", "seq"], sums={"_island": F.when(F.col("_bad"), 0).otherwise(1)})
    return islands.filter("_bad").groupBy("run_id", "_island").agg(F.count(F.lit(1)).alias("streak"), F.min("seq").alias("first_seq")).filter(F.col("streak") >= alert).drop("_island")


def dry_spells(log: DataFrame, good: Column, rows: int = 40) -> DataFrame:
    """Rows at which none of the last ``rows`` rows was good: the last good one lies so far back."""
    placed = running(log.withColumn("_good", F.coalesce(good, F.lit(False))), "run_id", ["ts", "seq"], sums={"_place": F.lit(1)})
    seen = running(placed, "run_id", ["ts", "seq"], maxima={"_last": F.when(F.col("_good"), F.col("_place"))})
    return seen.filter((F.col("_place") - F.coalesce("_last", F.lit(0))) >= rows).drop("_good", "_place", "_last")


def fold_checkpoints(tokens: DataFrame) -> DataFrame:
    """State of each query: done once completed, for ever; else the last position."""
    return tokens.groupBy("query").agg(F.bool_or(F.col("pos").isNull()).alias("done"), F.max_by("pos", F.when(F.col("pos").isNotNull(), F.col("seq"))).alias("pos")).withColumn("pos", F.when(~F.col("done"), F.col("pos")))


def parse_checkpoints(lines: DataFrame) -> DataFrame:
    """(query, pos) of blank-separated tokens ``query`` or ``query@pos``; a null pos is complete."""
    token = F.explode(F.filter(F.split("value", r"\s+"), lambda t: t != ""))
    return lines.select(token.alias("_t")).select(F.substring_index("_t", "@", 1).alias("query"), F.when(F.contains("_t", F.lit("@")), F.substring_index("_t", "@", -1).try_cast("int")).alias("pos"))


def health(log: DataFrame, as_of: str, stall_s: int = 600, most_marks: int = 3, running: bool = True, work_left: bool = False, runs: DataFrame | None = None) -> DataFrame:
    """Code of each run since its last start: 0 well, 1 stalled, too many marks (messages that hold "token
    minted") within ten minutes, aborted (warnings that hold "aborted"), or not running with work left.
    Of ``runs`` (run_id) those without a log get 2."""
    now = F.lit(as_of).cast("timestamp_ntz")
    live = since_last_start(log)
    idle = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.max("ts").cast("timestamp"))
    marks = F.count_if(F.contains("msg", F.lit("token minted")) & (F.col("ts") > now - F.expr("INTERVAL 10 MINUTES")))
    facts = live.groupBy("run_id").agg((idle / 1e6).alias("idle_s"), marks.alias("marks"), F.count_if((F.col("level") == "WARNING") & F.contains("msg", F.lit("aborted"))).alias("aborted"))
    ill = ((F.col("idle_s") > stall_s) & F.lit(running)) | (F.col("marks") > most_marks) | (F.col("aborted") > 0) | F.lit(work_left and not running)
    found = facts.withColumn("code", ill.cast("int"))
    return found if runs is None else runs.select("run_id").distinct().join(found, "run_id", "left").withColumn("code", F.coalesce("code", F.lit(2)))


def page_facts(rows: DataFrame, page: str, event_time: str, since: str) -> DataFrame:
    """A row for each page: n, old (all its rows are older than ``since``; one without a time is not), and
    exact, its rows at or after ``since``."""
    start = F.lit(since).cast("timestamp_ntz")
    return rows.groupBy(page).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col(event_time) < start, F.lit(False))).alias("old"), F.count_if(F.col(event_time) >= start).alias("exact"))


def delta_pages(rows: DataFrame, page: str, event_time: str, since: str, exact: bool = False) -> DataFrame:
    """What a walk from the newest page on reads: all pages up to the first one whose rows are all older
    than ``since``; a row without a time keeps the walk going. Page numbers ascend from the newest. Whole
    pages are kept, older rows included; ``exact`` keeps of them only the rows at or after ``since``, and
    none without a time."""
    last = page_facts(rows, page, event_time, since).filter("old").agg(F.min(page).alias("_last"))
    met = rows.crossJoin(F.broadcast(last)).filter(F.col("_last").isNull() | (F.col(page) <= F.col("_last"))).drop("_last")  # one row
    return met.filter(F.col(event_time) >= F.lit(since).cast("timestamp_ntz")) if exact else met


def gaps(log: DataFrame) -> DataFrame:
    """Seconds since the run's row before; null for its first."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    timed = running(log, "run_id", ["ts", "seq"], previous={"_before": us})
    return timed.withColumn("gap_s", (us - F.col("_before")) / 1e6).drop("_before")


def positions(df: DataFrame, group: str, order: Column, amount: str) -> DataFrame:
    """The place of each row in its group, and the amount banked up to it (nulls add nothing). Rows that
    tie in ``order`` take their places in any order."""
    placed = running(df.withColumn("_order", order), group, ["_order"], sums={"position": F.lit(1), "banked": F.col(amount)})
    return placed.drop("_order")
