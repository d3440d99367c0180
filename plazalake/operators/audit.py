"""Audits: coverage, identity, fill, completeness, transfer, sizing, read-back checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.functions.text import segment_depth, segment_parent

from plazalake.functions.text import ceil_div, truthy


def coverage(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Rows by label, an empty one as (missing), against expected labels in both directions."""
    seen = df.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("(missing)")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    want = expected.select("label", F.lit(True).alias("_e"))
    status = F.when(F.col("_e").isNull(), "unexpected").when(F.col("n").isNull(), "absent").otherwise("covered")
    return seen.join(want, "label", "full_outer").select("label", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))


def identity_counts(df: DataFrame, key: str, operation: str, approximate: bool = False) -> DataFrame:
    """Rows, distinct keys, distinct pairs of key and operation (a null is a value of its own), rows that
    repeat a pair, and pairs beyond one a key."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    pair = distinct(F.struct(key, operation))
    one = df.agg(F.count(F.lit(1)).alias("n"), distinct(F.struct(key)).alias("ids"), pair.alias("pairs"))
    return one.select("n", "ids", "pairs", (F.col("n") - F.col("pairs")).alias("repeated"), (F.col("pairs") - F.col("ids")).alias("both_operations"))


def fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percent of rows in which each column is set, in one pass; a row for each column."""
    kinds = dict(df.dtypes)
    one = df.agg(*(F.avg(truthy(F.col(c), kinds[c]).cast("int")).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.round(F.col(c) * 100, 4).alias("percent")) for c in columns))
    return one.select(F.explode(pairs).alias("_p")).select("_p.*")


def top_categories(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(k)


def dimension_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts by each column on its own and in total, in one scan."""
    sets = [[F.col(c)] for c in columns] + [[]]
    return df.groupingSets(sets, *(F.col(c) for c in columns)).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"))


def completeness(got: DataFrame, advertised: DataFrame, key: str, least: float = 0.9) -> DataFrame:
    """Rows got against rows advertised by query; short below ``least``."""
    n = got.groupBy(key).agg(F.count(F.lit(1)).alias("got"))
    both = advertised.join(n, key, "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return both.withColumn("short", F.col("got") < F.col("advertised") * least)


def transfer(log: DataFrame, phase: str, size: str) -> DataFrame:
    """Requests and bytes by phase with each phase's share of the bytes."""
    from pyspark.sql import Window

    sums = log.groupBy(F.col(phase).alias("phase")).agg(F.count(F.lit(1)).alias("requests"), F.sum(size).alias("size"))
    total = F.sum("size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return sums.withColumn("per_request", F.round(F.col("size") / F.col("requests"), 6)).withColumn("share", F.round(F.col("size") / total, 8))


def sizing(df: DataFrame, category: str, page: int, page_mb: float, page_s: float) -> DataFrame:
    """Rows, pages, megabytes and hours of each category and in total."""
    n = df.rollup(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    pages = ceil_div(F.col("n"), page)
    return n.select("category", "n", pages.alias("pages"), F.round(pages * page_mb, 6).alias("mb"), F.round(pages * page_s / 3600, 8).alias("hours"))


def dominant_label(df: DataFrame, group: str, label: str) -> DataFrame:
    """The most frequent label of each group, the first by name of ties."""
    n = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(group).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("label"), F.max("n").alias("n"))


def overlap(df: DataFrame, key: str, category: str) -> DataFrame:
    """Keys that appear in more than one category."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(category)), ",").alias("categories"), F.count_distinct(category).alias("n")).filter("n > 1")


def majority_applied(df: DataFrame, group: str, label: Column, wanted: Column) -> DataFrame:
    """Whether a filter was applied: at least half of the labelled rows match; none labelled passes."""
    labelled, match = F.count_if(label.isNotNull() & (label != "")), F.count_if(label == wanted)
    return df.groupBy(group).agg(labelled.alias("labelled"), match.alias("matching")).withColumn("applied", F.col("matching") * 2 >= F.col("labelled"))


def range_applied(df: DataFrame, group: str, lo: float, hi: float | None) -> DataFrame:
    """Whether a price range was applied: of the MXN rows with a price, which alone count, those
    outside are at most max(2, n div 4). Zero is no price; without such rows the range holds."""
    priced = (F.col("currency") == "MXN") & (F.col("price") != 0)
    out = priced & ((F.col("price") < lo) | (F.lit(False) if hi is None else F.col("price") > hi))
    n = df.groupBy(group).agg(F.count_if(priced).alias("n"), F.count_if(out).alias("outside"))
    return n.withColumn("applied", F.col("outside") <= F.greatest(F.lit(2), F.floor(F.col("n") / 4)))


def parameters_applied(df: DataFrame, echoed: Column, wanted: Column) -> DataFrame:
    """Whether an echoed parameter equals the wanted one; empty equals absent."""
    return df.withColumn("applied", F.nullif(echoed, F.lit("")).eqNullSafe(F.nullif(wanted, F.lit(""))))


def verdicts(df: DataFrame, verdict: Column) -> DataFrame:
    return df.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def tree_totals(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """Total of each parent against the sum over its children: whether the tree is a partition."""
    sums = edges.join(totals.withColumnRenamed("segment", "child"), "child").groupBy("parent").agg(F.sum("n").alias("children"))
    return sums.join(totals.withColumnRenamed("segment", "parent"), "parent").select("parent", "n", "children", (F.col("n") == F.col("children")).alias("partition"))


def conditional_counts(df: DataFrame, group: str, **conditions: Column) -> DataFrame:
    """Rows of each group that meet each condition; a null counts as not met."""
    return df.groupBy(group).agg(*(F.count_if(c).alias(name) for name, c in conditions.items()))


def fetch_yield(df: DataFrame, batch: str, key: str) -> DataFrame:
    """Rows served in each batch, distinct ones, repeats, and the share that was fresh."""
    n = df.groupBy(batch).agg(F.count(F.lit(1)).alias("served"), F.count_distinct(key).alias("fresh"))
    return n.select("*", (F.col("served") - F.col("fresh")).alias("overlap"), (F.col("fresh") / F.col("served")).alias("yield"))


def segment_edges(segments: DataFrame) -> DataFrame:
    """(child, parent, depth) of all ``segment`` values and of what is above them, to any depth: the parent
    of a_b_c is b_c; roots have the parent ''."""
    parts = F.split("segment", "_")
    every = segments.select(parts.alias("_p")).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("_p")), lambda i: F.array_join(F.slice("_p", i, F.size("_p")), "_"))).alias("child"))
    return every.distinct().select("child", segment_parent(F.col("child")).alias("parent"), segment_depth(F.col("child")).cast("long").alias("depth"))


def depth_counts(segments: DataFrame) -> DataFrame:
    """How many segments there are by first part and depth."""
    return segments.groupBy(F.substring_index("segment", "_", 1).alias("root"), segment_depth(F.col("segment")).cast("long").alias("depth")).agg(F.count(F.lit(1)).alias("n"))
