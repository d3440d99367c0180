"""Cutting a price axis into ranges, and walking it by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.operators.ordered import running
from plazalake.sources.scratch import stored


def price_band(price: Column) -> Column:
    """A price cut to three leading digits: ascends with the price and has few values, some
    thousands for each sign, whatever the number of prices."""
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(price))) - 2)
    return F.when(price == 0, F.lit(0.0)).otherwise(F.floor(price / step) * step)


#: Rows that one task orders where an order runs through a whole table.
STRETCH = 4096
#: Levels of stretches, stretches of stretches and so on; what the last of them leaves is ordered in one task.
LEVELS = 3


def carried(df: DataFrame, at: str, value: str, name: str, levels: int = LEVELS) -> DataFrame:
    """``df`` with the last non-null ``value`` before each row as ``name``; ``at`` numbers the rows about
    densely. Stretches are ordered by themselves, and their last values in stretches of their own."""
    before = lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    if not levels:
        return df.withColumn(name, before(Window.orderBy(at)))
    stretch, inside, ahead = f"_stretch{levels}", f"_inside{levels}", f"_ahead{levels}"
    staged = df.withColumn(stretch, F.floor(F.col(at) / STRETCH))
    lasts = staged.groupBy(stretch).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at))).alias(value))
    earlier = carried(lasts, stretch, value, ahead, levels - 1).select(stretch, ahead)
    placed = staged.withColumn(inside, before(Window.partitionBy(stretch).orderBy(at))).join(earlier, stretch)
    return placed.withColumn(name, F.coalesce(inside, ahead)).drop(stretch, inside, ahead)


def summed(df: DataFrame, at: str, amount: str, name: str, levels: int = LEVELS) -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows before each row by ``at``, in stretches like ``carried``."""
    before = lambda w: F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if not levels:
        return df.withColumn(name, before(Window.orderBy(at)))
    stretch, inside, ahead = f"_stretch{levels}", f"_inside{levels}", f"_ahead{levels}"
    staged = df.withColumn(stretch, F.floor(F.col(at) / STRETCH))
    totals = staged.groupBy(stretch).agg(F.sum(amount).alias(amount))
    earlier = summed(totals, stretch, amount, ahead, levels - 1).select(stretch, ahead)
    placed = staged.withColumn(inside, before(Window.partitionBy(stretch).orderBy(at))).join(earlier, stretch)
    return placed.withColumn(name, F.col(inside) + F.col(ahead)).drop(stretch, inside, ahead)


def price_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows by price with the rows before each price. Sums run within bands, and over the bands'
    totals, so no task orders all prices."""
    n = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("price")).agg(F.count(F.lit(1)).alias("n"))
    banded = n.withColumn("_band", price_band(F.col("price").cast("double")))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bands = banded.groupBy("_band").agg(F.sum("n").alias("n")).select("_band", earlier(Window.orderBy("_band")).alias("_earlier"))
    within = banded.withColumn("_within", earlier(Window.partitionBy("_band").orderBy("price")))
    return within.join(bands, "_band").select("price", "n", (F.col("_earlier") + F.col("_within")).alias("before"))


def price_shards(df: DataFrame, key: str, target: int) -> DataFrame:
    """Ranges of about ``target`` rows that cover every row with a price once; a price is never cut,
    so a range is below the target plus its largest price."""
    shard = F.floor(F.col("before") / target).cast("long")
    return price_counts(df, key).groupBy(shard.alias("shard")).agg(F.min("price").alias("lo"), F.max("price").alias("hi"), F.sum("n").alias("n"))


def degenerate_prices(df: DataFrame, key: str, page: int) -> DataFrame:
    """Single prices that hold more than a page, with the excess."""
    return df.groupBy(F.col(key).alias("price")).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > page) & F.col("price").isNotNull()).withColumn("excess", F.col("n") - page)


def quantile_cuts(df: DataFrame, group: str, key: str, per_range: int = 40, least: int = 2, most: int = 60) -> DataFrame:
    """Cut points of each group at quantiles of its sorted values: k ranges, k the rows over
    ``per_range`` between ``least`` and ``most``; half-even rounding; only cuts that advance."""
    rows = df.filter(F.col(key).isNotNull())
    n = F.count(F.lit(1))
    sized = rows.groupBy(group).agg(n.alias("n")).withColumn("k", F.least(F.greatest(F.ceil(F.col("n") / per_range), F.lit(least)), F.lit(most)))
    wanted = sized.filter("n > 1").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k") - 1))).select(group, F.bround(F.col("i") * (F.col("n") - 1) / F.col("k")).cast("long").alias("_at"))
    by = rows.groupBy(group, F.col(key).alias("cut")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group).orderBy("cut")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = by.withColumn("_before", before).withColumn("_lo", F.min("cut").over(Window.partitionBy(group))).withColumn("_hi", F.max("cut").over(Window.partitionBy(group)))
    met = placed.join(wanted, group).filter((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_n")))
    return met.filter("cut > _lo AND cut < _hi").select(group, "cut").distinct()


def split_ranges(ranges: DataFrame, samples: DataFrame, group: str, key: str, per_range: int = 40, least: int = 2, most: int = 60) -> DataFrame:
    """Sub-ranges (group, position, lo, hi) of ``ranges`` (group, lo, hi or null for open, total), cut at
    quantiles of the sampled prices that lie in the range; both ends are inclusive, so that neighbours
    overlap and leave no gap. With fewer than two samples a closed range is cut at its geometric mean
    and an open one at four times its start, 1,000 at least. No rows where no cut makes progress.
    Samples are one page of a range, which bounds the array a group makes."""
    good = (F.col(key) != 0) & (F.col(key) >= F.col("lo")) & (F.coalesce(F.col("hi"), F.lit(0)).eqNullSafe(0) | (F.col(key) <= F.col("hi")))
    inside = samples.select(group, key).join(ranges, group).filter(good).groupBy(group).agg(F.array_sort(F.collect_list(key)).alias("_pool"))
    r = ranges.join(inside, group, "left").withColumn("_pool", F.coalesce("_pool", F.array())).withColumn("_n", F.size("_pool"))
    open_top = F.coalesce(F.col("hi"), F.lit(0)) == 0
    k = F.least(F.greatest(F.ceil(F.col("total") / per_range), F.lit(least)), F.lit(most))
    at = lambda i: F.bround(i * (F.col("_n") - 1) / F.col("_k")).cast("int")
    middle = F.floor(F.sqrt(F.col("lo") * F.col("hi")))
    middle = F.when(middle != 0, middle).otherwise(F.floor((F.col("lo") + F.col("hi")) / 2))
    start = F.greatest(F.col("lo") * 4, F.lit(1000))
    cuts = F.when(F.col("_n") >= 2, F.transform(F.sequence(F.lit(1).cast("long"), F.col("_k") - 1), lambda i: F.get(F.col("_pool"), at(i)).cast("double"))).otherwise(
        F.array(F.when(open_top, start).otherwise(middle).cast("double"))
    )
    useful = F.filter(F.array_sort(F.array_distinct(F.col("_cuts"))), lambda c: (c > F.col("lo")) & (open_top | (c < F.col("hi"))))
    r = r.withColumn("_k", k.cast("long")).withColumn("_cuts", cuts).withColumn("_cuts", useful).filter(F.size("_cuts") > 0)
    lo, hi = F.concat(F.array(F.col("lo").cast("double")), F.col("_cuts")), F.concat(F.col("_cuts"), F.array(F.col("hi").cast("double")))
    each = r.select(group, F.posexplode(F.arrays_zip(lo.alias("lo"), hi.alias("hi"))).alias("position", "_r"))
    return each.select(group, "position", F.col("_r.lo").alias("lo"), F.col("_r.hi").alias("hi"))


def keyset_walk(df: DataFrame, key: str, size: int, pages: int) -> DataFrame:
    """window and page of each row when a walk takes ``pages`` pages of ``size`` rows at a time in
    (price, listing_id) order, without overlap. Row positions come from price counts."""
    w = Window.partitionBy(key).orderBy("listing_id")
    counts = price_counts(df, key).withColumnRenamed("price", key)
    position = F.col("before") + F.row_number().over(w) - 1
    rows = df.join(counts.select(key, "before"), key).withColumn("position", position).drop("before")
    return rows.withColumn("window", F.floor(F.col("position") / (size * pages))).withColumn("page", F.floor(F.col("position") % (size * pages) / size))


def keyset_windows(df: DataFrame, key: str, size: int, pages: int) -> DataFrame:
    """Windows of a walk that takes ``pages`` pages of ``size`` rows and goes on at the last price it
    saw, that price included: window, price, first_row, n_rows, again (rows of that price read twice).
    A price that fills a whole window is stepped over.

    Each price knows the price at which a walk from it would go on; which prices the walk from the
    first one meets is found by doubling the step. Two steps read at least ``size * pages`` rows, so the
    number of rounds is known beforehand, and a round is one write of the prices met and the longer steps.
    """
    cap = size * pages
    counts = stored(price_counts(df, key))
    total, first = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min("price")).first()
    mark = counts.select(F.col("before").alias("at"), F.lit(0).alias("ask"), F.struct("before", "price").alias("m"), F.lit(None).cast("long").alias("from"), F.lit(None).cast("long").alias("after"))
    ask = counts.select((F.col("before") + cap - 1).alias("at"), F.lit(1).alias("ask"), F.lit(None).cast(mark.schema["m"].dataType).alias("m"), F.col("before").alias("from"), (F.col("before") + F.col("n")).alias("after"))
    both = mark.union(ask.filter(F.col("at") < total - 1)).withColumn("_block", F.floor(F.col("at") / cap))
    last = F.last("m", ignorenulls=True)
    earlier = carried(both.groupBy("_block").agg(F.max("m").alias("_own")), "_block", "_own", "_m").select("_block", "_m")
    inside = both.withColumn("_in", last.over(Window.partitionBy("_block").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, 0))).filter("ask = 1")
    met = F.coalesce("_in", "_m")["before"]
    step = stored(inside.join(earlier, "_block").select("from", F.when(met > F.col("from"), met).otherwise(F.col("after")).alias("to")).filter(F.col("to") < total))
    met_first = counts.filter(F.col("price") == first).select(F.col("before").alias("from"), F.lit(None).cast("long").alias("to"))
    both = step.select("from", "to").union(met_first)  # rows without ``to`` are met, the others are steps
    for _ in range((2 * -(-total // cap)).bit_length()):
        seen, jump = both.filter("to IS NULL").select(F.col("from").alias("at")), both.filter("to IS NOT NULL")
        onward = jump.select(F.col("from").alias("to"), F.col("to").alias("_then"))
        longer = jump.join(onward, "to").select("from", F.col("_then").alias("to"))
        reached = seen.union(seen.join(jump, seen["at"] == jump["from"]).select(F.col("to").alias("at"))).distinct()
        both = stored(longer.union(reached.select(F.col("at").alias("from"), F.lit(None).cast("long").alias("to"))))
    seen = both.filter("to IS NULL").select(F.col("from").alias("at"))
    rows = F.least(F.lit(cap), F.lit(total) - F.col("at"))
    starts = seen.join(counts, seen["at"] == counts["before"]).select("at", "price", F.floor(F.col("at") / cap).alias("_place"), rows.alias("n_rows"))
    # windows start about ``cap`` rows apart, so places number them about densely; a place may hold several
    ends = starts.groupBy("_place").agg(F.max(F.col("at") + F.col("n_rows")).alias("_end"))
    last_end = carried(ends, "_place", "_end", "_upto").select("_place", "_upto")
    here = F.lag(F.col("at") + F.col("n_rows")).over(Window.partitionBy("_place").orderBy("at"))
    placed = starts.withColumn("_here", here).join(last_end, "_place")
    numbered = summed(placed.withColumn("_scaled", F.col("at") / cap).withColumn("_one", F.lit(1)), "_scaled", "_one", "window")
    return numbered.select(
        F.col("window").cast("long"), "price", F.col("at").alias("first_row"), "n_rows", F.greatest(F.coalesce("_here", "_upto") - F.col("at"), F.lit(0)).alias("again"),
    )


def contiguous(ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """Whether each range ends where the next one begins; the last has null. Ranges are sorted over all tasks."""
    turned = running(ranges.withColumn("_all", F.lit(0)), "_all", [F.col(lo).desc_nulls_last()], previous={"_next": F.col(lo)})
    return turned.withColumn("meets_next", F.col("_next") == F.col(hi)).drop("_all", "_next")


def next_floor(df: DataFrame, group: str, position: str, floor: float) -> DataFrame:
    """The price from which a walk goes on: the whole part of that of the last MXN row with a price, floor
    + 1 at least."""
    priced = F.when((F.col("currency") == "MXN") & (F.col("price") > 0), F.col("price"))
    last = F.max_by(F.floor(priced).cast("double"), F.when(priced.isNotNull(), F.col(position)))
    return df.groupBy(group).agg(F.greatest(last, F.lit(floor + 1)).alias("next_floor"), F.max(priced).alias("highest"))


def needs_split(df: DataFrame, group: str, page: int) -> DataFrame:
    """Whether a group holds more than one page, which alone calls for a split."""
    n = F.count(F.lit(1))
    return df.groupBy(group).agg(n.alias("n"), (n > page).alias("split"))


def unpriced(df: DataFrame, key: str) -> DataFrame:
    """Rows without a price, which no range by price can reach."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("unpriced"))
    return n.withColumn("share", F.col("unpriced") / F.col("n"))
