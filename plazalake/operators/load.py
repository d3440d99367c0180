"""Loading: latest row per key, upsert, point patch, sidecars, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.functions.text import falsy_coalesce

KEYS = ("source", "listing_id")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which should be total for repeatable results."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS, keep_if_null: Sequence[str] = (), newest: str | None = None) -> DataFrame:
    """``base`` with rows of ``new`` inserted or written over it, nulls included. Columns of
    ``keep_if_null`` keep the stored value where the new one is null. With ``newest``, a stored row
    whose value of that column is greater stays as it is. Keys are unique on each side."""
    columns = [c for c in base.columns if c not in keys]
    b = base.select(*keys, F.struct(*columns).alias("_old"))
    n = new.select(*keys, F.struct(*columns).alias("_new"))
    takes = F.col("_new").isNotNull()
    if newest:
        takes &= F.coalesce(F.col(f"_new.{newest}") >= F.col(f"_old.{newest}"), F.col(f"_old.{newest}").isNull())

    def value(c: str) -> Column:
        fresh = F.col(f"_new.{c}")
        return F.when(takes, F.coalesce(fresh, F.col(f"_old.{c}")) if c in keep_if_null else fresh).otherwise(F.col(f"_old.{c}")).alias(c)

    return b.join(n, list(keys), "full_outer").select(*keys, *(value(c) for c in columns))


def patch_points(base: DataFrame, points: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[Column] = (), exclude_suspect: bool = False) -> DataFrame:
    """``base`` with lat and lng taken from ``points`` where it has the key; unknown keys are ignored
    and of repeated keys the first in ``order`` counts."""
    if exclude_suspect:
        points = points.filter(F.size("suspect") == 0)
    best = latest_per_key(points.filter("lat IS NOT NULL AND lng IS NOT NULL"), keys, list(order) or [F.col("lat"), F.col("lng")])
    p = best.select(*keys, F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
    joined = base.join(p, list(keys), "left")
    return joined.withColumn("lat", F.coalesce("_lat", "lat")).withColumn("lng", F.coalesce("_lng", "lng")).drop("_lat", "_lng").select(*base.columns)


def write_sidecar(rows: DataFrame, flags: DataFrame, path: str, keys: Sequence[str] = KEYS) -> None:
    """Every row of ``rows`` with the array ``suspect`` of its flags, empty where it has none."""
    marked = rows.join(flags.select(*keys, "suspect"), list(keys), "left")
    marked.withColumn("suspect", F.coalesce("suspect", F.array().cast("array<string>"))).write.parquet(path)


def new_rows(candidates: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.join(stored.select(*keys), list(keys), "left_anti")


def reconcile(current: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Each key with what to do: add, delete or keep."""
    a = current.select(key).distinct().withColumn("_in", F.lit(True))
    b = stored.select(key).distinct().withColumn("_st", F.lit(True))
    action = F.when(F.col("_st").isNull(), "add").when(F.col("_in").isNull(), "delete").otherwise("keep")
    return a.join(b, key, "full_outer").select(key, action.alias("action"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed in a column, null-safe."""
    b = before.select(key, F.struct(*columns).alias("_b"))
    a = after.select(key, F.struct(*columns).alias("_a"))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return b.join(a, key, "full_outer").select(key, change.alias("change")).filter("change IS NOT NULL")


def work_left(dimensions: Sequence[DataFrame], done: DataFrame) -> DataFrame:
    """Every combination of small dimensions that ``done`` does not hold."""
    plan = dimensions[0]
    for d in dimensions[1:]:
        plan = plan.crossJoin(d)  # the work plan is this product by definition
    return plan.join(done, plan.columns, "left_anti")


def with_context(sidecar: DataFrame, rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a sidecar with columns of the rows they belong to, null where there is none."""
    return sidecar.join(rows.select(key, *columns), key, "left")


def enriched(cards: DataFrame, details: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Cards with the columns of their detail page where it has a value; an empty text is none."""
    d = details.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = cards.join(d, key, "left")
    return joined.select(*(falsy_coalesce(f"_{c}", c).alias(c) if c in columns else c for c in cards.columns))


def backfilled(df: DataFrame, **sources: Sequence[str | Column]) -> DataFrame:
    """Columns filled from the first of their sources that is set; an empty text is not set."""
    return df.withColumns({name: falsy_coalesce(*given) for name, given in sources.items()})
