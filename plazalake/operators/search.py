"""Search: optional predicates joined by AND, two orders, a limit, and display columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.functions import geo
from plazalake.functions.text import search_key
from plazalake.operators.shards import price_counts
from plazalake.sources import layout


def query_key(text: str) -> str:
    """The search key of a literal, as ``search_key`` makes it of a column."""
    return unicodedata.normalize("NFKD", text.lower()).encode("ascii", "ignore").decode()


def with_norm(df: DataFrame) -> DataFrame:
    return df.withColumn("norm", search_key("city", "province", "title"))


def predicates(
    zone: str | None = None, city: str | None = None, operation: str | None = None, property_type: str | None = None, sources: Sequence[str] = (),
    min_price: float | None = None, max_price: float | None = None, min_area: float | None = None, max_area: float | None = None,
    min_bedrooms: int | None = None, as_of: datetime | None = None, within: timedelta | None = None,
    near: tuple[float, float] | None = None, radius_m: float | None = None, model: str = "sphere",
) -> list[Column]:
    """One condition for each criterion given; an empty list of sources means all."""
    out = [F.contains(F.col("norm"), F.lit(t)) for t in query_key(zone or "").split()]
    if city:
        out.append(F.contains(F.col("norm"), F.lit(query_key(city))))
    if operation:
        out.append(F.col("operation") == operation)
    if property_type:
        out.append(F.contains(F.lower("property_type"), F.lit(property_type.lower())))
    if sources:
        out.append(F.col("source").isin(list(sources)))
    if min_price is not None:
        out.append(F.col("price") >= min_price)
    if max_price is not None:
        out += [F.col("price") <= max_price, F.col("price") > 0]
    if min_area is not None:
        out.append(F.col("area_m2") >= min_area)
    if max_area is not None:
        out.append(F.col("area_m2") <= max_area)
    if min_bedrooms is not None:
        out.append(F.col("bedrooms") >= min_bedrooms)
    if as_of is not None and within is not None:
        out.append(F.col("observed_at") >= F.lit(as_of - within).cast("timestamp_ntz"))
    if near is not None and radius_m is not None:
        out.append(geo.within(F.col("lat"), F.col("lng"), *near, radius_m, model))
    return out


def search(df: DataFrame, limit: int | None = 20, **criteria) -> DataFrame:
    """Rows that meet all criteria: nearest first when a point is given, else dearest first. ``model``
    names the distance, sphere or ellipsoid. In a table laid out by ``cell`` a radius also limits that."""
    if criteria.get("near") and criteria.get("radius_m") is not None and "cell" in df.columns:
        df = df.filter(layout.in_ranges(F.col("cell"), layout.ranges(*criteria["near"], criteria["radius_m"])))
    for p in predicates(**criteria):
        df = df.filter(p)
    if near := criteria.get("near"):
        df = df.withColumn("distance_m", geo.MODELS[criteria.get("model", "sphere")](F.col("lat"), F.col("lng"), F.lit(near[0]), F.lit(near[1]))).orderBy("distance_m", "listing_id")
    else:
        df = df.orderBy(F.col("price").desc_nulls_last(), "listing_id")
    return df if limit is None else df.limit(limit)


def sample(df: DataFrame, n: int, key: str = "listing_id", seed: int = 7) -> DataFrame:
    """The first ``n`` rows in an order drawn by ``seed``: the same rows whatever their partitions. Ties
    go by the key; each task keeps ``n`` rows of its own."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    return df.orderBy(drawn, key).limit(n)


def first(df: DataFrame, n: int, order: Sequence[str] = ("listed_at", "listing_id")) -> DataFrame:
    """The first ``n`` rows in an order, which should be total."""
    return df.orderBy(*order).limit(n)


def display(df: DataFrame) -> DataFrame:
    """Texts to show: prices per square metre are marked, distances are shown where there are some."""
    price = F.when(F.coalesce("price", F.lit(0.0)) == 0, "no price").otherwise(
        F.concat(F.floor("price").cast("string"), F.lit(" "), F.coalesce("currency", F.lit("")))
    )
    if "price_is_per_m2" in df.columns:
        price = F.concat(price, F.when(F.col("price_is_per_m2") & (F.coalesce("price", F.lit(0.0)) != 0), "/m2").otherwise(""))
    km = [F.coalesce(F.concat(F.format_number(F.col("distance_m") / 1000, 1), F.lit(" km")), F.lit("")).alias("distance_text")] if "distance_m" in df.columns else []
    area = F.when(F.coalesce("area_m2", F.lit(0.0)) == 0, "").otherwise(F.concat(F.floor("area_m2").cast("string"), F.lit(" m2")))
    return df.select("listing_id", price.alias("price_text"), area.alias("area_text"), F.coalesce("city", F.lit("")).alias("city"), F.coalesce("province", F.lit("")).alias("province"), *km)


def page_by_price(df: DataFrame, page: int, size: int) -> DataFrame:
    """Rows of one page in (price, listing_id) order. Distinct prices are counted first, so no task
    orders more rows than the prices that the page touches hold."""
    empty = df.filter("price IS NULL").agg(F.lit(None).cast("double").alias("price"), F.count(F.lit(1)).alias("_n"), F.lit(0).cast("long").alias("_before"))
    priced = price_counts(df, "price").select("price", F.col("n").alias("_n"), F.col("before").alias("_before"))
    shifted = priced.crossJoin(empty.select(F.col("_n").alias("_empty"))).select("price", "_n", (F.col("_before") + F.col("_empty")).alias("_before"))  # one row
    before = empty.unionByName(shifted)
    first, last = page * size, (page + 1) * size
    touched = before.filter((F.col("_before") < last) & (F.col("_before") + F.col("_n") > first)).drop("_n")
    position = F.col("_before") + F.row_number().over(Window.partitionBy("price").orderBy("listing_id")) - 1
    rows = df.join(touched, df["price"].eqNullSafe(touched["price"])).drop(touched["price"])
    return rows.withColumn("position", position).filter(F.col("position").between(first, last - 1)).drop("_before")


def keep(df: DataFrame, title: str | None = None, property_types: Sequence[str] = (), without_point: bool = False) -> DataFrame:
    """Rows to fetch in detail: by a part of the title, by types, and only those without a usable point."""
    if title:
        df = df.filter(F.contains("title", F.lit(title)))
    if property_types:
        df = df.filter(F.col("property_type").isin(list(property_types)))
    return df.filter(~geo.point_ok(F.col("lat"), F.col("lng"))) if without_point else df
