"""Revisit resolution for web captures: which stored response a not-modified capture stands for.

A revisit is matched to the latest earlier full response of the same canonical URL (an as-of join),
its validators are checked against that response, and the headers that a 304 may update are merged
over the stored ones. Hot URLs are split by time: each (URL, period) is ordered on its own, and what
a period inherits is carried over a table of one row per URL and period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query parameters that never change a page. Fixed values.
TRACKING = ("utm_[a-z]+", "gclid", "fbclid", "ref", "sessionid")
#: Headers that describe the stored body or one connection; a 304 does not replace them. Fixed values.
KEPT_HEADERS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www.``, default port, fragment, tracking parameters, closing slash; host in
    lower case; parameters sorted. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(rf"^({'|'.join(TRACKING)})(=|$)"))
    tail = F.array_join(F.array_sort(query), "&")
    return F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then meet, the last value stays."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")


def resolve_revisits(captures: DataFrame, period: str = "day") -> DataFrame:
    """One row per revisit of ``captures`` (record_id, record_type, url, captured_at, digest,
    headers map): record_id, url_key, captured_at, refers_to, status, digest, headers.

    status is ``resolved``, ``changed`` (the validators disagree with the latest earlier response),
    or ``orphan`` (no earlier full response, or a null URL or time). An ETag decides if both sides
    have one (weak marks ignored), else Last-Modified, else the payload digest; nothing to compare
    counts as agreement. Of responses at one time the largest record_id is the latest; a response
    at the revisit's own time is not earlier. headers are the response's, with those of the revisit
    over them save KEPT_HEADERS, for resolved rows, else the revisit's own. Names are in lower case.
    """
    rows = captures.select(
        "record_id", (F.col("record_type") == "response").alias("_full"), canonical_url(F.col("url")).alias("url_key"), "captured_at", "digest",
        lower_keys(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>"))).alias("headers"),
    ).filter(F.col("_full") | (F.lit(True) & captures["record_type"].isin("revisit", "response")))
    rows = rows.withColumn("_period", F.date_trunc(period, "captured_at"))
    whole = F.when(F.col("_full"), F.struct("captured_at", "record_id", "digest", "headers"))
    usable = rows.filter("url_key IS NOT NULL AND captured_at IS NOT NULL")

    latest = F.max_by(F.when(F.col("_full"), F.struct("captured_at", "record_id", "digest", "headers")), F.when(F.col("_full"), F.struct("captured_at", "record_id")))
    periods = usable.groupBy("url_key", "_period").agg(latest.alias("_last"))
    carried = F.last("_last", ignorenulls=True).over(Window.partitionBy("url_key").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1))
    inherited = periods.select("url_key", "_period", carried.alias("_carried"))

    # revisits sort before responses of the same time: those are not earlier
    order = Window.partitionBy("url_key", "_period").orderBy("captured_at", "_full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = usable.withColumn("_inside", F.last(whole, ignorenulls=True).over(order)).filter("NOT _full")
    matched = inside.join(inherited, ["url_key", "_period"]).withColumn("_found", F.coalesce("_inside", "_carried")).drop("_inside", "_carried")
    lost = rows.filter("NOT _full AND (url_key IS NULL OR captured_at IS NULL)").withColumn("_found", F.lit(None).cast(matched.schema["_found"].dataType))

    out = matched.select("record_id", "url_key", "captured_at", "digest", "headers", "_found").unionByName(
        lost.select("record_id", "url_key", "captured_at", "digest", "headers", "_found")
    )
    old, new = F.col("_found.headers"), F.col("headers")
    modified = F.element_at(old, "last-modified"), F.element_at(new, "last-modified")
    agrees = (
        F.when(_etag(old).isNotNull() & _etag(new).isNotNull(), _etag(old) == _etag(new))
        .when(modified[0].isNotNull() & modified[1].isNotNull(), modified[0] == modified[1])
        .otherwise(F.coalesce(F.col("_found.digest") == F.col("digest"), F.lit(True)))
    )
    status = F.when(F.col("_found").isNull(), "orphan").when(agrees, "resolved").otherwise("changed")
    permitted = F.map_filter(new, lambda k, _: ~k.isin(*KEPT_HEADERS))
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(permitted, k))
    return out.withColumn("status", status).select(
        "record_id", "url_key", "captured_at", F.col("_found.record_id").alias("refers_to"), "status",
        F.when(F.col("status") == "resolved", F.col("_found.digest")).otherwise(F.col("digest")).alias("digest"),
        F.when(F.col("status") == "resolved", F.map_concat(kept, permitted)).otherwise(new).alias("headers"),
    )


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records derived from a pages table (page_id, url, html): a full response per page,
    taken at minute page_id, with an ETag and a date; and a later not-modified capture of every
    third page, some with a changed ETag or with none."""
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    etag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    full = F.create_map(
        F.lit("ETag"), etag, F.lit("Last-Modified"), F.date_format(start, "yyyy-MM-dd"), F.lit("Content-Type"), F.lit("text/html"),
        F.lit("Content-Length"), F.length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    stale = F.col("page_id") % 15 == 0
    light = F.create_map(
        F.lit("ETag"), F.when(stale, F.lit('"stale"')).when(F.col("page_id") % 2 == 0, F.concat(F.lit("W/"), etag)), F.lit("Content-Length"), F.lit("0"),
        F.lit("Cache-Control"), F.lit("max-age=120"), F.lit("Age"), (F.col("page_id") % 60).cast("string"),
    )
    responses = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("record_type"), "url", start.alias("captured_at"), digest.alias("digest"), full.alias("headers")
    )
    revisits = pages.filter("page_id % 3 = 0").select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("record_type"), "url",
        (start + F.expr("make_interval(0, 0, 0, page_id % 5, 1)")).alias("captured_at"), digest.alias("digest"),
        F.map_filter(light, lambda _, v: v.isNotNull()).alias("headers"),
    )
    return responses.unionByName(revisits)
