"""A spatial layout: a Z-order cell beside the point, files sorted by it, and cell ranges for a radius.

Neighbours in space are mostly neighbours in Z order, so a file, and a row group in it, covers a small
area, and the least and greatest cell that Parquet keeps of it let a radius search skip the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.functions import geo

#: Bits of each coordinate: cells of about 600 m at the equator.
BITS = 16


def _spread(value: Column) -> Column:
    """The bits of a number of up to 16 bits, at every second place."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def cell(lat: Column, lng: Column) -> Column:
    """The Z-order number of the cell that holds a point; null where the point is not set."""
    step = lambda v, low, width: F.least(F.floor((v - low) / width * (1 << BITS)), F.lit((1 << BITS) - 1)).cast("long")
    code = F.shiftleft(_spread(step(lat, -90, 180)), 1).bitwiseOR(_spread(step(lng, -180, 360)))
    return F.when(geo.point_ok(lat, lng), code)


def clustered(df: DataFrame, files: int | None = None, tie: str = "listing_id") -> DataFrame:
    """``df`` with ``cell``, dealt and sorted for a write. ``tie`` parts rows of one point, so that a crowd
    at one place spreads over files. Rows without a point come first."""
    placed = df.withColumn("cell", cell(F.col("lat"), F.col("lng")))
    dealt = placed.repartitionByRange("cell", tie) if files is None else placed.repartitionByRange(files, "cell", tie)
    return dealt.sortWithinPartitions("cell", tie)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by its keys over the session's shuffle partitions, at least three a core, which adaptive execution
    does not merge: for rows on which a step works far longer than their bytes tell, as a page built of a short row.
    Small files and large row groups would leave that step to one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism), *keys)


def ranges(lat: float, lng: float, metres: float, most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of cells (both ends included) that cover all points within a radius: quarters of
    the globe, those on the edge cut in four again, the largest first."""
    up, side = geo.reach(lat, metres)
    boxes = [(lng - side, lng + side)] + [(lng - side + turn, lng + side + turn) for turn in (-360, 360)]

    def touches(level: int, y: int, x: int) -> tuple[bool, bool]:
        """Whether a quarter meets the box, and whether it lies in it."""
        high, wide = 180 / (1 << level), 360 / (1 << level)
        low, left = -90 + y * high, -180 + x * wide
        meets = low <= lat + up and low + high >= lat - up and any(left <= b and left + wide >= a for a, b in boxes)
        return meets, low >= lat - up and low + high <= lat + up and any(left >= a and left + wide <= b for a, b in boxes)

    whole, edge = [], [(0, 0, 0)]
    while edge and edge[0][0] < BITS and len(whole) + len(edge) + 3 <= most:
        level, y, x = edge.pop(0)
        for part in ((level + 1, 2 * y + dy, 2 * x + dx) for dy in (0, 1) for dx in (0, 1)):
            meets, inside = touches(*part)
            if meets:
                (whole if inside else edge).append(part)

    def code(y: int, x: int) -> int:
        return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(BITS))

    found: list[tuple[int, int]] = []
    for level, y, x in sorted(whole + edge, key=lambda p: code(p[1] << BITS - p[0], p[2] << BITS - p[0])):
        first = code(y << BITS - level, x << BITS - level)
        last = first + (1 << 2 * (BITS - level)) - 1
        if found and found[-1][1] + 1 == first:
            found[-1] = (found[-1][0], last)
        else:
            found.append((first, last))
    return found


def in_ranges(column: Column, found: list[tuple[int, int]]) -> Column:
    """A condition that reaches the scan."""
    condition = F.lit(False)
    for first, last in found:
        condition = condition | column.between(first, last)
    return condition
