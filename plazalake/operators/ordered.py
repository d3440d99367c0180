"""Running values over ordered groups of any size: two-level prefix scans.

Rows are sorted over all tasks by group and order, and cut into stretches of bounded length. A window inside
each stretch gives its own running values; a row for each group and stretch sums it up, a window over these
rows gives what came before the stretch, and both meet again. So no task orders a whole group, however much
of the input it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.sources.scratch import stored

#: The most rows of a stretch, as a power of two; groups of up to so many rows are left to a plain window.
STRETCH_BITS = 16


def running(df: DataFrame, group: str, order: Sequence[str], sums: Mapping[str, Column] = {}, maxima: Mapping[str, Column] = {}, previous: Mapping[str, Column] = {}) -> DataFrame:
    """``df`` with running values along ``order`` (total within a group) in each group: ``sums`` and ``maxima`` up to and with
    the row (nulls count as nothing), and ``previous``, the value of the row before, null for the first. A null
    group is a group of its own."""
    values = {**sums, **maxima, **previous}
    given = df.withColumns({f"_v_{name}": value for name, value in values.items()})

    def scanned(rows: DataFrame, by: Sequence[str], along: Sequence[str], start: Mapping[str, Column]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*along)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = {n: F.coalesce(F.sum(f"_v_{n}").over(upto), F.lit(0)) + start.get(n, F.lit(0)) for n in sums}
        out |= {n: F.greatest(F.max(f"_v_{n}").over(upto), start.get(n, F.lit(None))) for n in maxima}
        for n in previous:
            before = F.lag(f"_v_{n}").over(w)
            out[n] = F.when(F.row_number().over(w) == 1, start[n]).otherwise(before) if n in start else before
        return rows.withColumns(out).select(*df.columns, *values)

    most = given.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if most <= 1 << STRETCH_BITS:
        return scanned(given, [group], order, {})

    # the number holds the partition above its 33rd bit, so it ascends along group and order
    at = stored(given.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id()))
    cut = at.withColumn("_stretch", F.shiftright("_at", STRETCH_BITS))
    ends = [F.sum(f"_v_{n}").alias(f"_c_{n}") for n in sums] + [F.max(f"_v_{n}").alias(f"_c_{n}") for n in maxima] + [F.max_by(f"_v_{n}", "_at").alias(f"_c_{n}") for n in previous]
    parts = cut.groupBy(group, "_stretch").agg(*ends)
    w = Window.partitionBy(group).orderBy("_stretch")
    ahead = w.rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"_c_{n}": F.coalesce(F.sum(f"_c_{n}").over(ahead), F.lit(0)) for n in sums} | {f"_c_{n}": F.max(f"_c_{n}").over(ahead) for n in maxima} | {f"_c_{n}": F.lag(f"_c_{n}").over(w) for n in previous}
    parts = parts.withColumns(carried).withColumnsRenamed({group: "_group", "_stretch": "_of"})
    met = cut.join(parts, (F.col("_stretch") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return scanned(met, [group, "_stretch"], ["_at"], {n: F.col(f"_c_{n}") for n in values})
