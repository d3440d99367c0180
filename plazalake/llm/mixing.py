"""Mixing sources to target weights by Pfair scheduling.

A source of weight w (shares add up to 1) owns blocks 1, 2, ... of documents. Block i is released at
slot floor((i-1)/w) and due by slot ceil(i/w). In each slot the released block with the earliest
deadline goes out, so in every prefix each source is within one block of its target. Weights are
taken as exact fractions: with whole weights that have no common factor the schedule repeats after
their sum, so only that cycle is laid out and a join numbers every block. Where the cycle is longer
than ``LONGEST_CYCLE``, one task lays out the blocks that exist, holding one block of each source.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice
from math import gcd, lcm

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import table

SLOTS = 1000
#: Rows of a cycle that the driver lays out.
LONGEST_CYCLE = 100_000
BLOCK_DOCS = 32
#: First hex digits of a document's hash that name a bucket; a source's rank is counted by bucket.
BUCKET_DIGITS = 3
NO_SOURCE = "(none)"


def shares(weights: Mapping[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Whole slots of a cycle by source, largest remainders first (ties by name), one at least."""
    total = sum(weights.values())
    if not weights or total <= 0 or min(weights.values()) <= 0 or len(weights) > slots:
        raise ValueError("weights must be positive, and fewer than the slots of a cycle")
    exact = {s: w * slots / total for s, w in weights.items()}
    given = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (given[s] - exact[s], s))
    at = 0
    while (left := slots - sum(given.values())) != 0:
        source = order[at % len(order)] if left > 0 else max(given, key=lambda s: (given[s] - exact[s], s))
        given[source] += 1 if left > 0 else -1
        at += 1
    return given


def whole(weights: Mapping[str, float]) -> dict[str, int]:
    """The weights, read as the decimals they print as, in whole numbers without a common factor."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    exact = {s: Fraction(repr(w)) for s, w in weights.items()}
    unit = lcm(*(x.denominator for x in exact.values()))
    found = {s: int(x * unit) for s, x in exact.items()}
    common = gcd(*found.values())
    return {s: n // common for s, n in found.items()}


def cycle(given: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, block of the source in this cycle, slot), all from 0, for one cycle."""
    slots = sum(given.values())
    waiting = [(0, -(-slots // n), s, 0) for s, n in given.items()]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready, out = [], []
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, deadline, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, source, block))
        _, source, block = heapq.heappop(ready)
        out.append((source, block, slot))
        if block + 1 < given[source]:
            n = given[source]
            heapq.heappush(waiting, ((block + 1) * slots // n, -(-(block + 2) * slots // n), source, block + 1))
    return out


def laid_out(given: Mapping[str, int], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int, bool]]:
    """(source, block, slot, in_target) of the ``blocks`` of each source, by slot. The first turn that
    finds a source run out stays empty; from there on such sources take no more turns."""
    slots = sum(given.values())
    waiting = [(0, -(-slots // n), s, 0) for s, n in given.items()]
    heapq.heapify(waiting)
    ready, slot, in_target = [], 0, True
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, deadline, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, source, block))
        _, source, block = heapq.heappop(ready)
        if block < blocks[source]:
            yield source, block, slot, in_target
            n = given[source]
            heapq.heappush(waiting, ((block + 1) * slots // n, -(-(block + 2) * slots // n), source, block + 1))
        else:
            in_target = False
        slot += 1


def mix(docs: DataFrame, weights: Mapping[str, float], default: float = 1.0, slots: int | None = None, block_docs: int = BLOCK_DOCS, seed: str = "mix", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source): doc_id, source, block, slot, place, in_target, and
    the columns named in ``keep``. Other columns are ignored, whatever their names; no rows give no rows.

    Within a source, documents follow the md5 of seed and doc_id, ``block_docs`` to a block. slot is
    the block's turn; place the document's place in its block; ordering by (slot, place) gives the
    mixture. in_target holds before the first slot whose source has run out: there every prefix
    keeps each source within one block of its weight. Later rows keep their order and are not
    dropped. Sources not named in ``weights`` get ``default``; a null source counts as ``(none)``.
    Repeated rows each take a place, ties in hash and doc_id falling in any order. With ``slots``
    the weights are first rounded to that many slots (``shares``), and the bound holds for those.
    """
    spark = docs.sparkSession
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    kept = F.struct(*(F.col(c) for c in keep)) if keep else F.lit(None)
    given = docs.select("doc_id", F.coalesce(F.col("source"), F.lit(NO_SOURCE)).alias("source"), digest.alias("_digest"), kept.alias("_kept"))
    wanted_columns = ["doc_id", "source", "block", "slot", "place", "in_target", *(F.col("_kept")[c].alias(c) for c in keep)]
    given = given.withColumn("_bucket", F.substring("_digest", 1, BUCKET_DIGITS))

    # counted by source and bucket: a hot source is dealt over all buckets
    sizes = table(given.groupBy("source", "_bucket").agg(F.count(F.lit(1)).alias("n")))
    totals = {r["source"]: r["n"] for r in sizes.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return given.select("*", *(F.lit(0).cast("long").alias(c) for c in ("block", "slot", "place")), F.lit(True).alias("in_target")).select(*wanted_columns)
    wanted = {s: float(weights.get(s, default)) for s in sorted(totals)}
    parts = shares(wanted, slots) if slots else whole(wanted)
    turns = sum(parts.values())
    before = F.sum("n").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("source", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("source", "_bucket").orderBy("_digest", F.col("doc_id").asc_nulls_first())) - 1
    ranked = given.withColumn("_within", within).join(offsets, ["source", "_bucket"])
    rank = F.col("_before") + F.col("_within")
    blocks = ranked.select("doc_id", "source", "_kept", F.floor(rank / block_docs).cast("long").alias("block"), (rank % block_docs).cast("long").alias("place"))

    if turns > LONGEST_CYCLE:
        ends = {s: -(-n // block_docs) for s, n in totals.items()}

        def run(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = laid_out(parts, ends)
            while some := list(islice(rows, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some)], ["source", "block", "slot", "in_target"])

        order = table(spark.range(0, 1, 1, 1).mapInArrow(run, "source string, block long, slot long, in_target boolean"))
        return blocks.join(order, ["source", "block"]).select(*wanted_columns)

    plan = cycle(parts)
    blocks_of = {s: [] for s in parts}
    for source, _, slot in plan:
        blocks_of[source].append(slot)

    def slot_of(source: str, block: int) -> int:
        turn, at = divmod(block, parts[source])
        return turn * turns + blocks_of[source][at]

    horizon = min(slot_of(s, -(-n // block_docs)) for s, n in totals.items())
    schedule = spark.createDataFrame([(s, parts[s], b, slot) for s, b, slot in plan], "source string, _share long, _at long, _slot long")
    numbered = blocks.alias("d").join(
        F.broadcast(spark.createDataFrame([(s, n) for s, n in parts.items()], "source string, _share long")), "source"
    ).withColumn("_at", F.col("block") % F.col("_share"))
    # the schedule has at most LONGEST_CYCLE rows, or as many as `slots` says
    placed = numbered.join(F.broadcast(schedule.drop("_share")), ["source", "_at"])
    slot = F.floor(F.col("block") / F.col("_share")) * turns + F.col("_slot")
    return placed.withColumn("slot", slot.cast("long")).withColumn("in_target", F.col("slot") < horizon).select(*wanted_columns)
