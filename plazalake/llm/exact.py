"""Exact duplicates through counting quotient filters.

Each partition counts 64-bit text fingerprints and stores them as counting quotient filters: the
high bits of a fingerprint (block, then quotient) are given by position, only the remainder is
stored. Filters keep whole fingerprints, so they merge without loss by sorted remainders whatever
quotient width each one has. Fingerprints counted more than once are routed to byte verification:
the routed rows are grouped by the text itself. Fingerprints alone never decide.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import BLANK_REGEX, numbered, table, text_of

#: The fewest high fingerprint bits that name a block, the unit in which filters are shuffled and merged.
BLOCK_BITS = 10
#: Rows for which a block is meant, as a power of two; more rows make more blocks, so a merge stays as small.
BLOCK_ROW_BITS = 20
#: Fingerprints that a partition gathers before it writes its filters.
GATHER = 1_000_000


def block_bits(rows: int) -> int:
    """Bits that name a block for so many rows."""
    return max(BLOCK_BITS, (rows >> BLOCK_ROW_BITS).bit_length())


def normalised(column: str = "text") -> Column:
    """Every run of blanks as one space; null as empty."""
    return F.regexp_replace(text_of(column), BLANK_REGEX, " ")


def encode_filter(keys: np.ndarray, counts: np.ndarray, key_bits: int = 64 - BLOCK_BITS) -> bytes:
    """Sorted distinct keys of ``key_bits`` (fingerprints without their block) and counts as one filter:
    occupied bits by quotient, run-end bits by slot, remainders by slot, counters of slots above one."""
    quotient_bits = max(1, int(len(keys) - 1).bit_length())
    remainder_bits = key_bits - quotient_bits
    quotients = (keys >> np.uint64(remainder_bits)).astype(np.int64)
    remainders = keys & np.uint64((1 << remainder_bits) - 1)
    occupied = np.zeros(1 << quotient_bits, np.uint8)
    occupied[quotients] = 1
    run_ends = np.append(quotients[1:] != quotients[:-1], True).astype(np.uint8)
    width = (remainder_bits + 7) // 8
    above = np.flatnonzero(counts > 1)
    return b"".join((
        struct.pack("<IBBI", len(keys), quotient_bits, remainder_bits, len(above)),
        np.packbits(occupied).tobytes(),
        np.packbits(run_ends).tobytes(),
        remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
        above.astype("<u4").tobytes(),
        counts[above].astype("<u8").tobytes(),
    ))


def decode_filter(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys and counts that ``encode_filter`` stored."""
    n, quotient_bits, remainder_bits, n_above = struct.unpack_from("<IBBI", data)
    width, at = (remainder_bits + 7) // 8, struct.calcsize("<IBBI")

    def take(size: int) -> np.ndarray:
        nonlocal at
        part, at = np.frombuffer(data, np.uint8, size, at), at + size
        return part

    occupied = np.flatnonzero(np.unpackbits(take(((1 << quotient_bits) + 7) // 8), count=1 << quotient_bits))
    run_ends = np.unpackbits(take((n + 7) // 8), count=n).astype(np.int64)
    runs = np.cumsum(run_ends) - run_ends
    padded = np.zeros((n, 8), np.uint8)
    padded[:, :width] = take(n * width).reshape(n, width)
    keys = occupied[runs].astype(np.uint64) << np.uint64(remainder_bits) | padded.view("<u8").ravel()
    counts = np.ones(n, np.int64)
    above = take(n_above * 4).view("<u4")
    counts[above] = take(n_above * 8).view("<u8")
    return keys, counts


def merge_filters(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Merge by sorted remainders; counts of equal fingerprints add up."""
    parts = [decode_filter(f) for f in filters]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts, starts)


def _build(batches: Iterator[pa.RecordBatch], key_bits: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        blocks = (keys >> np.uint64(key_bits)).astype(np.int32)
        starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        rest = keys & np.uint64((1 << key_bits) - 1)
        ends = np.append(starts[1:], len(keys))
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks[starts]), pa.array([encode_filter(rest[a:b], counts[a:b], key_bits) for a, b in zip(starts, ends)], pa.binary())],
            ["block", "filter"],
        )

    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += batch.num_rows
        if size >= GATHER:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def _merge(batches: Iterator[pa.RecordBatch], key_bits: int) -> Iterator[pa.RecordBatch]:
    """Filters arrive sorted by block; one block is held at a time."""

    def flush(block: int, filters: list[bytes]) -> pa.RecordBatch:
        keys, counts = merge_filters(filters)
        more = counts > 1
        full = (keys[more] | np.uint64(block) << np.uint64(key_bits)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(full), pa.array(counts[more])], ["fp", "copies"])

    block, held = None, []
    for batch in batches:
        for b, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if b != block and held:
                yield flush(block, held)
                held = []
            block = b
            held.append(f)
    if held:
        yield flush(block, held)


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(fp, copies) of the values of the one long column that occur more than once. Their rows are counted
    first, as the number of blocks follows it."""
    key_bits = 64 - block_bits(fingerprints.count())
    filters = fingerprints.mapInArrow(partial(_build, key_bits=key_bits), "block int, filter binary")
    return filters.repartition("block").sortWithinPartitions("block").mapInArrow(partial(_merge, key_bits=key_bits), "fp long, copies long")


def _groups(base: DataFrame, first: Column) -> DataFrame:
    """(text_sha256, first, size) of the texts that occur more than once in ``base`` (norm)."""
    keyed = base.withColumn("fp", F.xxhash64("norm"))
    # stored, so that Spark knows its size: a small table goes to the texts, and only for a large one are texts dealt anew
    routed = keyed.join(table(repeated_fingerprints(keyed.select("fp"))), "fp", "left_semi")
    found = routed.groupBy("norm").agg(first.alias("first"), F.count(F.lit(1)).alias("size"))
    return found.filter("size > 1").select(F.sha2("norm", 256).alias("text_sha256"), "first", "size")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical once every run of blanks is one space. A null text counts as
    empty, and empty texts are equal to one another. The smallest doc_id of a group stays; a null
    doc_id stays only if all of the group are null. Rows repeated with one doc_id count towards
    group_size and share that doc_id's ``kept``. Other columns are ignored.
    """
    base = docs.select("doc_id", normalised().alias("norm"))
    groups = _groups(base, F.min("doc_id")).withColumnRenamed("first", "first_id")
    rows = base.select("doc_id", F.sha2("norm", 256).alias("text_sha256"))
    joined = rows.join(groups, "text_sha256", "left")
    keep_id = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each text of ``docs``, with all its columns: the one of the smallest doc_id (a null
    one only if there is no other), any of several such rows. Rows are told apart by number, so null
    and repeated doc_ids take nothing else along."""
    given, row = numbered(docs)
    base = given.select(F.col(row).alias("row"), "doc_id", normalised().alias("norm"))
    groups = _groups(base, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")))
    rows = base.select("row", F.sha2("norm", 256).alias("text_sha256"))
    dropped = rows.join(groups, "text_sha256").filter("row <> first.row").select(F.col("row").alias(row))
    return given.join(dropped, row, "left_anti").select(*docs.columns)
