"""Near duplicates by SimHash over word shingles.

A fingerprint is one or more 64-bit words, seen as positional bytes. An inverted index holds, for a few
positions and their bytes, the fingerprints that share them; pairs are tallied by shared positional
bytes and verified on all bits where they meet, and only a forest of links, closest first, leaves a list.

- ``near_duplicates``: 64 bits, radius 4. Fingerprints within 4 bits differ in at most 4 of 8 bytes, so
  they share 4 at least: lists are kept by every choice of 4 positions, and no pair is lost.
- ``drop_near_duplicates``: texts with a similarity of five-word shingles of 0.8 or more. 256 bits tell
  such texts apart from others, at a distance up to ``WIDE_RADIUS``, which is too many bits for a
  guaranteed match; lists are kept for 64 pairs of positions, of which such texts share one with a
  probability of 0.97 at a similarity of 0.8 (more above). Links are then verified on the shingles.

A list longer than ``LONG_LIST`` (a crowd of texts that differ slightly) is cut into blocks, and each two
blocks are paired in a task of their own: that is exact, and no task holds the list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import numbered, table
from plazalake.llm.components import stars
from plazalake.llm.packed import WORDS, mixed, rolling

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Shingle, words of a fingerprint and radius of the search for similar texts.
WIDE_SHINGLE, WIDE_WORDS, WIDE_RADIUS, SIMILARITY = 5, 4, 56, 0.8
LONG_LIST, BLOCK, SALTS = 2048, 1024, 32
_FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
Words = tuple[np.ndarray, ...]


def majority(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the 64-bit hashes have it."""
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of UTF-8 text: A-Z lower-cased, words, ``shingle``-word shingles with repeats. Fewer
    words make one shingle; no word gives zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())]
    return majority(np.array(hashes, np.uint64))


def shingles(text: bytes | None, shingle: int) -> np.ndarray:
    """Distinct hashes of the shingles; fewer words make one shingle, no word makes none."""
    words = WORDS.of((text or b"").lower().split())
    return np.unique(rolling(words, min(shingle, len(words)))) if len(words) else words


def wide_fingerprint(hashes: np.ndarray) -> list[int]:
    return [majority(mixed(hashes * f)) if len(hashes) else 0 for f in _FACTORS[:WIDE_WORDS]]


def positions(n_bytes: int, pairs: int) -> list[tuple[int, ...]]:
    """Pairs of byte positions, each position in as many as any other."""
    return [(i, (i + step) % n_bytes) for step in range(1, n_bytes // 2) for i in range(n_bytes)][:pairs]


EXACT_KEYS = list(combinations(range(8), 8 - RADIUS))
WIDE_KEYS = positions(8 * WIDE_WORDS, 64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, f0) of every row; f0 is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "f0"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, f0 long")


def _names(words: int) -> list[str]:
    return [f"f{i}" for i in range(words)]


def _postings(keys: Sequence[tuple[int, ...]], words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, *prints = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            octets = np.stack([p.view(np.uint8).reshape(-1, 8) for p in prints], 1).reshape(len(ids), -1).astype(np.int64)
            found = []
            for i, places in enumerate(keys):
                key = np.full(len(ids), i, np.int64)
                for p in places:
                    key = key << 8 | octets[:, p]
                found.append(key)
            columns = [np.concatenate(found), *(np.tile(c, len(keys)) for c in (ids, *prints))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "id", *_names(words)])

    return run


def near_pairs(keys: np.ndarray, prints: Words, radius: int, least_shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs within the lists of a slice sorted by key, by place, and their distances: those whose tally
    of shared positional bytes is high enough and that lie within ``radius`` bits."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    left = np.repeat(starts + sizes, sizes) - np.arange(len(keys)) - 1  # rows after this one in its list
    rows, step, found = np.flatnonzero(left > 0), 1, []
    while len(rows):
        differ = [p[rows] ^ p[rows + step] for p in prints]
        tally = sum((d.view(np.uint8).reshape(-1, 8) == 0).sum(1) for d in differ)
        distance = sum(np.bitwise_count(d).astype(np.int64) for d in differ)
        near = (tally >= least_shared) & (distance <= radius)
        found.append((rows[near], rows[near] + step, distance[near]))
        step += 1
        rows = rows[left[rows] >= step]
    return tuple(map(np.concatenate, zip(*found))) if found else (np.empty(0, np.int64),) * 3


def forest(a: np.ndarray, b: np.ndarray, distance: np.ndarray, n: int) -> np.ndarray:
    """Places of the pairs that make a minimum spanning forest: whatever two parts of a list are joined
    by pairs are joined by their closest one. Each round joins every part to its nearest other part."""
    rank, label, kept = np.empty(len(a), np.int64), np.arange(n), []
    order = np.argsort(distance, kind="stable")
    rank[order] = np.arange(len(a))
    while True:
        one, two = label[a], label[b]
        cross = one != two
        a, b, rank, one, two = a[cross], b[cross], rank[cross], one[cross], two[cross]
        if not len(a):
            return order[np.concatenate(kept)] if kept else np.empty(0, np.int64)
        best = np.full(n, len(order), np.int64)
        np.minimum.at(best, one, rank)
        np.minimum.at(best, two, rank)
        chosen = np.unique(best[best < len(order)])
        kept.append(chosen)
        at = np.searchsorted(chosen, rank)
        at = np.flatnonzero(chosen[np.minimum(at, len(chosen) - 1)] == rank)
        while True:  # the parts joined take their least label
            before = label.copy()
            np.minimum.at(label, one[at], label[two[at]])
            np.minimum.at(label, two[at], label[one[at]])
            label = label[label]
            if np.array_equal(before, label):
                break


def _links(keys: np.ndarray, ids: np.ndarray, prints: Words, radius: int, least_shared: int) -> tuple[np.ndarray, np.ndarray]:
    a, b, distance = near_pairs(keys, prints, radius, least_shared)
    at = forest(a, b, distance, len(keys))
    one, two = ids[a[at]], ids[b[at]]
    return np.minimum(one, two), np.maximum(one, two)


def _scan(words: int, radius: int, least_shared: int, long_list: int):
    """Postings arrive sorted by key; at most one short list is carried from batch to batch. Gives the
    links of short lists (a, b), and the postings of long ones with their block."""
    names = ["a", "b", "block", "key", "id", *_names(words)]

    def batch_of(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c]) if c in columns else pa.nulls(n, pa.int64()) for c in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * (2 + words)
        long_key, seen = None, 0

        def crowd(rows: list[np.ndarray], before: int) -> pa.RecordBatch:
            return batch_of({"block": (before + np.arange(len(rows[0]))) // BLOCK, **dict(zip(names[3:], rows))})

        def lists(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if not len(rows[0]):
                return
            starts = np.flatnonzero(np.append(True, rows[0][1:] != rows[0][:-1]))
            sizes = np.diff(np.append(starts, len(rows[0])))
            for at in np.flatnonzero(sizes > long_list):
                yield crowd([c[starts[at] : starts[at] + sizes[at]] for c in rows], 0)
            size = np.repeat(sizes, sizes)
            usable = (size > 1) & (size <= long_list)
            if usable.any():
                keys, ids, *prints = (c[usable] for c in rows)
                one, two = _links(keys, ids, tuple(p.view(np.uint64) for p in prints), radius, least_shared)
                yield batch_of({"a": one, "b": two})

        for batch in batches:
            held = [np.append(h, c.to_numpy(zero_copy_only=False)) for h, c in zip(held, batch.columns)]
            if long_key is not None and (same := int(np.searchsorted(held[0], long_key, "right"))):
                yield crowd([c[:same] for c in held], seen)
                seen += same
                held = [c[same:] for c in held]
            if not len(held[0]):
                continue
            cut = int(np.searchsorted(held[0], held[0][-1], "left"))
            if cut and cut >= len(held[0]) // 2:
                yield from lists([c[:cut] for c in held])
                held = [c[cut:] for c in held]
            if len(held[0]) > long_list and held[0][0] == held[0][-1]:
                yield crowd(held, 0)
                long_key, seen = int(held[0][0]), len(held[0])
                held = [c[:0] for c in held]
        yield from lists(held)

    return run


def _cells(words: int, radius: int, least_shared: int):
    """Two blocks of a crowded list at a time, sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * (4 + words)

        def done(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(rows[0]):
                new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in rows[:3]]))
                one, two = _links(np.cumsum(new), rows[3], tuple(p.view(np.uint64) for p in rows[4:]), radius, least_shared)
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["a", "b"])

        for batch in batches:
            held = [np.append(h, c.to_numpy(zero_copy_only=False)) for h, c in zip(held, batch.columns)]
            same = np.logical_and.reduce([c == c[-1] for c in held[:3]]) if len(held[0]) else np.empty(0, bool)
            cut = int(np.argmax(same)) if len(same) else 0
            yield from done([c[:cut] for c in held])
            held = [c[cut:] for c in held]
        yield from done(held)

    return run


def near_links(nodes: DataFrame, keys: Sequence[tuple[int, ...]], radius: int, least_shared: int, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b) between ``nodes`` (id and f0, f1, ... of distinct fingerprints, all long): a spanning
    forest, closest first, of the near pairs of every list."""
    names = nodes.columns
    words = len(names) - 1
    longs = lambda *columns: ", ".join(f"{c} long" for c in columns)
    postings = nodes.mapInArrow(_postings(keys, words), longs("key", *names)).repartition("key").sortWithinPartitions("key")
    found = table(postings.mapInArrow(_scan(words, radius, least_shared, long_list), longs("a", "b", "block", "key", *names)))
    crowd = found.filter("a IS NULL")
    blocks = crowd.groupBy("key").agg((F.max("block") + 1).alias("_n"))
    each = crowd.join(blocks, "key").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).filter("_other <> block")
    cells = each.select("key", F.least("block", "_other").alias("_p"), F.greatest("block", "_other").alias("_q"), *names)
    paired = cells.repartition("key", "_p", "_q").sortWithinPartitions("key", "_p", "_q").mapInArrow(_cells(words, radius, least_shared), longs("a", "b"))
    return found.filter("a IS NOT NULL").select("a", "b").union(paired).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 lowercase hex digits),
    component_id (the smallest doc_id reachable over links of ``RADIUS`` bits, itself included).

    Null and wordless texts have fingerprint zero, which links like any other; so do texts of fewer
    words than a shingle. Rows repeated with one doc_id give one row each. A null doc_id never is a
    component_id unless its component has no other. Copies are one node here: they are never paired.
    No rows give no rows; other columns are ignored.
    """
    prints = table(fingerprints(docs, shingle))
    nodes = prints.groupBy("f0").agg(F.min("doc_id").alias("first")).withColumn("id", F.col("f0"))
    classes = _classes(nodes.select("id", "first"), near_links(nodes.select("id", "f0"), EXACT_KEYS, RADIUS, 8 - RADIUS))
    named = classes.select(F.col("id").alias("f0"), F.col("first").alias("component_id"))
    return prints.join(named, "f0").select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def _classes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, first) of every node: the least ``first`` of its component."""
    points = stars(links)
    least = nodes.join(points.withColumnRenamed("node", "id"), "id").groupBy("root").agg(F.min("first").alias("least"))
    heads = nodes.join(least.withColumnRenamed("root", "id"), "id").select(F.col("id").alias("root"), F.least("first", "least").alias("head"))
    # a root may have any number of points: they are dealt over SALTS tasks, and its head goes to each
    dealt = points.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    spread = heads.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    members = dealt.join(spread, ["root", "_salt"]).select(F.col("node").alias("id"), "head").union(heads)
    # a table, so that joins with it deal both sides anew and Spark can split a hot fingerprint
    return table(nodes.join(members, "id", "left").select("id", F.coalesce("head", "first").alias("first")))


def _sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """(row, f0, f1, ...) of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([wide_fingerprint(shingles(t, shingle)) for t in batch.column(1).to_pylist()], np.uint64).reshape(-1, WIDE_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in prints.T)], ["row", *_names(WIDE_WORDS)])

    return rows.select("row", F.col("text").cast("binary")).mapInArrow(run, "row long, " + ", ".join(f"{n} long" for n in _names(WIDE_WORDS)))


def _verified(links: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The links (a, b) of ``rows`` (row, text) whose shingles, repeats aside, are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, shingle).view(np.int64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["row", "hashes"])

    named = links.select(F.col("a").alias("row")).union(links.select(F.col("b").alias("row"))).distinct()
    some = rows.join(named, "row", "left_semi").select("row", F.col("text").cast("binary"))
    hashes = table(some.mapInArrow(run, "row long, hashes array<long>"))
    side = lambda end: hashes.select(F.col("row").alias(end), F.col("hashes").alias(f"_{end}"))
    both = links.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("_a", "_b"))
    every = F.size("_a") + F.size("_b") - common
    return both.filter(common >= (similarity - 1e-12) * every).select("a", "b")


def drop_near_duplicates(docs: DataFrame, shingle: int = WIDE_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of ``docs``, with all its columns: the one of the smallest doc_id (a null
    one only if there is no other), any of several such rows. A group is what chains of links join;
    texts are linked if their distinct ``shingle``-word shingles (A-Z in lower case) have a Jaccard
    similarity of ``similarity`` or more. Texts of fewer words are one shingle; null and wordless texts
    are alike. No text without such a partner goes; the share of links found is in the README.
    Rows are told apart by number, so null and repeated doc_ids take nothing else along. No rows give
    no rows.
    """
    given, row = numbered(docs)
    rows = given.select(F.col(row).alias("row"), "text")
    ids = given.select(F.col(row).alias("row"), F.col("doc_id").isNull().alias("none"), "doc_id")
    words = _names(WIDE_WORDS)
    prints = table(_sketches(rows, shingle).join(ids, "row"))
    # texts of one fingerprint are one node, named by its first row
    nodes = table(prints.groupBy(*words).agg(F.min(F.struct("none", "doc_id", "row")).alias("first")).select(F.col("first.row").alias("id"), *words, "first"))
    links = table(near_links(nodes.select("id", *words), WIDE_KEYS, WIDE_RADIUS, len(WIDE_KEYS[0])))
    classes = _classes(nodes.select("id", "first"), _verified(links, rows, shingle, similarity))
    firsts = nodes.select("id", *words).join(classes, "id").select(*words, F.col("first.row").alias("_first"))
    dropped = prints.join(firsts, words).filter("row <> _first").select(F.col("row").alias(row))
    return given.join(dropped, row, "left_anti").select(*docs.columns)
