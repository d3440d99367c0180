"""Substring dedup: words of passages that were seen before, found through fixed-block anchors.

Any 20 consecutive words contain one whole block of a grid of 10-word blocks, at whatever place the
passage starts. So non-overlapping reference blocks are indexed, every rolling 10-word window probes
the index, and a passage that occurs twice has a hit in each of its occurrences. Only around hits are
the 20-word windows made; asking for the first place of each extends the hits to the maximal repeats,
since the windows of a repeat overlap. Of equal windows, all but the first lose the words they cover.

Both questions go from chunks of documents to buckets of keys (``packed``): a chunk asks about each
distinct window once, with its count or its first place, so a passage that very many documents share
costs a bucket one entry per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import text_of
from plazalake.llm.packed import WORDS, Chunk, answered, ask, bucket_bits, chunks, rolling, shortened

WINDOW = 20
_PROBE, _FIRST = range(2)
_ANCHORED, _REPEATED = np.uint64(1), np.uint64(2)
#: Bits sent below the bucket. A false hit of a probe only makes windows that are then not equal.
_LOW = {_PROBE: 32, _FIRST: 64}
_FACTOR, _SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class _Texts:
    """The words of a chunk's documents one after the other, documents in order: doc_ids, a missing one
    last, then a hash of the text. Places are counted over all words."""

    def __init__(self, chunk: Chunk, bits: int, window: int, block: int):
        self.bits, self.window, self.block = bits, window, block
        ids = np.array([np.iinfo(np.int64).max if i is None else i for i in chunk.ids], np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        tags = np.array([xxhash.xxh32_intdigest(t) << 1 | (i is None) for t, i in zip(chunk.texts, chunk.ids)], np.uint64)
        self.order = np.lexsort((tags, ids))
        self.ids, self.tags = ids[self.order], tags[self.order]
        self.words = [chunk.texts[i].split() for i in self.order.tolist()]
        sizes = np.array([len(w) for w in self.words])
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.first = (np.cumsum(sizes) - sizes)[self.doc]  # where the document of a place begins, and ends
        self.end = np.cumsum(sizes)[self.doc]
        self.hashes = WORDS.of([x for w in self.words for x in w])

    def windows(self, width: int, *factors: int) -> tuple[np.ndarray, ...]:
        """Places where a window of ``width`` words starts, and its hashes."""
        at = np.flatnonzero(np.arange(len(self.doc)) + width <= self.end)
        return at, *(rolling(self.hashes, width, f)[at] for f in factors)

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The place of every probe and its place among the distinct ones; these and their marks."""
        at, key = self.windows(self.block, _FACTOR)
        distinct, place, count = np.unique(shortened(key, self.bits, _LOW[_PROBE]), return_inverse=True, return_counts=True)
        marks = np.where(count > 1, _REPEATED, np.uint64(0))
        marks[place[(at - self.first[at]) % self.block == 0]] |= _ANCHORED
        return at, place, distinct, marks

    def around(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place and two hashes of the windows that hold a hit, by hashes and then by place."""
        at, place, *_ = self.probes()
        found = at[hit[place] > 0]
        lowest, highest = np.maximum(found - (self.window - self.block), self.first[found]), np.minimum(found, self.end[found] - self.window)
        some = lowest <= highest
        edge = np.zeros(len(self.doc) + 1, np.int64)
        np.add.at(edge, lowest[some], 1)
        np.add.at(edge, highest[some] + 1, -1)
        at, one, two = self.windows(self.window, _FACTOR, _SECOND)
        held = np.cumsum(edge)[at] > 0
        at, one, two = at[held], one[held], two[held] >> np.uint64(32)
        by = _sorted(one, two)
        return at[by], one[by], two[by]

    def firsts(self, hit: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each distinct window around hits, and its first place in this chunk."""
        at, one, two = self.around(hit)
        new = _new(one, two)
        at = at[new]
        return [one[new], two[new], self.ids[self.doc[at]], self.tags[self.doc[at]], (at - self.first[at]).astype(np.uint64)]

    def late(self, hit: np.ndarray, ours: np.ndarray) -> list[np.ndarray]:
        """Starts of the windows that are not the first, by document. ``ours`` tells of each distinct
        window whether its first place in this chunk is the first of all."""
        at, one, two = self.around(hit)
        new = _new(one, two)
        group, leader = np.cumsum(new) - 1, at[new]
        leader = leader[group]
        same = lambda x: x[at] == x[leader]
        is_first = same(self.ids[self.doc]) & same(self.tags[self.doc]) & (at - self.first[at] == leader - self.first[leader]) & (ours[group] > 0)
        at = np.sort(at[~is_first])
        ends = np.searchsorted(self.doc[at], np.arange(len(self.words) + 1))
        start = at - self.first[at]
        return [start[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _sorted(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Stable order by both hashes. Sorting by the first one does, save where it is shared by chance."""
    by = np.argsort(one, kind="stable")
    chance = (one[by][1:] == one[by][:-1]) & (two[by][1:] != two[by][:-1])
    return np.lexsort((two, one)) if chance.any() else by


def _new(*names: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    return np.append(np.ones(min(len(names[0]), 1), bool), np.logical_or.reduce([n[1:] != n[:-1] for n in names]))


def _settle(kind: int, arrays: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """Probes: whether the block occurs again and one occurrence is on the grid. Windows: whether the
    entry holds the first place of all; rows repeated whole share it."""
    if kind == _PROBE:
        key, marks = arrays
        order = np.argsort(key, kind="stable")
        new = _new(key[order])
        first = np.flatnonzero(new)
        marks = marks[order]
        again = (np.diff(np.append(first, len(key))) > 1) | (np.bitwise_or.reduceat(marks & _REPEATED, first) > 0)
        of_row = (again & (np.bitwise_or.reduceat(marks & _ANCHORED, first) > 0))[np.cumsum(new) - 1]
    else:
        one, two, *place = arrays
        order = _sorted(one, two)
        new = _new(one[order], two[order])
        first, group, of_row = np.flatnonzero(new), np.cumsum(new) - 1, np.ones(len(order), bool)
        for part in place:  # doc_id, then text, then start: of those still alike the least stays
            part = np.where(of_row, part[order], np.iinfo(np.uint64).max)
            of_row &= part == np.minimum.reduceat(part, first)[group]
    reply = np.empty(len(order), np.uint64)
    reply[order] = of_row
    return reply, []


def _cut(words: list[bytes], starts: np.ndarray, window: int) -> tuple[int, int, str, str]:
    n = len(words)
    if len(starts):
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    kept = b" ".join(words)
    return n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 and
    kept_text (the kept words joined by one space).

    A word goes if a window of ``window`` words covers it whose words also start earlier: in a
    smaller doc_id, or earlier in the same document. Windows are judged on the input. Null, empty
    and short texts lose nothing. Rows repeated with one doc_id and text are one document: they get
    the same result. A null doc_id is last; of different texts under one doc_id either may be first.
    Windows are equal if 96 bits of two hashes of their words are. No rows give no rows; other
    columns are ignored. A very long text is one chunk: a task holds it whole.
    """
    if window < 3:
        raise ValueError("a window has 3 words at least")
    block = (window + 1) // 2
    stored = chunks(docs.select(F.col("doc_id").cast("long"), F.lit(0).alias("flag"), text_of().cast("binary").alias("text")))
    bits = bucket_bits(stored)
    texts = lambda chunk: _Texts(chunk, bits, window, block)
    none = np.empty(0, np.uint64)

    def probes(chunk: Chunk, _: dict) -> dict[int, list[np.ndarray]]:
        *_, distinct, marks = texts(chunk).probes()
        return {_PROBE: [distinct, marks]}

    def firsts(chunk: Chunk, known: dict) -> dict[int, list[np.ndarray]]:
        return {_FIRST: texts(chunk).firsts(known.get(_PROBE, none))}

    def answer(chunk: Chunk, known: dict) -> Iterator[pa.RecordBatch]:
        those = texts(chunk)
        late = those.late(known.get(_PROBE, none), known.get(_FIRST, none))
        n, removed, digest, kept = zip(*(_cut(words, starts, window) for words, starts in zip(those.words, late)))
        columns = [pa.array([chunk.ids[i] for i in those.order.tolist()], pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    hits = ask(stored, None, bits, probes, _settle, _LOW)
    places = ask(stored, hits, bits, firsts, _settle, _LOW)
    return answered(stored, hits.unionByName(places), bits, answer, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
