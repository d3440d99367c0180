"""Periodic runs of words, found through string synchronising sets.

A run is a maximal stretch whose smallest period q (in words) fits in it at least four times. For
periods from t to 2t - 1, t a power of two, a synchronising set picks positions by hashes of their t words: a
position stays if the least hash among it and the t positions behind it stands at one of both ends. The
choice depends on 2t words only, so within a run every chosen position is chosen again one period later, and
of any t neighbours one is chosen unless they repeat with a period of at most t / 4. The next chosen position with the same
2t words therefore proposes the period of each run:

- no smaller distance can lie between, as the 2t words would then make the run's period smaller;
- positions inside such highly periodic stretches have no hash of their own and are left out, which
  keeps the set small; their runs are known from smaller scales, where they were found.

Periods below the least scale are found separately, by comparing words at that distance. Proposals
are extended word by word in both directions, so hashes propose and never decide.

Texts of an Arrow batch are laid behind one another, divided by words that occur once, and all
steps but the extension run on whole arrays. A text is held whole, by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import BLANK_REGEX, text_of
from plazalake.llm.packed import mixed

#: A run has at least so many periods and words.
LEAST_EXPONENT, LEAST_WORDS = 4, 6
#: Smaller periods are found by direct comparison, larger ones at scales from here on.
LEAST_SCALE = 8
_NO_HASH = np.uint64((1 << 64) - 1)
_RUNS = "array<struct<start:long,length:long,period:long>>"

Runs = dict[int, tuple[np.ndarray, np.ndarray]]
"""By period: starts and ends of its runs, both ascending."""


def _inside(runs: Runs, start: np.ndarray, end: np.ndarray, period: int) -> np.ndarray:
    """Which stretches of a period lie in a run of a proper divisor of it, whose period they then have."""
    inside = np.zeros(len(start), bool)
    for q, (starts, ends) in runs.items():
        if q < period and period % q == 0:
            at = np.searchsorted(starts, start, "right") - 1
            inside |= (at >= 0) & (ends[np.maximum(at, 0)] >= end)
    return inside


def _least(period: int) -> int:
    return max(LEAST_WORDS, LEAST_EXPONENT * period)


def _small_periods(words: np.ndarray) -> Runs:
    runs: Runs = {}
    for q in range(1, min(LEAST_SCALE, len(words))):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], words[q:] == words[:-q], [False]]).astype(np.int8)))
        start, end = edges[::2], edges[1::2] + q
        long = end - start >= _least(q)
        start, end = start[long], end[long]
        primitive = ~_inside(runs, start, end, q)
        if primitive.any():
            runs[q] = start[primitive], end[primitive]
    return runs


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, _NO_HASH)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def synchronising_set(hashes: np.ndarray, scale: int, runs: Runs) -> np.ndarray:
    """The chosen positions; ``hashes`` are those of the ``scale`` words from each position on, ``runs``
    holds all runs of periods up to ``scale / 4``."""
    hashes = np.minimum(hashes, _NO_HASH - np.uint64(1))
    change = np.zeros(len(hashes) + 1, np.int64)
    for q, (starts, ends) in runs.items():
        if LEAST_EXPONENT * q <= scale:
            long = ends - starts >= scale
            np.add.at(change, starts[long], 1)
            np.add.at(change, ends[long] - scale + 1, -1)
    hashes[np.cumsum(change[:-1]) > 0] = _NO_HASH
    if len(hashes) <= scale:
        return np.empty(0, np.int64)
    least = _window_least(hashes, scale + 1)
    return np.flatnonzero((least != _NO_HASH) & ((least == hashes[:-scale]) | (least == hashes[scale:])))


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` in which words ``period`` apart are identical."""
    start, end, step = at, at + period, 64
    while end < len(words):
        differ = words[end : end + step] != words[end - period : end - period + min(step, len(words) - end)]
        if differ.any():
            end += int(np.argmax(differ))
            break
        end, step = end + len(differ), step * 2
    step = 64
    while start > 0:
        low = max(0, start - step)
        differ = words[low:start] != words[low + period : start + period]
        if differ.any():
            start = low + len(differ) - int(np.argmax(differ[::-1]))
            break
        start, step = low, step * 2
    return start, end


def _proposals(chosen: np.ndarray, context: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances (``scale`` to twice that) to the next chosen one with an equal context."""
    order = np.lexsort((chosen, context))
    at, same = chosen[order], context[order]
    gap = at[1:] - at[:-1]
    good = (same[1:] == same[:-1]) & (gap >= scale) & (gap < 2 * scale)
    at, gap = at[:-1][good], gap[good]
    order = np.lexsort((at, gap))
    return at[order], gap[order]


def runs_of(words: np.ndarray, longest: int) -> Runs:
    """All runs of ``words`` (ids), in which no stretch of over ``longest`` words can be one."""
    runs = _small_periods(words)
    hashes, width = mixed(words.astype(np.uint64) + np.uint64(1)), 1
    while LEAST_EXPONENT * max(width, LEAST_SCALE) <= longest and len(hashes) > width:
        doubled = mixed(hashes[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashes[width:])
        if width >= LEAST_SCALE:
            chosen = synchronising_set(hashes, width, runs)
            chosen = chosen[chosen < len(doubled)]
            found: dict[int, list[tuple[int, int]]] = {}
            for at, period in zip(*(v.tolist() for v in _proposals(chosen, doubled[chosen], width))):
                known = found.setdefault(period, [])
                if not known or at + period > known[-1][1]:  # else the last stretch of that period covers it
                    known.append(_extended(words, at, period))
            for period, stretches in sorted(found.items()):
                start, end = np.array(sorted(set(stretches)), np.int64).T
                good = end - start >= _least(period)
                good &= ~_inside(runs, start, end, period)
                if good.any():
                    runs[period] = start[good], end[good]
        hashes, width = doubled, 2 * width
    return runs


def _of_batch(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Runs (start, length, period) by start and period, and the collapsed text, of each text."""
    known: dict[bytes, int] = {}
    split = [text.split() for text in texts]
    sizes = np.array([len(words) for words in split])
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int(sizes.sum())
    words = np.empty(total + len(texts), np.int64)
    for i, (at, own) in enumerate(zip(starts, split)):
        words[at : at + len(own)] = [known.setdefault(word, len(known)) for word in own]
        words[at + len(own)] = -1 - i
    runs = runs_of(words, int(sizes.max(initial=0)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    change = np.zeros(len(words) + 1, np.int64)
    for period, (begin, end) in runs.items():
        of = np.searchsorted(starts, begin, "right") - 1
        for text, a, b in zip(of.tolist(), (begin - starts[of]).tolist(), (end - begin).tolist()):
            out[text].append((a, b, period))
        np.add.at(change, begin + period, 1)
        np.add.at(change, end, -1)
    dropped = np.cumsum(change[:-1]) > 0
    kept = []
    for at, own, found in zip(starts, split, out):
        if found:
            own = [word for word, gone in zip(own, dropped[at : at + len(own)]) if not gone]
            found.sort(key=lambda r: (r[0], r[2]))
        kept.append(b" ".join(own))
    return out, kept


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, runs (array of start, length, period, in words
    from 0, by start and period), collapsed (the words that stay, joined by one space).

    A run has a smallest period q, at least max(6, 4 q) words, and no neighbouring word that goes on
    with that period. A word goes if any run holds it after its first q words. Null, empty and blank
    texts have no runs and collapse to the empty text. Null and repeated doc_ids and rows repeated whole
    give a row each; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            runs, kept = _of_batch(batch.column(1).to_pylist())
            as_rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(as_rows, kind), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    given = docs.select("doc_id", text_of().cast("binary").alias("text"))
    return given.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, runs {_RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), where one doc_id in ten repeats words: with h the unsigned crc32 of the decimal
    doc_id (null: of the empty text), g = floor(h / 10), n words and h % 10 = 0, each word from a = g % n on becomes
    word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8))."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # words are counted and moved only where one in ten is chosen
    words = F.filter(F.split("text", BLANK_REGEX), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, words).alias("_words"))
    moved = F.expr(
        "transform(_words, (w, i) -> if(i < _a, w, element_at(_words, cast(_a + (i - _a) % _p + 1 AS int))))"
    )
    placed = chosen.selectExpr("*", "_h div 10 AS _g", "size(_words) AS _n").selectExpr("*", "if(_n > 0, _g % _n, 0) AS _a").selectExpr("*", "1 + (_n - _a) div (3 + _g % 8) AS _p")
    return placed.select("doc_id", F.when(F.col("_n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: doc_id, n_runs; start, length, period, exponent_milli of the run of greatest
    length / period (ties: smallest start, then period; four nulls without runs); runs_sha256, collapsed_sha256."""
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # runs ascend by start and period, so only a greater exponent takes over; compared as whole numbers
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", F.aggregate("runs", nothing, better))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
