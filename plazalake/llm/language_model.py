"""Language-model scores by a weighted backoff automaton.

States are the contexts of the training texts: two words, one word (or the start of a text), and below
them the root. A state has an arc for each word seen after it, and a failure arc to the state of the
shorter context. Weights are log10 of Dirichlet-smoothed probabilities,

    p(w | h) = (c(h w) + K p(w | h')) / (c(h) + K),    failure of h: K / (c(h) + K),

so that arcs and what failures lead to add up to one in every state; the root's arcs carry the smoothed
word probability, with one share for words never seen. A text is read once from left to right: in each
state a word takes its arc, or the state fails and adds its failure weight until an arc is there; the
arc leads to the longest context that is a state.

The automaton grows with the corpus, so it is never gathered: chunks of texts ask for the counts of
their own words and runs of two and three words (``packed``), which is all the automaton that the walk
of these texts can touch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import fold, text_of
from plazalake.llm.packed import WORDS, Chunk, answered, ask, bucket_bits, chunks, mixed, shortened

SMOOTHING = 0.1
#: Weight of the shorter context against one and two words: in counts of the longer one.
ONE_WORD, TWO_WORDS = 500.0, 4.0
FOLDS = 10
_START, _END = (np.uint64(xxhash.xxh64_intdigest(x, 7)) for x in (b"start of text", b"end of text"))
_WORDS, _RUNS = range(2)
#: Bits sent below the bucket. A word has a second hash beside them, 76 bits at least in all; of runs
#: about two in 100,000 share their name with another one, at any size of the corpus.
_LOW, _CHECK_BITS = {_WORDS: 40, _RUNS: 36}, 32
_NO_ARC = 1.0  # no logarithm of a probability
_PAIR, _TRIPLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Steps:
    """The steps of a chunk's texts, one after the other: the word of each, and the run of two and of
    three words that it ends, as places among the chunk's distinct words and runs."""

    def __init__(self, chunk: Chunk, bits: int):
        words = [t.lower().split() for t in chunk.texts]
        self.sizes = np.array([len(w) + 1 for w in words])
        first = np.cumsum(self.sizes) - self.sizes
        hashes = np.full(int(self.sizes.sum()), _END)
        for at, w in zip(first.tolist(), words):
            hashes[at : at + len(w)] = WORDS.of(w)
        before = np.append(_START, hashes[:-1])
        before[first] = _START
        pairs = mixed(before * _PAIR + hashes)
        self.deep = np.ones(len(hashes), bool)  # whether two words, or the start and a word, stand before
        self.deep[first] = False
        triples = mixed(pairs[:-1] * _TRIPLE + hashes[1:])[self.deep[1:]]
        full, self.spelled_at, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.spelled, self.words = words, shortened(full, bits, _LOW[_WORDS])
        self.runs, places = np.unique(shortened(np.concatenate([pairs, triples]), bits, _LOW[_RUNS]), return_inverse=True)
        self.pair, self.triple = places[: len(pairs)], np.zeros(len(pairs), np.int64)
        self.triple[self.deep] = places[len(pairs) :]
        self.trains = np.repeat(np.array([f == 0 for f in chunk.flags], bool), self.sizes)

    def asked(self) -> dict[int, list[np.ndarray]]:
        """Distinct words (by two hashes) and runs, with their counts in training texts."""
        of = lambda places, n: np.bincount(places, minlength=n).astype(np.uint64)
        spelled = [x for w in self.spelled for x in (*w, b"")]  # no word is empty: that is the end
        checks = np.array([xxhash.xxh64_intdigest(spelled[i], 1) for i in self.spelled_at.tolist()], np.uint64) >> np.uint64(64 - _CHECK_BITS)
        runs = np.concatenate([self.pair[self.trains], self.triple[self.trains & self.deep]])
        return {_WORDS: [self.words, checks, of(self.word[self.trains], len(self.words))], _RUNS: [self.runs, of(runs, len(self.runs))]}


def _settle(kind: int, arrays: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """The counts of a bucket's keys over all chunks; the sums are distinct words and their count."""
    *names, counts = arrays
    order = np.lexsort(names[::-1])
    new = np.append(True, np.logical_or.reduce([n[order][1:] != n[order][:-1] for n in names]))
    totals = np.add.reduceat(counts[order], np.flatnonzero(new))
    reply = np.empty(len(counts), np.uint64)
    reply[order] = totals[np.cumsum(new) - 1]
    return reply, [int((totals > 0).sum()), int(totals.sum())] if kind == _WORDS else [0, 0]


def _walk(steps: Iterable[tuple[float, float, float, float, float, int]]) -> float:
    """One text from left to right. For each step: its arc from two words and their failure, its arc
    from one word and its failure, its arc at the root, and the depth of the state it leads to."""
    depth, total = 1, 0.0  # the start of a text is a context of one
    for two, two_fails, one, one_fails, none, leads_to in steps:
        if depth == 2 and two == _NO_ARC:
            total, depth = total + two_fails, 1
        if depth == 1 and one == _NO_ARC:
            total, depth = total + one_fails, 0
        total += (none, one, two)[depth]
        depth = leads_to
    return total


def _scores(steps: _Steps, words: np.ndarray, runs: np.ndarray, types: int, total: int, texts: int) -> tuple[np.ndarray, list[float], np.ndarray]:
    """(base score, score, known words) of each text, given the counts of the chunk's words and runs."""
    c1, c2, c3 = words[steps.word], runs[steps.pair], np.where(steps.deep, runs[steps.triple], 0)
    first = np.cumsum(steps.sizes) - steps.sizes
    one, two = np.append(texts, c1[:-1]), np.append(0, c2[:-1])  # how often the words before were a context
    one[first], two[first] = texts, 0
    p1 = (c1 + SMOOTHING) / (total + SMOOTHING * (types + 1))
    p2 = (c2 + ONE_WORD * p1) / (one + ONE_WORD)
    p3 = (c3 + TWO_WORDS * p2) / (two + TWO_WORDS)
    arc = lambda p, c: np.where(c > 0, np.log10(p), _NO_ARC)
    root = np.log10(p1)
    columns = (
        arc(p3, c3), np.log10(TWO_WORDS / (two + TWO_WORDS)), arc(p2, c2), np.log10(ONE_WORD / (one + ONE_WORD)), root, np.where(c2 > 0, 2, np.where(c1 > 0, 1, 0)),
    )
    scores = [_walk(zip(*(c[a : a + n].tolist() for c in columns))) for a, n in zip(first.tolist(), steps.sizes.tolist())]
    return np.add.reduceat(root, first), scores, np.add.reduceat((c1 > 0).astype(np.int64), first)


def score_texts(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities).

    Training texts are those whose crc32(doc_id as text) mod ``folds`` is not 0. Words have A-Z in
    lower case; one end token closes each text. Null counts as empty: its only token is the end.
    A null doc_id has the fold of an empty text. Repeated rows give one row each, and each counts
    in training. With nothing to train on all probabilities are the smoothed base, which is one.
    Other columns are ignored. A very long text is one chunk: a task holds it whole.
    """
    stored = chunks(docs.select(F.col("doc_id").cast("long"), (fold("doc_id", folds) == 0).cast("int").alias("flag"), text_of().cast("binary").alias("text")))
    bits = bucket_bits(stored)
    replies = ask(stored, None, bits, lambda chunk, _: _Steps(chunk, bits).asked(), _settle, _LOW)
    sums = replies.filter("sums IS NOT NULL").agg(F.coalesce(F.sum(F.col("sums")[0]), F.lit(0)), F.coalesce(F.sum(F.col("sums")[1]), F.lit(0))).first()
    return answered(stored, replies, bits, partial(_answer, bits, *sums), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _answer(bits: int, types: int, total: int, chunk: Chunk, known: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    steps = _Steps(chunk, bits)
    words, runs = (known[k].astype(np.int64) for k in (_WORDS, _RUNS))
    texts = int(words[steps.word[steps.sizes[0] - 1]])  # each training text has one end
    base, scores, n_known = _scores(steps, words, runs, types, total, texts)
    columns = [
        pa.array(chunk.ids, pa.int64()), pa.array([f == 1 for f in chunk.flags]), pa.array(steps.sizes), pa.array(n_known),
        pa.array(np.full(len(base), total)), pa.array(base), pa.array(scores, pa.float64()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
