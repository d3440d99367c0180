"""Byte-level BPE as a monoid: the encoding of a text is the join of the encodings of its halves.

An element is the token ids of a text and the number of tokens of each match of the pattern in it.
Encoding halves a text until a leaf is left; a join changes both sides only near the cut, in windows that
grow until what lies outside is proven stable:

- Matches of the pattern. A match of the left text that starts three characters or more before its end (the
  longest contraction) and does not reach it has seen all that decides it, and stays. The rest is matched
  again together with a growing number of matches of the right text, until a match that is decided ends
  where an old match ends: the pattern looks back at nothing, so the right text goes on as before.
- Tokens inside a match that runs over the cut. Tokens are the encoding of their bytes if every two
  neighbours are the encoding of theirs: the first merge over a boundary would also be made between the two
  alone. Tokens next to the cut are encoded again, more of them on a side where the outer neighbour
  does not accept the result.

Spark cuts long texts into pieces, encodes all pieces in parallel, and joins neighbours level by level, so that
the tree goes on over tasks. Decoding concatenates bytes up the same tree.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.llm.common import table, text_of

#: Characters of a text that is matched at once, bytes of a match that are merged at once.
LEAF_CHARS, LEAF_BYTES = 1 << 14, 32
#: Characters of a piece, the part of a text that one task encodes.
PIECE_CHARS = 1 << 16
#: Characters that decide whether a contraction starts: the apostrophe and two letters.
LOOKAHEAD = 3
#: Characters of the texts whose new words are learnt at once.
PORTION_CHARS = 1 << 21
#: Words that an encoder remembers at least, and the rank of a pair that no token joins.
_CACHED, _NONE = 80_000, 1 << 60

Element = tuple[np.ndarray, np.ndarray]
"""Token ids, and how many of them each match of the pattern has."""


class Codec:
    """The encoder of one vocabulary. It remembers, up to a bound, the tokens of matches and of words behind a
    space, as bytes of int32: no match goes on from another character into a space, so such a word is
    matched by itself. (A word that ends in white space does not end there, and is not remembered.)"""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        self.matches = regex.compile(pattern).findall
        self.rank_of = lambda pair, get=ranks.get: get(pair, _NONE)
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        # the bytes of all tokens behind one another
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.lengths = np.array([len(token) for token in self.tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths
        # every way to put a token together from two
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)])
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pairs, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs, (1 << 62, _NONE)))

    def of_match(self, match: str) -> bytes:
        value = self.known.get(match)
        if value is None:
            value = self.known[match] = array("i", self.encode_match(match.encode())).tobytes()
        return value

    def learn(self, texts: Sequence[str]) -> None:
        """Remember all words of some texts. What is new is matched and merged at once."""
        if len(self.words) > _CACHED:  # frequent words come back from the older half
            self.older_words, self.words = self.words, {}
        if len(self.known) > 2 * _CACHED:
            self.known = {}
        new = set().union(*(text.split(" ") for text in texts)).difference(self.words)
        back = new.intersection(self.older_words)
        self.words.update((word, self.older_words[word]) for word in back)
        words = [word for word in new.difference(back) if word and not word[-1].isspace()]
        if not words:
            return
        found = self.matches(" " + " ".join(words))
        unknown = [m for m in set(found).difference(self.known)]
        data = [m.encode() for m in unknown]
        short = [i for i, d in enumerate(data) if len(d) <= LEAF_BYTES]
        self.known.update(zip([unknown[i] for i in short], self.merge_all([data[i] for i in short])))
        parts = list(map(self.of_match, found))
        ends = np.cumsum([0, *map(len, parts)])
        # the first match of a word holds its space
        starts = [*ends[:-1][[m[0] == " " for m in found]].tolist(), int(ends[-1])]
        joined = b"".join(parts)
        self.words.update(zip(words, [joined[a:b] for a, b in zip(starts, starts[1:])]))

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= LEAF_BYTES:
            return b"".join([self.tokens[i] for i in ids])
        if len(ids) > PIECE_CHARS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.flat[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Tokens of many short words: each step merges the pair of least rank in every word that has one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = [b""] * len(words)
        for low in range(0, LEAF_BYTES, 8):  # words of about one length share a matrix
            chosen = np.flatnonzero((lengths > low) & (lengths <= low + 8))
            if len(chosen):
                padded = np.frombuffer(b"".join([words[i].ljust(low + 8, b"\0") for i in chosen.tolist()]), np.uint8)
                merged, counts = self._merge_matrix(padded.reshape(len(chosen), low + 8), lengths[chosen])
                data, step = merged.astype(np.int32).tobytes(), 4 * (low + 8)
                for at, (i, n) in enumerate(zip(chosen.tolist(), counts.tolist())):
                    out[i] = data[at * step : at * step + 4 * n]
        return out

    def _merge_matrix(self, data: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tokens, counts, width = self.of_byte[data], counts.copy(), data.shape[1]
        places = np.arange(width)
        ranks = np.full(data.shape, _NONE)  # of the pair that starts here
        ranks[:, :-1] = self._pair_ranks(tokens[:, :-1], tokens[:, 1:])
        ranks[places >= counts[:, None] - 1] = _NONE
        live = np.arange(len(data))
        while len(live):
            at = ranks[live].argmin(axis=1)
            least = ranks[live, at]
            live, at, least = live[least < _NONE], at[least < _NONE], least[least < _NONE]
            after = np.minimum(places + (places > at[:, None]), width - 1)  # what lies behind moves up by one
            tokens[live] = np.take_along_axis(tokens[live], after, 1)
            after = np.minimum(places + (places >= at[:, None]), width - 1)
            ranks[live] = np.take_along_axis(ranks[live], after, 1)
            tokens[live, at] = least
            ranks[live, -1] = _NONE
            counts[live] -= 1
            for first, near in ((at, at + 1 < counts[live]), (at - 1, at > 0)):
                row, i = live[near], first[near]
                ranks[row, i] = self._pair_ranks(tokens[row, i], tokens[row, i + 1])
            alone = at + 1 >= counts[live]
            ranks[live[alone], at[alone]] = _NONE
        return tokens, counts

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], _NONE)

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= LEAF_BYTES:
            return b"".join([self.tokens[i] for i in ids])
        if len(ids) > PIECE_CHARS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.flat[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()

    def merge(self, data: bytes) -> list[int]:
        """Tokens of some bytes by the rule itself: the pair of least rank first, of ties the leftmost."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = list(map(self.rank_of, map(add, parts, parts[1:])))
        if len(parts) > 2 * LEAF_BYTES:
            parts = self._merge_passes(parts, ranks)
        else:
            while ranks and (least := min(ranks)) != _NONE:
                i = ranks.index(least)
                parts[i] += parts.pop(i + 1)
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = self.rank_of(parts[i] + parts[i + 1])
                if i:
                    ranks[i - 1] = self.rank_of(parts[i - 1] + parts[i])
        return [self.ranks[p] for p in parts]

    def _merge_passes(self, parts: list[bytes], ranks: list[int]) -> list[bytes]:
        """The same for long windows: each pass merges all pairs of the least rank, from left to right."""
        while ranks and (least := min(ranks)) != _NONE:
            out, i = [], 0
            while i < len(parts):
                step = 1 + (i < len(ranks) and ranks[i] == least)
                out.append(parts[i] if step == 1 else parts[i] + parts[i + 1])
                i += step
            parts = out
            ranks = list(map(self.rank_of, map(add, parts, parts[1:])))
        return parts

    def encode_match(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join_tokens(self.encode_match(data[:half]), self.encode_match(data[half:]))

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of the bytes of both."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            window = self.merge(self.decode(left[-i:]) + self.decode(right[:j]))
            more_left = i < len(left) and not self._stays(left[-i - 1], window[0])
            more_right = j < len(right) and not self._stays(window[-1], right[j])
            if not more_left and not more_right:
                return left[:-i] + window + right[j:]
            i, j = min(i << more_left, len(left)), min(j << more_right, len(right))

    def _stays(self, a: int, b: int) -> bool:
        return self.merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def encode(self, text: str) -> Element:
        if len(text) <= LEAF_CHARS:
            found = list(map(self.of_match, self.matches(text)))
            return np.frombuffer(b"".join(found), np.int32), np.fromiter(map(len, found), np.int32, len(found)) // 4
        half = len(text) // 2
        return self.join(self.encode(text[:half]), self.encode(text[half:]))

    def encode_ids(self, text: str) -> np.ndarray:
        """The token ids alone: of a short text by its words, if all of them are remembered."""
        if len(text) <= LEAF_CHARS:
            first, *words = text.split(" ")
            found = list(map(self.words.get, words))
            if None not in found and first and not first[-1].isspace():
                return np.frombuffer(b"".join([*map(self.of_match, self.matches(first)), *found]), np.int32)
        return self.encode(text)[0]

    def join(self, left: Element, right: Element) -> Element:
        """The element of both texts, one behind the other."""
        (a_ids, a_sizes), (b_ids, b_sizes) = left, right
        if not len(a_sizes) or not len(b_sizes):
            return right if not len(a_sizes) else left
        # matches of the left text that may not stay: from the last one on back
        taken, at, old, tail = 0, len(a_ids), [], 0
        while taken < len(a_sizes) and tail < LOOKAHEAD:
            size = int(a_sizes[len(a_sizes) - 1 - taken])
            ids = a_ids[at - size : at].tolist()
            old.insert(0, (self.decode(ids).decode(), ids))
            taken, at, tail = taken + 1, at - size, tail + len(old[0][0])
        more, used, used_ids = 1, 0, 0
        while True:
            for size in b_sizes[used : used + more].tolist():
                ids = b_ids[used_ids : used_ids + size].tolist()
                old.append((self.decode(ids).decode(), ids))
                used, used_ids = used + 1, used_ids + size
            text = "".join(t for t, _ in old)
            whole = used == len(b_sizes)
            found = self.matches(text)
            ends = np.cumsum([len(m) for m in found])
            old_ends = np.cumsum([len(t) for t, _ in old])
            if whole:
                keep, cut = len(found), len(old)
                break
            # a match is decided if it starts early enough and ends before the window does
            decided = (ends - [len(m) for m in found] + LOOKAHEAD <= len(text)) & (ends < len(text))
            decided = int(np.argmin(np.append(decided, False)))
            meet = np.intersect1d(ends[:decided], old_ends[old_ends > tail], assume_unique=True)
            if len(meet):
                keep, cut = int(np.searchsorted(ends, meet[0])) + 1, int(np.searchsorted(old_ends, meet[0])) + 1
                break
            more *= 2
        new = self._again(found[:keep], old[:cut])
        # what was read of the right text beyond the meeting point stays as it was
        unused = used - (len(old) - cut)
        unused_ids = used_ids - sum(len(ids) for _, ids in old[cut:])
        kept = len(a_sizes) - taken
        return (
            np.concatenate([a_ids[:at], np.fromiter(chain.from_iterable(new), np.int32), b_ids[unused_ids:]]),
            np.concatenate([a_sizes[:kept], np.fromiter(map(len, new), np.int32, len(new)), b_sizes[unused:]]),
        )

    def _again(self, found: list[str], old: list[tuple[str, list[int]]]) -> list[list[int]]:
        """Tokens of the new matches ``found``, which cover the old matches: short ones are looked up, long
        ones joined from the tokens of the old matches inside them."""
        new, at, k, start = [], 0, 0, 0  # start: where old match k begins
        for match in found:
            end = at + len(match)
            if len(match) <= LEAF_BYTES:
                new.append(self.encode_match(match.encode()))
            else:
                tokens, here = [], at
                while here < end:
                    while start + len(old[k][0]) <= here:
                        start += len(old[k][0])
                        k += 1
                    stop = min(end, start + len(old[k][0]))
                    whole = here == start and stop == start + len(old[k][0])
                    part = old[k][1] if whole else self.encode_match(match[here - at : stop - at].encode())
                    tokens, here = self.join_tokens(tokens, part), stop
                new.append(tokens)
            at = end
        return new


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(shared: Broadcast) -> Codec:
    """One for each worker process and vocabulary."""
    rank_file, pattern = shared.value
    key = (hash(rank_file), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(rank_file, pattern)
    return _CODECS[key]


def vocabulary(spark: SparkSession, rank_file: str, pattern: str) -> Broadcast:
    """The ranks for the tasks: a file of a token and its rank a line, whose size the vocabulary bounds."""
    with open(rank_file, "rb") as f:
        return spark.sparkContext.broadcast((f.read(), pattern))


def _lists(values: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *values]), kind))


def _portions(texts: pa.StringArray) -> Iterator[list[str]]:
    """Texts in lists of some megabytes, of which the new words are learnt at once."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= PORTION_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encoded(texts: DataFrame, shared: Broadcast, whole: bool) -> DataFrame:
    """``texts`` (columns, then text) with the token ids of the text in its place; with the whole element,
    ids and sizes, if that is to be joined."""
    names = texts.columns[:-1]
    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            found = []
            for portion in _portions(batch.column(len(names))):
                if not whole:
                    codec.learn(portion)
                found += map(codec.encode, portion) if whole else ((codec.encode_ids(text),) for text in portion)
            lists = [_lists([f[i] for f in found], pa.int32()) for i in range(1 + whole)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], [*names, "ids", "sizes"][: len(names) + len(lists)])

    return texts.mapInArrow(run, f"{schema}, ids array<int>" + (", sizes array<int>" if whole else ""))


def _joined(elements: DataFrame, shared: Broadcast) -> DataFrame:
    """One level up the tree: neighbours (row, piece 2k and 2k + 1) become piece k."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, held = _codec(shared), None

        def out(row: int, piece: int, element: Element) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row]), pa.array([piece // 2]), *(_lists([part], pa.int32()) for part in element)], ["row", "piece", "ids", "sizes"])

        for batch in batches:
            for i in range(batch.num_rows):
                row, piece = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                element = tuple(batch.column(c)[i].values.to_numpy() for c in (2, 3))
                if piece % 2 == 0:
                    if held:
                        yield out(*held)
                    held = (row, piece, element)
                else:  # its left neighbour came just before
                    yield out(row, piece, codec.join(held[2], element))
                    held = None
        if held:
            yield out(*held)

    pair = F.expr("piece div 2")
    dealt = elements.withColumn("_pair", pair).repartition("row", "_pair").sortWithinPartitions("row", "piece").drop("_pair")
    return dealt.mapInArrow(run, "row long, piece long, ids array<int>, sizes array<int>")


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ids (array of int).

    Each match of ``pattern`` is encoded by itself with the ranks of ``rank_file``, without special tokens,
    so that their strings in a text are ordinary text. A null text counts as empty and has no ids. Null and
    repeated doc_ids and rows repeated whole give a row each; other columns are ignored. Texts of over
    ``PIECE_CHARS`` characters are cut into pieces that meet again level by level.
    """
    shared = vocabulary(docs.sparkSession, rank_file, pattern)
    given = docs.select("doc_id", text_of().alias("text"))
    short = _encoded(given.filter(F.length("text") <= PIECE_CHARS), shared, False)
    # row numbers are stored with the pieces: computed anew they could differ from job to job
    long = given.filter(F.length("text") > PIECE_CHARS).withColumn("row", F.monotonically_increasing_id())
    starts = F.expr(f"sequence(0L, (length(text) - 1) div {PIECE_CHARS})")
    pieces = long.select("row", "doc_id", "text", F.explode(starts).alias("piece"))
    cut = F.substring("text", F.col("piece").cast("int") * PIECE_CHARS + 1, F.lit(PIECE_CHARS))
    parts = table(_encoded(pieces.select("row", "doc_id", "piece", cut.alias("text")), shared, True))
    last = parts.agg(F.max("piece")).first()[0] or 0
    elements = parts.select("row", "piece", "ids", "sizes")
    for _ in range(int(last).bit_length()):
        elements = _joined(elements, shared)
    whole = parts.filter("piece = 0").select("row", "doc_id").join(elements.select("row", "ids"), "row")
    return short.unionByName(whole.select("doc_id", "ids"))


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``encoded`` (columns, then ids) with ``bytes`` for the ids: the tokens' bytes, concatenated. No ids
    (or null) give no bytes; an id that the vocabulary lacks fails."""
    shared = vocabulary(encoded.sparkSession, rank_file, pattern)
    names = [c for c in encoded.columns if c != "ids"]
    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            data = [codec.decode(ids.values.to_numpy()) if ids.is_valid else b"" for ids in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(data, pa.binary())], [*names, "bytes"])

    return encoded.select(*names, "ids").mapInArrow(run, f"{schema}, bytes binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space),
    decoded_sha256 (of the bytes that the ids give)."""
    ids = encode(docs, rank_file, pattern)
    digests = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), "ids")
    return decode(digests, rank_file, pattern).select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
