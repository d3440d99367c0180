"""Questions from chunks of text to the whole corpus, in packed form.

A row per word of a corpus is dominated by row overhead when it is shuffled. Here documents are stored
as chunks of some megabytes. A chunk asks about its distinct keys (hashes of words or of runs of words):
they are sorted, counted, cut into hash buckets, and sent as one row per bucket, whose arrays are byte
planes under zstandard. Whatever a text repeats is one key, so a hot key costs a bucket one entry per
chunk and never one per occurrence. A bucket settles the keys of all chunks and replies to each chunk in
the order of its keys; replies meet their chunk again, in which the texts are walked.

Buckets, and the tasks of every shuffle here, follow the bytes of the corpus, so that a task has about
``BUCKET_BYTES`` worth of keys or texts, whatever ``spark.sql.shuffle.partitions`` is.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import table

#: Bytes of text in a chunk (a longer text is a chunk by itself), and bytes of text behind one bucket's keys.
CHUNK_BYTES, BUCKET_BYTES = 2 << 20, 8 << 20
_CACHED_WORDS = 200_000
_KIND_SHIFT = 40
_CHUNK = "chunk long, bytes long, ids binary, flags binary, sizes binary, texts binary"
_PACKED = ["ids", "flags", "sizes", "texts"]
Arrays = list[np.ndarray]


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One for each worker process, so that tasks do not hold a copy each.
WORDS = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    return (values ^ values >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


def rolling(hashes: np.ndarray, width: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` word hashes; another odd ``factor`` gives another hash."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(factor) + hashes[j : j + n]
    return mixed(out)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of unsigned integers, of one length, as compressed byte planes."""
    n, planes, widths = len(columns[0]), [], []
    for values in columns:
        values = np.ascontiguousarray(values, "<u8")
        widths.append(max(1, (int(values.max()).bit_length() + 7) // 8) if n else 1)
        planes.append(values.view(np.uint8).reshape(-1, 8)[:, : widths[-1]].T.tobytes())
    return struct.pack("<IB", n, len(columns)) + bytes(widths) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes) -> list[np.ndarray]:
    n, count = struct.unpack_from("<IB", data)
    widths = data[5 : 5 + count]
    planes, at, columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[5 + count :]), np.uint8), 0, []
    for width in widths:
        out = np.zeros((n, 8), np.uint8)
        out[:, :width] = planes[at : at + n * width].reshape(width, n).T
        columns.append(out.view("<u8").ravel())
        at += n * width
    return columns


def shortened(keys: np.ndarray, bits: int, low: int) -> np.ndarray:
    """Keys without the bits that neither name their bucket nor are sent."""
    drop = np.uint64(max(64 - bits - low, 0))
    return keys >> drop << drop


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


class Chunk:
    """The documents of one chunk: doc_id (or None), flag, UTF-8 text."""

    def __init__(self, row: Mapping):
        self.ids = [None if f & 1 else i for i, f in zip(unpack(row["ids"])[0].view(np.int64).tolist(), row["flags"])]
        self.flags = [f >> 1 for f in row["flags"]]
        joined, ends = zstandard.ZstdDecompressor().decompress(row["texts"]), np.cumsum(unpack(row["sizes"])[0].astype(np.int64)).tolist()
        self.texts = [joined[a:b] for a, b in zip([0, *ends], ends)]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush() -> pa.RecordBatch:
        ids, flags, texts = zip(*held)
        none = [i is None for i in ids]
        row = (
            part << 32 | at, size, pack(np.array([i or 0 for i in ids], np.int64).view(np.uint64)), bytes(2 * f + x for f, x in zip(flags, none)),
            pack(np.array([len(t) for t in texts], np.uint64)), zstandard.ZstdCompressor(level=1).compress(b"".join(texts)),
        )
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i < 2 else pa.binary()) for i, v in enumerate(row)], ["chunk", "bytes", *_PACKED])

    for row in _rows(batches):
        held.append((row["doc_id"], row["flag"], row["text"]))
        size += len(row["text"]) + 8
        if size >= CHUNK_BYTES:
            yield flush()
            at, held, size = at + 1, [], 0
    if held:
        yield flush()


def chunks(given: DataFrame) -> DataFrame:
    """``given`` (doc_id long, flag int of 0 to 127, text binary, not null) as a stored table of chunks."""
    return table(given.select("doc_id", "flag", "text").mapInArrow(_store, _CHUNK))


def bucket_bits(stored: DataFrame) -> int:
    """Bits of a key that name its bucket, by the bytes of all chunks."""
    size = stored.agg(F.sum("bytes")).first()[0] or 0
    return max(4, (int(size) // BUCKET_BYTES).bit_length())


def _meet(stored: DataFrame, replies: DataFrame | None, bits: int, use: Callable[[Chunk, int, dict[int, np.ndarray]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``use(chunk, its name, replies by kind)`` for each chunk; one chunk is held at a time."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield from use(Chunk(row), row["chunk"], {})

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[pa.RecordBatch]:
            yield from use(Chunk(chunk), chunk["chunk"], {k: np.concatenate([unpack(p)[0] for p in parts]) for k, parts in found.items()})

        chunk, found = None, {}
        for row in _rows(batches):
            if row["texts"] is not None:  # a chunk comes before its replies
                if chunk:
                    yield from done()
                chunk, found = row, {}
            else:
                found.setdefault(row["bucket"] >> _KIND_SHIFT, []).append(row["reply"])
        if chunk:
            yield from done()

    if replies is None:
        return stored.mapInArrow(alone, schema)
    texts = stored.select("chunk", F.lit(-1).cast("long").alias("bucket"), *_PACKED, F.lit(None).cast("binary").alias("reply"))
    theirs = replies.select("chunk", "bucket", *(F.lit(None).cast("binary").alias(c) for c in _PACKED), "reply")
    return texts.unionByName(theirs).repartition(1 << bits, "chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(together, schema)


def ask(
    stored: DataFrame, replies: DataFrame | None, bits: int, question: Callable[[Chunk, dict[int, np.ndarray]], dict[int, Arrays]],
    settle: Callable[[int, Arrays], tuple[np.ndarray, list[int]]], low: Mapping[int, int],
) -> DataFrame:
    """(chunk, bucket, reply, sums) as a stored table.

    ``question(chunk, replies)`` gives arrays by kind: sorted keys, then columns aligned with them.
    ``settle(kind, arrays)`` has those of one bucket from all chunks and gives a reply to each entry,
    and a few sums of the bucket, which stand in one of its rows. ``low`` tells by kind how many bits of
    a key are sent below its bucket (``shortened``); entries with one key need another column that tells them apart.
    """

    def put(chunk: Chunk, name: int, known: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = []
        for kind, (keys, *more) in question(chunk, known).items():
            high = keys >> np.uint64(64 - bits)
            starts = np.flatnonzero(np.append(True, high[1:] != high[:-1])) if len(keys) else []
            sent = (keys & np.uint64((1 << 64 - bits) - 1)) >> np.uint64(max(64 - bits - low[kind], 0))
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                rows.append((kind << _KIND_SHIFT | int(high[a]), name, pack(np.diff(sent[a:b], prepend=np.uint64(0)), *(m[a:b] for m in more))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["bucket", "chunk", "columns"])

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            parts = [unpack(columns) for _, columns in held]
            for p in parts:
                p[0] = np.cumsum(p[0], dtype=np.uint64)
            ends = np.cumsum([len(p[0]) for p in parts])
            arrays = [np.concatenate(c) for c in zip(*parts)]
            parts.clear()
            kind = bucket >> _KIND_SHIFT
            arrays[0] <<= np.uint64(max(64 - bits - low[kind], 0))
            arrays[0] |= np.uint64(bucket & (1 << _KIND_SHIFT) - 1) << np.uint64(64 - bits)
            reply, sums = settle(kind, arrays)
            out = [pack(reply[a:b]) for a, b in zip([0, *ends], ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in held]), pa.array([bucket] * len(held)), pa.array(out, pa.binary()), pa.array([sums] + [None] * (len(held) - 1), pa.list_(pa.int64()))],
                ["chunk", "bucket", "reply", "sums"],
            )

        bucket, held = None, []
        for row in _rows(batches):
            if row["bucket"] != bucket and held:
                yield done()
                held = []
            bucket = row["bucket"]
            held.append((row["chunk"], row["columns"]))
        if held:
            yield done()

    asked = _meet(stored, replies, bits, put, "bucket long, chunk long, columns binary")
    return table(asked.repartition(1 << bits, "bucket").sortWithinPartitions("bucket").mapInArrow(get, "chunk long, bucket long, reply binary, sums array<long>"))


def answered(stored: DataFrame, replies: DataFrame, bits: int, answer: Callable[[Chunk, dict[int, np.ndarray]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``answer(chunk, replies by kind)`` for each chunk."""
    return _meet(stored, replies, bits, lambda chunk, _, known: answer(chunk, known), schema)
