"""Byte-level BPE, the Merkle manifest and periodic runs against plain versions."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plazalake.llm import byte_bpe, common, merkle, periodic, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN
#: Extra columns clash with names that the operators use inside.
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, row long, piece string, ids string, tree string, pos string, block string, _words string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(30)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    given = [(i, "abé\n"[i % 4], ["en", None][i % 2], i, f"{prose(rng.randint(1, 60))}\n{prose(5)}") for i in range(40)]
    given += [(i, "hot", "en", 1, f"{i}\nline") for i in range(100, 900)]  # more than one block of nodes
    given += [
        (50, None, None, None, None), (51, "", "en", 0, ""), (52, None, "en", 3, " \t\n "), (None, "a", "en", 1, "x\ny"), (None, None, None, None, "x\ny"), (None, "a", "en", 1, None),
        (53, "b", "en", 1, "same\nrow"), (53, "b", "en", 1, "same\nrow"), (53, "b", "en", 1, "other\nrow"), (-4, "b", "en", 1, "don't\x0bwe'll  'l"),
        (60, "b", "en", 1, "a b " * 4000), (61, "b", "en", 1, "x" * 90_000 + " y'" + "l" * 70_000), (63, "b", "de", 1, "日本 \U0001f600 " * 9000), (64, "b", "en", 1, "<|endoftext|> 1234567"),
        (67, "b", "en", 1, " ".join(str(i % 5000) for i in range(25_000))), (68, "b", "en", 1, ("a b c d e f g h i " * 5 + "z ") * 5),
    ]
    return given


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.tune(spark)
    return spark.createDataFrame([(*r, 1, "p", "i", "t", "q", "k", "w") for r in rows], SCHEMA).repartition(5)


def in_order(found):
    return sorted(map(tuple, found), key=repr)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return byte_bpe.Codec(f.read(), PATTERN)


def bpe_rows(library, rows):
    found = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        found.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    return in_order(found)


def test_bpe(spark, docs, rows, library):
    assert in_order(byte_bpe.round_trip(docs, RANKS, PATTERN).collect()) == bpe_rows(library, [(r[0], r[4]) for r in rows])
    assert byte_bpe.round_trip(docs.limit(0), RANKS, PATTERN).count() == 0
    short = byte_bpe.encode(docs.filter("doc_id = 53"), RANKS, PATTERN).collect()
    assert in_order((r["doc_id"], library.decode(r["ids"])) for r in short) == [(53, "other\nrow"), (53, "same\nrow"), (53, "same\nrow")]


def test_bpe_pieces(docs, rows, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 1000)  # up to eight levels of joins
    assert in_order(byte_bpe.round_trip(docs, RANKS, PATTERN).collect()) == bpe_rows(library, [(r[0], r[4]) for r in rows])


def test_bpe_table(spark, library):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert in_order(queries.op11_byte_bpe(spark, SF).collect()) == bpe_rows(library, given)


PARTS = ["a", "b", "ab", " ", "  ", "\n", "'", "'s", "'ll", "'l", "l", "1", "12", "!", "é", "日本", "\t", "ing", " the", "xxxxxxxxx", "\U0001f600", "(", " ", "́"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=14), st.integers(1, 5))
def test_bpe_joins_at_any_cut(codec, library, parts, leaf):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    want = library.encode_ordinary(text)
    for cut in range(len(text) + 1):
        joined = codec.join(codec.encode(text[:cut]), codec.encode(text[cut:]))
        assert joined[0].tolist() == want and [int(n) for n in joined[1]] == [len(codec.encode_match(m.encode())) for m in codec.matches(text)]
    codec.learn([text, "a  b \n"])
    assert codec.encode_ids(text).tolist() == want
    before, byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES = (byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES), leaf, leaf
    try:
        codec.known = {}
        assert codec.encode(text)[0].tolist() == want
    finally:
        byte_bpe.LEAF_CHARS, byte_bpe.LEAF_BYTES = before


def test_bpe_without_blanks(codec, library):
    rng = random.Random(2)
    for text in ("a" * 5001, "ab" * 3000, " " * 3001 + "x", "-" * 999 + "a", "".join(rng.choice("abcdef") for _ in range(9000))):
        half = len(text) // 3
        assert codec.join(codec.encode(text[:half]), codec.encode(text[half:]))[0].tolist() == library.encode_ordinary(text)


def test_bpe_premises(codec):
    """A join may rely on neighbours alone if every token is the encoding of its own bytes."""
    assert all(codec.merge(token) == [rank] for token, rank in codec.ranks.items() if len(token) <= 2 * byte_bpe.LEAF_BYTES)


def test_manifest(docs, rows):
    assert in_order(merkle.document_manifest(docs).collect()) == in_order(brute.manifest(rows))
    assert merkle.document_manifest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 729, 730])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "only", "en", 1, f"a\n{i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert in_order(merkle.document_manifest(docs).collect()) == in_order(brute.manifest(rows))


def test_manifest_keeps_columns_and_proves_inclusion(docs):
    leaves = docs.filter("doc_id < 40").withColumn("leaf", merkle.leaf(F.col("doc_id"), F.col("text"))).withColumnRenamed("ids", "steps_")
    found = merkle.manifest(leaves)
    assert found.columns == leaves.columns + ["subroot", "root", "steps"]
    assert found.filter(merkle.fold(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0 and found.count() == leaves.count()
    assert found.filter(merkle.fold(merkle.leaf(F.lit(1)), F.col("steps")) == F.col("root")).count() == 0


def run_rows(rows):
    found = []
    for doc_id, text in rows:
        runs, kept = brute.runs(brute.repeated_words(doc_id, text))
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        found.append((doc_id, len(runs), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(kept))))
    return in_order(found)


def test_runs(docs, rows):
    few = [r for r in rows if r[0] not in (67, 60)]  # too long to try every period
    got = periodic.run_digests(periodic.periodic_runs(periodic.planted(docs.filter("doc_id IS NULL OR doc_id NOT IN (60, 67)"))))
    assert in_order(got.collect()) == run_rows([(r[0], r[4]) for r in few])
    assert periodic.run_digests(periodic.periodic_runs(periodic.planted(docs.limit(0)))).count() == 0


def test_runs_of_long_texts(docs):
    found = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.periodic_runs(docs.filter("doc_id IN (60, 67, 68)")).collect()}
    assert found[60] == [(0, 8000, 2)] and found[67] == [(0, 25_000, 5000)]
    assert (0, 230, 46) in found[68] and (0, 45, 9) in found[68]


def test_runs_table(spark):
    given = [r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert in_order(queries.op13_periodic_runs(spark, SF).collect()) == run_rows(given)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 6), st.integers(1, 3), st.integers(0, 10**6)), max_size=5), st.integers(1, 4))
def test_runs_of_nested_repeats(blocks, times):
    words = []
    for period, repeats, letters, seed in blocks:
        rng = random.Random(seed)
        base = [b"%d" % rng.randint(0, letters) for _ in range(period)]
        words += base * repeats + base[: rng.randint(0, period)]
    words = (words * times)[:1200]
    (found,), (kept,) = periodic._of_batch([b" ".join(words)])
    runs, stay = brute.runs(words)
    assert found == runs and kept == b" ".join(stay)


def test_synchronising_set_is_consistent_and_dense():
    import numpy as np

    rng = np.random.default_rng(4)
    words = np.concatenate([rng.integers(0, 3, 3000), np.zeros(500, np.int64), rng.integers(0, 2, 500)])
    words = np.concatenate([words, words[:2000]])
    scale = 8
    runs = periodic._small_periods(words)
    windows = np.lib.stride_tricks.sliding_window_view(words, scale)
    hashes = periodic.mixed(np.dot(windows, 5 ** np.arange(scale)).astype(np.uint64))
    chosen = periodic.synchronising_set(hashes.copy(), scale, runs)
    marked = np.zeros(len(words), bool)
    marked[chosen] = True
    double = np.lib.stride_tricks.sliding_window_view(words, 2 * scale)
    by_context = {}
    for at, context in enumerate(map(bytes, np.ascontiguousarray(double))):
        assert by_context.setdefault(context, marked[at]) == marked[at]
    for at in range(len(words) - 3 * scale):
        if not marked[at : at + scale].any():  # then the words around repeat with a period of at most scale / 4
            part = words[at : at + 3 * scale - 1]
            assert any((part[q:] == part[:-q]).all() for q in range(1, scale // 4 + 1))
