"""Secret scans: three patterns, and novelty against a primed compressor.

Novelty: a string that follows a sensitive word is compressed together with the code around it, by a
zstandard compressor primed with a dictionary of identifiers; the bytes it adds are its marginal
cost. Strings that neither the surroundings nor the dictionary make cheaper are reported. The
dictionary holds common identifiers and those that most documents of the corpus have.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Patterns of the contract; lengths are checked after the match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = ("password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "credential", "bearer", "authorization", "private_key", "signature")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.ASCII | re.IGNORECASE)
LEAST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST},}}")
#: Characters after a sensitive word in which a candidate starts; characters of code around it.
REACH, AROUND = 48, 512
#: Marginal compressed bytes per character from which a string counts as incompressible.
NOVELTY = 0.6
#: Compound identifiers of letters, which no secret is, and how many of the corpus the dictionary takes.
_IDENTIFIER = r"\b(?:[A-Za-z]++(?:[_-][A-Za-z]++)++|[a-z]++(?:[A-Z][a-z]++)++)\b"
MOST_IDENTIFIERS = 1000
#: Identifiers that code repeats; the compressor knows them beforehand.
IDENTIFIERS = (
    "access_token refresh_token client_secret client_id api_key apiKey password passwd username user_name secret_key private_key public_key "
    "Authorization Bearer Basic Content-Type application/json text/html https://www. http:// .example.com localhost 127.0.0.1 config settings "
    "environment process.env os.environ getenv function return import export const class static void string number boolean undefined null true "
    "false self this request response session cookie header headers connection database postgres mysql redis localhost:8080 0123456789 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ changeme placeholder your_password_here your-api-key-here xxxxxxxxxxxxxxxx "
    "certificate -----BEGIN RSA PRIVATE KEY----- signature expires_in grant_type password_hash created_at updated_at"
)


def identifiers(docs: DataFrame, most: int = MOST_IDENTIFIERS) -> list[str]:
    """The identifiers that most documents have, over all of ``docs`` (text); ties by name."""
    each = docs.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_IDENTIFIER), 0))).alias("name"))
    found = each.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(F.desc("n"), "name").limit(most)
    return [r["name"] for r in found.collect()]


def compressor(names: list[str]) -> zstandard.ZstdCompressor:
    # what comes last is the cheapest to refer to
    text = " ".join([*reversed(names), IDENTIFIERS]).encode()
    primed = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=9)
    return zstandard.ZstdCompressor(dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, in code points."""
    low = text.lower()
    found = []
    if any(k in low for k in ("password", "passwd", "secret", "token", "api_key", "apikey")):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def novel_spans(text: str, taken: list[tuple[int, int, str]], primed: zstandard.ZstdCompressor) -> list[tuple[int, int, str]]:
    """Incompressible strings that start near a sensitive word and touch no span of ``taken``."""
    spans = sorted(taken)
    starts, ends = [s for s, _, _ in spans], list(accumulate((e for _, e, _ in spans), max))
    found, until = [], 0
    for word in _SENSITIVE.finditer(text):
        at, last = max(word.end(), until), word.end() + REACH
        # what starts up to ``last`` shows its least length up to here; its end may be anywhere
        while at <= last and (first := _CANDIDATE.search(text, at, last + LEAST)):
            m = _CANDIDATE.match(text, first.start())
            a, b = m.span()
            at = until = b
            before = bisect_left(starts, b)
            if (before and ends[before - 1] > a) or not (re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])):
                continue
            around = text[max(0, a - AROUND) : a].encode("utf-8", "replace") + text[b : b + AROUND].encode("utf-8", "replace")
            marginal = len(primed.compress(around + m[0].encode())) - len(primed.compress(around))
            if marginal >= NOVELTY * (b - a):
                found.append((a, b, "novel"))
    return found


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex, n_novel,
    base_sha256, spans. spans lists kind:start:end in code points, end exclusive, by start and kind;
    base_sha256 is over the list of the three patterns' spans alone.

    Null counts as empty; a text without spans has an empty list. Repeated rows give one row each.
    No rows give no rows; other columns are ignored. Spans are found in whole texts, to their real end.
    """
    names = identifiers(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        primed = compressor(names)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                novel = novel_spans(text, base, primed) if text else []
                kinds = [k for _, _, k in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), len(novel), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + novel)))
            columns = list(zip(*rows)) if rows else [()] * 6
            arrays = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    given = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return given.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
