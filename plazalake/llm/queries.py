"""Queries of the training-data operators over the driver's tables, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.llm import byte_bpe, decontaminate, exact, html_text, language_model, merkle, mixing, periodic, secret_scan, simhash, substring, toxicity, warc
from plazalake.llm.common import read, tune

#: Target weights of the mixture; sources not named weigh 1.
MIX_WEIGHTS = {"src0": 4.0}
#: The vocabulary of operator 11, by its name among the public tokenizers.
RANK_FILE = "byte_bpe_50k.tiktoken"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(tune(spark), sf_dir, "documents"), MIX_WEIGHTS)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(tune(spark), sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("hamming")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read(tune(spark), sf_dir, "documents")).drop("kept_text")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read(tune(spark), sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(tune(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(tune(spark), sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures_of_pages(read(tune(spark), sf_dir, "pages")))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return found.select("record_id", "url_key", "refers_to", "status", "digest", listed.alias("headers"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(read(tune(spark), sf_dir, "pages"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(read(tune(spark), sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read(tune(spark), sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read(tune(spark), sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(read(tune(spark), sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(periodic.planted(read(tune(spark), sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_decontaminate, op3_substring_dedup, op4_exact_dedup, op5_toxicity,
        op6_simhash_near_dedup, op7_warc_revisits, op8_html_main_text, op9_lm_score, op10_secret_scan,
        op11_byte_bpe, op12_merkle_manifest, op13_periodic_runs,
    )
}

#: Words of a text in DuckDB.
_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_MIX = r"""WITH RECURSIVE n AS (SELECT coalesce(source, '(none)') AS source, count(*) AS n FROM documents GROUP BY 1),
g AS (SELECT source, n, CAST(CASE source WHEN 'src0' THEN 4 ELSE 1 END AS BIGINT) AS a FROM n),
l AS (SELECT list(source ORDER BY source) AS s, list(a ORDER BY source) AS a, CAST(sum(a) AS BIGINT) AS slots FROM g),
c AS (SELECT 0 AS t, list_transform(a, lambda q: 0) AS done, 0 AS pick FROM l UNION ALL
  SELECT t + 1, list_transform(done, lambda q, i: CASE WHEN i = p THEN q + 1 ELSE q END), p FROM (
    SELECT t, done, list_sort(list_transform(list_filter(range(1, len(a) + 1), lambda i: done[i] < a[i] AND done[i] * slots // a[i] <= t), lambda i: {'d': ((done[i] + 1) * slots + a[i] - 1) // a[i], 's': s[i], 'i': i}))[1].i AS p FROM c, l WHERE t < slots)),
k AS (SELECT l.s[c.pick] AS source, done[pick] - 1 AS turn, t - 1 AS turn_slot FROM c, l WHERE pick > 0),
r AS (SELECT doc_id, coalesce(source, '(none)') AS source, row_number() OVER (PARTITION BY coalesce(source, '(none)') ORDER BY md5(concat('mix:', doc_id)), doc_id) - 1 AS rank FROM documents),
z AS (SELECT r.*, rank // 32 AS block, rank // 32 // g.a * slots + turn_slot AS slot FROM l, r JOIN g ON g.source = r.source JOIN k ON k.source = r.source AND k.turn = rank // 32 % g.a),
h AS (SELECT min((n + 31) // 32 // g.a * slots + turn_slot) AS slot FROM l, g JOIN k ON k.source = g.source AND k.turn = (n + 31) // 32 % g.a)
SELECT doc_id, source, block, z.slot AS slot, rank % 32 AS place, z.slot < h.slot AS in_target FROM z, h"""

_LEAKS = f"""WITH d AS (SELECT doc_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM benchmark),
ds AS (SELECT doc_id, n, p, array_to_string(w[p + 1:p + 5], ' ') AS s FROM (SELECT doc_id, w, len(w) AS n, unnest(range(0, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
bs AS (SELECT item_id, n, o, array_to_string(w[o + 1:o + 5], ' ') AS s FROM (SELECT item_id, w, len(w) AS n, unnest(range(0, greatest(len(w) - 4, 1))) AS o FROM b WHERE len(w) > 0)),
c AS (SELECT DISTINCT doc_id, item_id, ds.n AS n, bs.n AS l, greatest(0, least(p - o, ds.n - least(ds.n, bs.n))) AS st FROM ds JOIN bs ON ds.s = bs.s),
a AS (SELECT c.doc_id, item_id, c.n, l, st, s, count(*) AS k FROM c JOIN ds ON ds.doc_id = c.doc_id AND p >= st AND p < st + greatest(least(c.n, l) - 4, 1) GROUP BY ALL),
m AS (SELECT a.doc_id, a.item_id, st, least(n, l) AS width, l, sum(least(a.k, i.k)) AS common FROM a JOIN (SELECT item_id, s, count(*) AS k FROM bs GROUP BY ALL) i ON i.item_id = a.item_id AND i.s = a.s GROUP BY ALL),
q AS (SELECT *, CAST(common AS DOUBLE) / CAST(greatest(width - 4, 1) + greatest(l - 4, 1) - common AS DOUBLE) AS similarity FROM m)
SELECT doc_id, item_id, st AS start, width AS n_words, similarity FROM q WHERE similarity >= 0.8 - 1e-12
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, st) = 1"""

_REPEATS = f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
v AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, p FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
y AS (SELECT x.doc_id, word, x.p, max(CASE WHEN late.p IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY x.doc_id ORDER BY x.p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM x LEFT JOIN late ON late.doc_id = x.doc_id AND late.p = x.p)
SELECT d.doc_id, count(y.p) AS n_words, CAST(coalesce(sum(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY y.p) FILTER (WHERE gone = 0), '')) AS kept_sha256 FROM d LEFT JOIN y ON y.doc_id = d.doc_id GROUP BY d.doc_id"""

_COPIES = r"""WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256 FROM n WINDOW w AS (PARTITION BY text_sha256)"""

_REVISITS = r"""WITH u AS (SELECT page_id, sha1(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size, to_timestamp(1700000000 + page_id * 60) AS tm,
  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS bare FROM pages),
k AS (SELECT *, concat(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^www\.', ''), ':(80|443)$', ''), regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', ''),
  CASE WHEN len(q) > 0 THEN concat('?', array_to_string(list_sort(q), '&')) ELSE '' END) AS url_key
  FROM (SELECT *, list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref|sessionid)(=|$)')) AS q FROM u)),
v AS (SELECT page_id * 2 + 1 AS record_id, url_key, digest, tm + to_days(CAST(page_id % 5 AS INTEGER)) + INTERVAL 1 HOUR AS tm, page_id % 60 AS age,
  CASE WHEN page_id % 15 = 0 THEN '"stale"' WHEN page_id % 2 = 0 THEN concat('W/"', left(digest, 12), '"') END AS etag FROM k WHERE page_id % 3 = 0),
m AS (SELECT v.*, r.page_id AS rp, r.digest AS rd, r.size AS size, r.tm AS rtm FROM v LEFT JOIN k r ON r.url_key = v.url_key AND r.tm < v.tm QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.tm DESC NULLS LAST, r.page_id DESC) = 1),
s AS (SELECT *, concat('"', left(rd, 12), '"') AS retag, CASE WHEN rp IS NULL THEN 'orphan' WHEN CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = concat('"', left(rd, 12), '"') ELSE rd = digest END THEN 'resolved' ELSE 'changed' END AS status FROM m)
SELECT record_id, url_key, rp * 2 AS refers_to, status, CASE WHEN status = 'resolved' THEN rd ELSE digest END AS digest,
  CASE WHEN status = 'resolved' THEN concat('age=', age, ';cache-control=max-age=120;content-length=', size, ';content-type=text/html;etag=', coalesce(etag, retag), ';last-modified=', strftime(rtm AT TIME ZONE 'UTC', '%Y-%m-%d'))
       ELSE concat('age=', age, ';cache-control=max-age=120;content-length=0', CASE WHEN etag IS NOT NULL THEN concat(';etag=', etag) ELSE '' END) END AS headers FROM s"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({0} AS VARCHAR))), ':', {0}) END"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + ", {0}))"
#: The last bit of crc32: bytes enter the register one by one, and eight shifts follow each.
_ODD = """1 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda r, b: list_reduce(list_prepend(xor(r, b), CAST([1, 2, 3, 4, 5, 6, 7, 8] AS BIGINT[])), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) & 1"""

_MANIFEST = f"""WITH RECURSIVE l AS (SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
  {_LEAF.format(_FIELD.format("CASE WHEN odd = 0 THEN replace(text, chr(10), '') ELSE text END"))} AS changed FROM (SELECT *, {_ODD} AS odd FROM documents)),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS src FROM (SELECT DISTINCT source FROM documents)),
d AS (SELECT l.*, src, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source),
t AS (SELECT src, 0 AS lvl, pos, leaf AS h FROM d UNION ALL
  SELECT src, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY src) AS n FROM t) WHERE n > 1 GROUP BY src, lvl, pos // 3),
b AS (SELECT src, h AS subroot FROM t QUALIFY lvl = max(lvl) OVER (PARTITION BY src)),
f AS (SELECT 0 AS lvl, src AS pos, subroot AS h FROM b UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM f) WHERE n > 1 GROUP BY lvl, pos // 3),
tr AS (SELECT src, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM (SELECT *, count(*) OVER (PARTITION BY src, lvl) AS n FROM t) WHERE n > 1 GROUP BY ALL),
fr AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM (SELECT *, count(*) OVER (PARTITION BY lvl) AS n FROM f) WHERE n > 1 GROUP BY ALL),
w AS (SELECT src, pos AS leaf_pos, 0 AS lvl, pos, changed AS h, '' AS proof FROM d UNION ALL
  SELECT w.src, leaf_pos, w.lvl + 1, w.pos // 3, sha256(array_to_string(list_transform(hs, lambda x, i: CASE WHEN i = w.pos % 3 + 1 THEN w.h ELSE x END), '')), concat(proof, array_to_string(list_filter(hs, lambda x, i: i <> w.pos % 3 + 1), ''))
  FROM w JOIN tr ON tr.src = w.src AND tr.lvl = w.lvl AND tr.run = w.pos // 3),
v AS (SELECT src, leaf_pos, 0 AS lvl, src AS pos, h, proof FROM (SELECT * FROM w QUALIFY lvl = max(lvl) OVER (PARTITION BY src, leaf_pos)) UNION ALL
  SELECT v.src, leaf_pos, v.lvl + 1, v.pos // 3, sha256(array_to_string(list_transform(hs, lambda x, i: CASE WHEN i = v.pos % 3 + 1 THEN v.h ELSE x END), '')), concat(proof, array_to_string(list_filter(hs, lambda x, i: i <> v.pos % 3 + 1), ''))
  FROM v JOIN fr ON fr.lvl = v.lvl AND fr.run = v.pos // 3),
r AS (SELECT h AS root FROM f QUALIFY lvl = max(lvl) OVER ())
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = root AS verified
FROM d JOIN b ON b.src = d.src JOIN (SELECT * FROM v QUALIFY lvl = max(lvl) OVER (PARTITION BY src, leaf_pos)) e ON e.src = d.src AND e.leaf_pos = d.pos, r"""

#: The others need hashes, a classifier, a flow or a compressor, which SQL does not have; tests hold
#: them against plain versions.
ORACLES: dict[str, str] = {
    "op1_mix_sources": _MIX,
    "op2_decontaminate": _LEAKS,
    "op3_substring_dedup": _REPEATS,
    "op4_exact_dedup": _COPIES,
    "op7_warc_revisits": _REVISITS,
    "op12_merkle_manifest": _MANIFEST,
}
