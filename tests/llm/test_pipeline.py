import html
import random
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from plazalake.llm import secret_scan, toxicity
from plazalake.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert differences(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(20, 50))) for i in range(8)]
    rows = [(i, prose(rng, rng.randint(30, 90))) for i in range(400)]
    toxic = {i for i in range(0, 400, 5)}
    rows = [(i, f"vile {t} rotten {t[:40]} vile" if i in toxic else t) for i, t in rows]
    rows += [(1000 + i, rows[i][1].replace(" ", "  ")) for i in range(1, 60, 7)]
    rows += [(2000 + i, rows[i][1] + " tail") for i in range(2, 60, 9)]
    rows += [(3000 + i, f"{prose(rng, 9)} {items[i][1]} {prose(rng, 9)}") for i in range(8)] + [(4000, None), (4001, "")]
    full = [(i, t, "en", ["a", "src0", None][i % 3], len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i in toxic)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    marked = {r["doc_id"] for r in toxicity.toxicity(docs, spark.read.parquet(str(tmp_path / "labels.parquet"))).filter("predicted = 1").collect()}
    assert len(marked & toxic) > 0.9 * len(toxic) and not (marked - toxic - {2000 + i for i in toxic} - {1000 + i for i in toxic})
    kept = [r for r in rows if r[0] not in marked]
    keep = {r[0] for r in brute.exact_groups(kept) if r[3]}
    kept = [r for r in kept if r[0] in keep]
    kept = brute.without_similar(kept)
    leaks = {d for d, _ in brute.contaminated(kept, items)}
    assert leaks >= {3000 + i for i in range(8)}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in kept if i not in leaks)
    assert len({(r["slot"], r["place"]) for r in got}) == len(got)
    assert {r["doc_id"]: r["text"] for r in got} == {i: t for i, t in kept if i not in leaks}


#: Held against the library and against all periods over the same table in test_bpe_merkle_runs.
ELSEWHERE = {"op11_byte_bpe", "op13_periodic_runs"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - ELSEWHERE))
def test_query_on_its_table(spark, name):
    """Queries that SQL cannot express, over a whole table, against plain versions or known facts."""
    rows = [tuple(r) for r in QUERIES[name](spark, SF).collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    if name.startswith("op6"):
        assert sorted(rows, key=key) == sorted(brute.near_components(docs), key=key)
    elif name.startswith("op9"):
        for got, want in zip(sorted(rows, key=key), sorted(brute.lm_scores(docs), key=key), strict=True):
            assert got[:5] == want[:5] and got[5:] == pytest.approx(want[5:], rel=1e-9)
        assert sum(r[6] for r in rows if r[1]) > sum(r[5] for r in rows if r[1])  # better than single words on held-out texts
    elif name.startswith("op10"):
        table = spark.read.parquet(f"{SF}/documents.parquet")
        primed = secret_scan.compressor(secret_scan.identifiers(table))
        assert {r[0]: r[6] for r in rows} == {i: brute.secrets(t or "", primed) for i, t in docs}
    elif name.startswith("op5"):
        toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
        assert len(rows) == len(docs) and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) and r[1] == (brute.fold(r[0], 5) == 0) for r in rows)
        seen = [(r[3], toxic[r[0]]) for r in rows if not r[1] and r[0] in toxic]
        assert sum(a == b for a, b in seen) / len(seen) > 0.85
    else:
        assert name.startswith("op8")
        for page_id, url, text, n in rows:
            assert n == len(text) and text == " ".join(text.split())
        pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
        body = {p["page_id"]: p["html"].split("<article>")[1].split("</article>")[0] for p in pages if p["html"] and p["html"].count("<article>") == 1}
        plain = lambda x: " ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split())
        squeezed = lambda x: x.replace(" ", "")
        assert len(rows) == len(pages) and sum(squeezed(r[2]) == squeezed(plain(body.get(r[0], ""))) for r in rows) > 0.99 * len(body)
