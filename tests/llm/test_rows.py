"""Each drop_* function takes rows one by one: null and repeated doc_ids take nothing else along."""

import random

import pytest

from plazalake.llm import common, decontaminate, exact, simhash, toxicity

SCHEMA = "doc_id long, text string, _row string"


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    return [prose(rng, 60) for _ in range(8)]


def kept(df):
    assert df.columns == ["doc_id", "text", "_row"]
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in df.collect())


def given(spark, rows):
    common.tune(spark)
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)


def want(rows):
    return sorted((i is None, i or 0, t) for i, t in rows)


def test_dedup_stages(spark, texts):
    a, b, c, d, e, f, *_ = texts
    once = [(1, a), (2, b), (None, c), (3, d), (3, e), (None, f)]
    more = [(None, a), (3, a), (2, b), (2, b), (None, f)]  # copies: null id, id with another text, rows repeated whole
    for drop in (exact.drop_exact_duplicates, simhash.drop_near_duplicates):
        assert kept(drop(given(spark, once + more))) == want(once)
        assert kept(drop(given(spark, []))) == []


def test_decontamination_by_row(spark, texts):
    a, b, c, d, *_ = texts
    items = spark.createDataFrame([(1, a)], "item_id long, text string")
    clean = [(None, b), (3, c), (4, d), (4, d)]
    assert kept(decontaminate.drop_contaminated(given(spark, clean + [(None, f"x {a}"), (3, a)]), items)) == want(clean)
    assert [r["doc_id"] for r in decontaminate.contaminated(given(spark, [(3, a), (3, f"x {a}")]), items).collect()] == [3]


def test_toxicity_by_row(spark, texts):
    rng = random.Random(22)
    toxic = [f"vile {prose(rng, 30)} rotten" for _ in range(200)]
    plain = [prose(rng, 32) for _ in range(200)]
    labelled = [(10 + i, t) for i, t in enumerate(toxic + plain)]
    labels = spark.createDataFrame([(i, int(i < 210)) for i, _ in labelled], "doc_id long, toxic int")
    rows = labelled + [(None, toxic[0]), (None, texts[0]), (5, toxic[1]), (5, texts[1])]
    docs = given(spark, rows)
    marked = {r["doc_id"] for r in toxicity.toxicity(docs.filter("doc_id >= 10"), labels).filter("predicted = 1").collect()}
    assert {10, 11} <= marked
    assert kept(toxicity.drop_toxic(docs, labels)) == want([(i, t) for i, t in labelled if i not in marked] + [(None, texts[0]), (5, texts[1])])
