"""Every prefix of several cycles is held against the weights themselves."""

from collections import Counter
from fractions import Fraction

import pytest

from plazalake.llm import mixing

WEIGHTS = {"src0": 4.0, **{f"src{i}": 1.0 for i in range(1, 20)}}


def lag(slots, weights):
    """The largest distance of a source from its weight in any prefix of sources by slot."""
    total, out, most = sum(map(Fraction, map(repr, weights.values()))), Counter(), 0
    for t, source in enumerate(slots, 1):
        out[source] += 1
        most = max(most, *(abs(out[s] - Fraction(repr(w)) * t / total) for s, w in weights.items()))
    return most


def test_whole():
    assert mixing.whole(WEIGHTS) == {s: int(w) for s, w in WEIGHTS.items()}
    assert mixing.whole({"a": 0.1, "b": 0.25, "c": 2.0}) == {"a": 2, "b": 5, "c": 40}
    assert mixing.whole({"a": 1e-3, "b": 6.0}) == {"a": 1, "b": 6000}


@pytest.mark.parametrize("longest", [mixing.LONGEST_CYCLE, 1])
def test_several_cycles(spark, monkeypatch, longest):
    monkeypatch.setattr(mixing, "LONGEST_CYCLE", longest)
    sizes = {s: 420 if s == "src0" else 105 for s in WEIGHTS}  # blocks of one document: 2,415 slots, over two old cycles
    sizes["src7"] += 9  # stays after the others have run out
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"src0": 4.0}, block_docs=1).collect()
    assert len({r["slot"] for r in got}) == len(got) == len(rows)
    order = [r["source"] for r in sorted(got, key=lambda r: r["slot"]) if r["in_target"]]
    assert len(order) == 2415 and [r["slot"] for r in sorted(got, key=lambda r: r["slot"])][:2415] == list(range(2415))
    assert lag(order, WEIGHTS) < 1


def test_weights_of_many_digits():
    weights = {"a": 0.123456789, "b": 0.7071067811865476, "c": 3.0}
    blocks = {"a": 40, "b": 200, "c": 900}
    rows = list(mixing.laid_out(mixing.whole(weights), blocks))
    assert Counter(r[0] for r in rows) == blocks and len({r[2] for r in rows}) == len(rows)
    order = [r[0] for r in rows if r[3]]
    assert len(order) > 900 and lag(order, weights) < 1


def test_more_sources_than_slots(spark):
    rows = [(i, f"s{i % 1100}") for i in range(2200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {}, block_docs=1).collect()
    assert len({r["slot"] for r in got}) == 2200 and all(r["in_target"] for r in got)
