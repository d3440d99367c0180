"""Decontamination held against all windows where aligned starts, five-word shingles or SimHash lose some."""

import random

from plazalake.llm import common, decontaminate
from tests.llm import brute


def both(spark, rows, items):
    common.tune(spark)
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start"]) for r in found}
    want = {k: (round(s, 9), at) for k, (s, at) in brute.contaminated(rows, items).items()}
    return got, want, {(r["doc_id"], r["item_id"]): r["hamming"] for r in found}


def test_few_repeated_shingles_stay(spark):
    rng = random.Random(31)
    rows, items = [], []
    for i in range(40):
        a, b = f"a{rng.random()}", f"b{rng.random()}"
        rows.append((i, " ".join([a] * 40 + [b] * 37)))
        items.append((i, " ".join([a] * 37 + [b] * 40)))
    got, want, hamming = both(spark, rows, items)
    assert len(want) == 40 and {k: s for k, (s, _) in got.items()} == {k: s for k, (s, _) in want.items()}
    assert max(hamming.values()) > 20


def test_windows_at_no_aligned_start(spark):
    rng = random.Random(32)
    fresh = lambda n: [f"n{rng.random()}" for _ in range(n)]
    rows, items = [], []
    for i, (ends, inside) in enumerate([(2, 5), (3, 6), (2, 4), (1, 5), (3, 3)] * 4):
        item = fresh(100)
        passage = fresh(ends) + item[ends:50] + fresh(inside) + item[50 : 100 - ends] + fresh(ends)
        rows.append((i, " ".join(fresh(rng.randint(0, 30)) + passage + fresh(rng.randint(0, 30)))))
        items.append((i, " ".join(item)))
    rows.append((90, " ".join([rows[0][1], *fresh(50), items[0][1], *fresh(50), rows[0][1]])))  # one item at three places
    got, want, _ = both(spark, rows, items)
    assert len(want) > 10 and {k: s for k, (s, _) in got.items()} == {k: s for k, (s, _) in want.items()}
    assert 0.8 <= want[0, 0][0] < 0.83 and got[90, 0][0] == 1


def test_short_items(spark):
    rows = [(1, "a b c d e f g"), (2, "x y"), (3, "A"), (4, "q w e r t y"), (5, None), (6, "f g a b"), (None, "z f g")]
    items = [(1, "f g"), (2, "d"), (3, "c d e f"), (4, "x y z"), (5, "a b c d e"), (6, "f G"), (None, "y")]
    got, want, _ = both(spark, rows, items)
    assert got == want and (1, 1) in got and (1, 3) in got and (None, 1) in got
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(
        spark.createDataFrame(rows[:6], "doc_id long, text string"), spark.createDataFrame([(1, "f g")], "item_id long, text string")).collect()) == [2, 3, 4, 5]


def test_texts_that_repeat_themselves(spark):
    rng = random.Random(33)
    rows = [(1, "x " * 3000), (2, "x y z " * 700), (3, "x " * 150 + "y " * 20 + "x " * 150), (4, " ".join(rng.choice("xy") for _ in range(900)))]
    items = [(1, "x " * 60), (2, "y z x " * 30), (3, "x " * 30 + "y " * 25), (4, rows[3][1][400:520])]
    got, want, _ = both(spark, rows, items)
    assert len(want) > 4 and {k: s for k, (s, _) in got.items()} == {k: s for k, (s, _) in want.items()}
    # a window of any start is as good as the item here; the earliest is named
    found = decontaminate.contaminated(spark.createDataFrame([(i, "x " * 20_000) for i in range(4)], "doc_id long, text string"), spark.createDataFrame([(i, "x " * (200 + i)) for i in range(5)], "item_id long, text string"))
    assert [(r["start"], r["n_words"], r["similarity"]) for r in found.orderBy("doc_id", "item_id").collect()] == [(0, 200 + i, 1.0) for i in range(5)] * 4
