import random
from collections import Counter
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plazalake.llm import common, components, decontaminate, exact, html_text, language_model, mixing, secret_scan, simhash, substring, toxicity, warc
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, n_chars long, norm string, fp long, _doc long, key string"
VOCABULARY = [f"w{i}" for i in range(40)]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, blanks, ties, repeated rows, copies, near copies, shared passages, a very long text."""
    rng = random.Random(7)
    base = [(i, prose(rng, rng.randint(1, 120))) for i in range(60)]
    shared = prose(rng, 55)
    long_text = " ".join(f"x{rng.randint(0, 50_000)}" for _ in range(30_000))
    extra = [
        (100, None), (101, ""), (102, "  \t\n "), (103, "one"), (104, "one  two"), (104, "one  two"), (105, "one\ttwo"), (None, "one two"), (None, base[0][1]),
        (106, f"{base[3][1]} {shared} end"), (107, f"start {shared}"), (108, f"{shared} {shared}"), (109, base[5][1].upper()), (110, base[6][1] + " tail"),
        (111, "x " * 70), (112, long_text), (113, long_text + " more"), (115, "É ñandú ß " * 12), (120, base[7][1]), (121, base[7][1]), (-5, base[7][1]),
    ]
    return base + extra


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.tune(spark)
    return spark.createDataFrame([(i, t, "s", 1, "clash", 2, 3, "k") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_exact(docs, rows, nothing):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert found(exact.exact_duplicates(docs), *columns) == sorted(brute.exact_groups(rows), key=repr)
    assert exact.exact_duplicates(nothing).count() == 0
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert set(r[0] for r in kept.select("doc_id").collect()) == {r[0] for r in brute.exact_groups(rows) if r[3]}


@pytest.mark.parametrize("size", [0, 1 << 29, 10**11])
def test_blocks_follow_the_rows(docs, size, monkeypatch):
    bits = exact.block_bits(size)
    assert bits == max(10, size.bit_length() - 20)
    monkeypatch.setattr(exact, "block_bits", lambda _: bits)
    given = docs.selectExpr("xxhash64(coalesce(text, '')) AS fp")
    counts = Counter(r["fp"] for r in given.collect())
    assert found(exact.repeated_fingerprints(given), "fp", "copies") == sorted(((fp, n) for fp, n in counts.items() if n > 1), key=repr)


@pytest.mark.parametrize("key_bits", [54, 40])
def test_filters_merge_without_loss(key_bits):
    import numpy as np

    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << key_bits, 3000, dtype=np.uint64)
    keys = np.append(keys, keys[:700])
    parts = [np.unique(p, return_counts=True) for p in np.array_split(keys, 7)] + [np.unique(keys[:1], return_counts=True)]
    merged = exact.merge_filters([exact.encode_filter(*p, key_bits) for p in parts])
    want = np.unique(np.append(keys, keys[:1]), return_counts=True)
    assert (merged[0] == want[0]).all() and (merged[1] == want[1]).all()


def test_simhash(docs, rows, nothing):
    got = found(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute.near_components(rows), key=repr)
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(docs).columns == docs.columns


def groups_of(pairs, items):
    group = {p: p for p in items}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in pairs:
        group[root(a)] = root(b)
    out = defaultdict(set)
    for p in items:
        out[root(p)].add(p)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("long_list", [2, 8, 2048])
def test_links_of_long_lists(spark, monkeypatch, long_list):
    monkeypatch.setattr(simhash, "BLOCK", max(2, long_list // 4))
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    prints = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for s in seeds for _ in range(12)})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(p), signed(p)) for p in prints], "id long, f0 long").repartition(4)
    links = simhash.near_links(nodes, simhash.EXACT_KEYS, 4, 4, long_list)
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = groups_of([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 4], prints)
    got = defaultdict(set)
    for p in prints:
        got[roots.get(signed(p), signed(p))].add(p)
    assert want == sorted(map(sorted, got.values()))


def test_forest_is_minimal():
    import numpy as np

    rng = np.random.default_rng(6)
    for n in (2, 9, 40):
        for m in (0, 1, n, 4 * n):
            a, b, d = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 5, m)
            kept = simhash.forest(a, b, d, n).tolist()
            label, want = list(range(n)), 0
            for i in np.argsort(d, kind="stable").tolist():  # Kruskal
                if label[a[i]] != label[b[i]]:
                    want += int(d[i])
                    label = [label[b[i]] if x == label[a[i]] else x for x in label]
            assert sum(int(d[i]) for i in kept) == want and len(kept) == n - len(set(label))


def test_wide_search_finds_similar_texts(spark):
    """All pairs by brute force at five words and 0.8, from just above to far below."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 400))]
        for j in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, len(words) // 40)):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(copy).upper() if j % 2 else " ".join(copy)))
    crowd = [f"c{i}" for i in range(120)]
    for i in range(150):
        copy = list(crowd)
        copy[i % 120] = f"z{i}"
        rows.append((len(rows), " ".join(copy)))
    rows += [(5000, None), (5001, " "), (5002, "one two"), (5003, "two one"), (5004, "ONE  two")]
    bags = {i: brute.shingle_set(t) for i, t in rows}
    by = defaultdict(set)
    for i, bag in bags.items():
        for s in bag:
            by[s].add(i)
    met = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    pairs = {(a, b) for a, b in met if len(bags[a] & bags[b]) >= 0.8 * len(bags[a] | bags[b])} | {(5000, 5001)}
    want = {g[0] for g in groups_of(pairs, [i for i, _ in rows])}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert want <= got  # a text without a similar one never goes
    gone, found = len(rows) - len(want), len(rows) - len(got)
    assert gone > 350 and found >= 0.97 * gone


def test_components_of_a_path(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(7, 7), (None, 3), (900, 901)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {900: 900, 901: 900}


def test_substring(docs, rows, nothing):
    want = brute.kept_words(rows)
    got = found(substring.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(((i, *want[i, t]) for i, t in rows), key=repr)
    assert substring.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("window", [5, 8])
def test_substring_windows(spark, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(80)]
    got = found(substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = brute.kept_words(rows, window)
    assert got == sorted(((i, *want[i, t]) for i, t in rows), key=repr)


def test_decontamination(spark, docs, rows, nothing):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(4, 60))) for i in range(12)] + [(50, None), (51, ""), (52, "one two"), (None, "x " * 30), (53, rows[2][1]), (54, rows[2][1])]
    cut = items[3][1].split()
    more = [(200, f"before {items[1][1]} after"), (201, " ".join(cut[:-1] + ["changed"])), (202, " ".join(["new", *cut])), (203, items[5][1].upper()), (204, f"{items[7][1]} z {items[7][1]}")]
    noisy = []
    for i in range(60):
        words = items[i % 12][1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [rng.choice(VOCABULARY)] * rng.randint(0, 2)
        noisy.append((300 + i, f"{prose(rng, 20)} {' '.join(words)} {prose(rng, 20)}"))
    all_rows = rows[:80] + more + noisy
    all_rows = [r for r in all_rows if len(r[1] or "") < 5000]
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, w string")
    given = spark.createDataFrame(all_rows, "doc_id long, text string")
    want = brute.contaminated(all_rows, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(given, benchmark).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k][0]) < 1e-9 for k in got)
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns


def test_language_model(docs, rows, nothing):
    want = sorted(brute.lm_scores(rows), key=lambda r: (repr(r[0]), r[2:]))
    got = sorted((tuple(r) for r in language_model.score_texts(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=lambda r: (repr(r[0]), r[2:]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
    assert language_model.score_texts(nothing).count() == 0


def test_mixing(spark, docs, nothing):
    given = mixing.shares({"a": 5, "b": 1, "c": 0.5, "d": 3.3}, 97)
    assert sum(given.values()) == 97 and brute.lag_ok(mixing.cycle(given), given)
    many = mixing.shares({f"s{i}": 1 + i % 7 for i in range(60)}, 1000)
    assert brute.lag_ok(mixing.cycle(many), many)
    rows = [(i, ["a", "b", None][0 if i % 3 else i % 2 + 1]) for i in range(900)] + [(5, "a"), (None, "b")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"a": 3.0}, slots=10, block_docs=4).collect()
    assert len(got) == len(rows)
    assert len({(r["slot"], r["place"]) for r in got}) == len(rows)
    weights = mixing.shares({"a": 3.0, "b": 1.0, mixing.NO_SOURCE: 1.0}, 10)
    slots = sorted({(r["slot"], r["source"]) for r in got if r["in_target"]})
    assert [s for s, _ in slots] == list(range(len(slots))) and len(slots) > 20
    out = defaultdict(int)
    for t, (_, source) in enumerate(slots, 1):
        out[source] += 1
        assert all(abs(out[s] - n * t / 10) < 1 for s, n in weights.items())
    assert mixing.mix(nothing, {"a": 1.0}).count() == 0


def test_toxicity(spark, docs, nothing):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.2
        words = [f"v{rng.randint(0, 3000)}" for _ in range(rng.randint(5, 120))]
        for _ in range(toxic * 2):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "Filthy,", "rotten"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "clash"))
    marked = spark.createDataFrame([*labels, (None, 1, ""), (3, None, ""), (4, labels[4][1], "")], "doc_id long, toxic int, text string")
    got = {r["doc_id"]: r for r in toxicity.toxicity(spark.createDataFrame([*rows, (9000, None), (9001, "")], "doc_id long, text string"), marked).collect()}
    held = [i for i, *_ in labels if brute.fold(i, 5) == 0]
    assert all(got[i]["held_out"] for i in held) and len(held) > 200
    assert sum(got[i]["predicted"] == labels[i][1] for i in held) / len(held) > 0.97
    assert got[9000]["score"] == got[9001]["score"] and 0 <= got[9000]["score"] <= 1
    assert toxicity.toxicity(nothing, marked).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, marked.limit(0)).collect()} == {0.5}
    assert toxicity.drop_toxic(docs, marked).columns == docs.columns


def test_ftrl_equals_plain_version():
    import numpy as np

    rng = random.Random(12)
    texts = ["", "one", "one one two", "Vile, vile thing!", "É ñandú vile"] + [prose(rng, rng.randint(1, 60)) + rng.choice(["", " vile", " vile rotten"]) for _ in range(120)]
    rows = [(t, int("vile" in t.lower() or rng.random() < 0.1)) for t in texts]
    for text in texts:
        assert set(toxicity.features(text.encode()).tolist()) == brute.toxic_features(text, toxicity.BITS)
    got = toxicity.ftrl([(np.unique(toxicity.features(t.encode())).astype(np.int32), label) for t, label in rows])
    want = brute.ftrl([(brute.toxic_features(t, toxicity.BITS), label) for t, label in rows], toxicity.EPOCHS, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    bias = want.pop("bias")
    assert abs(got[-1] - bias) < 1e-9 and set(np.flatnonzero(got[:-1]).tolist()) == set(want) and want
    assert all(abs(got[at] - w) < 1e-9 for at, w in want.items())


def test_toxicity_equals_plain_version(spark):
    """Every score of the table, from the labels on."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None and brute.fold(r["doc_id"], 5)}
    keys = {r["doc_id"]: r["at"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id, CAST(text AS BINARY)) AS at").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    learned = sorted((d for d in marks if texts.get(d) is not None), key=keys.get)
    weights = brute.ftrl([(brute.toxic_features(texts[d], toxicity.BITS), marks[d]) for d in learned], toxicity.EPOCHS, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    assert len(learned) > 50 and len(got) == len(texts)
    for doc_id, text in texts.items():
        assert abs(got[doc_id]["score"] - brute.toxic_score(text or "", weights, toxicity.BITS)) < 1e-5  # sent weights are floats
        assert got[doc_id]["predicted"] == (got[doc_id]["score"] >= 0.5) and got[doc_id]["held_out"] == (brute.fold(doc_id, 5) == 0)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p><article>";</script></head><body class=page>
<header><a href=/>Home</a> Site name</header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies.</div>
<!-- <p>hidden</p> --><div class="ad">Buy now.</div><article><h1>Head&amp;line</h1><p><b>Bo</b>ld first&nbsp; paragraph.<br>Next   line<p>Second.</p>
<div class="ad banner">Buy again, a long advert text here.</div><p>a &lt; b < c</p><form><label>Mail</label><input value="x > y"></form><aside>See also</aside></article>
<section id="comments"><p>First! A long comment that goes on and on and on, with words.</p></section><footer>&copy; site</footer>"""


def test_html(spark, nothing):
    assert html_text.main_text(PAGE) == "Head&line Bold first paragraph. Next line Second. a < b < c"
    assert html_text.main_text("") == "" and html_text.main_text("<script>x") == ""
    plain = "<body><p>" + "A sentence of plain prose, long enough to count. " * 5 + "</p></body>"
    assert html_text.main_text(plain).startswith("A sentence")
    rows = [(1, "u", PAGE, 3), (1, "u", PAGE, 3), (None, None, None, 4), (2, "u", "<p>" * 3000 + "<a '" * 2000, 4), (3, "", "<article>" + "<p>w</p>" * 20_000, 1)]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["n_chars"] for r in got}[3] == 39_999
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


ARTICLE = "<article><h1>Head</h1><p>First paragraph of the article.</p><p>Second one.</p></article>"


@pytest.mark.parametrize("page", [
    f'<body class="has-sidebar">{ARTICLE}</body>', f'<body class="page no-comments">{ARTICLE}</body>', ARTICLE.replace("<article>", '<article class="post with-banner">'),
    f"<script>var x='<!-- '</script>{ARTICLE}", ARTICLE.replace("<p>Sec", '<p id="comment-policy">Sec'), f'<div class="sidebar-layout"><form>{ARTICLE}</form></div>',
    f"<select>{ARTICLE}", f'<div style="overflow: hidden">{ARTICLE}</div>', f"<svg>{ARTICLE}<!-- no end",
    f'{ARTICLE}<div id="comments"><ol class="comment-list"><li><article class="comment-body"><p>{"Words of a reader. " * 20}</p></article></li></ol></div>',
    f'<div class="cookie-notice"><p>{"We use cookies. " * 20}</p></div><div class="newsletter-signup">Mail me.</div>{ARTICLE}<div hidden>{"x " * 90}</div>',
])
def test_article_is_kept_and_nothing_else(page):
    assert html_text.main_text(page) == "Head First paragraph of the article. Second one."


def test_long_pages_stay_cheap():
    import time

    rng = random.Random(1)
    pages = ["".join(f"<div><p>{'word ' * rng.randint(1, 30)}.</p><a href=x>{'link ' * rng.randint(1, 3)}</a></div>" for _ in range(8000)), "<b>" * 20_000 + "x<p>y</p></i>" * 20_000, "<svg><select>" * 20_000]
    began = time.time()
    for page in pages:
        html_text.main_text(page)
    assert time.time() - began < 10


def test_cut_decides_without_an_article_element():
    page = f"<div><ul>{'<li><a href=x>Menu entry</a></li>' * 6}</ul></div><div>{'<p>A long enough sentence of plain prose, with more words in it. And one more to make it long.</p><p>A heading</p>' * 4}</div>"
    found, scores, labels = html_text.labelled(page)
    assert [b.text for b, on in zip(found, labels) if on] == [b.text for b in found if "Menu" not in b.text]
    assert any((s > 0) != on for s, on in zip(scores, labels))


def test_minimum_cut_is_minimal():
    import itertools
    import math

    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i - 1, i, rng.random()) for i in range(1, n)] + [(a, b, rng.random()) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.2]

        def cost(labels):
            return sum(math.log1p(math.exp(-s if on else s)) for s, on in zip(scores, labels)) + sum(c for a, b, c in edges if labels[a] != labels[b])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(html_text.minimum_cut(scores, edges)) == pytest.approx(best)


def test_secrets(spark, docs, rows, nothing):
    key = "AKIA" + "Q7" * 9
    text = f'é token = "0123456789abcdef01234567" and API_KEY:xx secret=token:abcdef {key} AKIASHORT ' + "password is hidden " * 3 + "Authorization: q9Zk3LxW8vTr5Yb2Nc7M done"
    rows = [(1, text, "s"), (2, None, "s"), (3, "", "s"), (1, text, "s")]
    got = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    one = [r for r in got if r["doc_id"] == 1]
    assert len(got) == 4 and one[0] == one[1]
    a = text.index("token"), text.index('" and')
    hit = text.index("q9Zk3")
    assert one[0]["spans"] == f"assign:{a[0]}:{a[1]},hex:{a[1] - 24}:{a[1]},access:{text.index(key)}:{text.index(key) + 22},novel:{hit}:{hit + 20}"
    assert (one[0]["n_assign"], one[0]["n_access"], one[0]["n_hex"]) == (1, 1, 1)
    assert {r["spans"] for r in got if r["doc_id"] != 1} == {""}
    assert secret_scan.scan_secrets(docs).count() == docs.count() and secret_scan.scan_secrets(nothing).count() == 0


def test_secrets_equal_plain_version(spark):
    rng = random.Random(12)
    alphabet = "abcdef0123456789ABCDEFXYZ+/_.=-"
    pieces = [" ", " ", "\n", '"', "'", ":", "=", " = ", ": ", "é", "ſ", "İ", "token", "Token", "API_KEY", "apikey", "secret", "password", "AKIA", "bearer", "api-key", "words of prose", "client_secret", "myFieldName"]
    make = lambda: "".join(rng.choice(pieces) if rng.random() < 0.8 else "".join(rng.choice(alphabet) for _ in range(rng.randint(3, 40))) for _ in range(rng.randint(1, 60)))
    long = "".join(rng.choice(alphabet[:-1]) for _ in range(10_000))
    texts = [make() for _ in range(400)] + [f"a token {long} end", f"bearer {'x' * 40}{long} token {long[:30]}", "token " * 3000, "tokenAKIA" * 2000, "secret=abcdef " * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = secret_scan.identifiers(docs)
    assert "client_secret" in names and "myFieldName" in names and len(names) == len(set(names))
    primed = secret_scan.compressor(names)
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan_secrets(docs).collect()}
    assert got == {i: brute.secrets(t, primed) for i, t in enumerate(texts)}
    assert "novel:8:10008" in got[400] and sum("novel" in s for s in got.values()) > 20


def test_revisits(spark):
    t = "2024-01-0{} 00:00:00"
    full = {"ETag": '"a"', "Content-Type": "text/html", "Age": "1"}
    rows = [
        (1, "response", "http://www.x.org/p/?b=2&a=1&utm_source=q#f", t.format(1), "d1", full),
        (2, "response", "https://X.org:443/p?a=1&b=2", t.format(3), "d2", {"ETag": '"b"', "Last-Modified": "m"}),
        (3, "revisit", "x.org/p?a=1&b=2", t.format(2), "dr", {"etag": 'W/"a"', "Content-Type": "no", "age": "7"}),
        (4, "revisit", "x.org/p?a=1&b=2", t.format(3), "dr", {"ETag": '"b"'}),
        (5, "revisit", "x.org/p?a=1&b=2", t.format(4), "dr", {"Last-Modified": "m"}),
        (6, "revisit", "x.org/p?a=1&b=2", t.format(1), "dr", None), (7, "revisit", None, t.format(4), "dr", {}), (8, "revisit", "x.org/p?a=1&b=2", None, "dr", {}),
        (9, "revisit", "x.org/p?a=1&b=2", t.format(5), "d2", {}), (10, "metadata", "x.org/p?a=1&b=2", t.format(2), "d", {}), (11, None, "x.org", t.format(2), "d", {}),
    ]
    schema = "record_id long, record_type string, url string, captured_at string, digest string, headers map<string,string>"
    captures = spark.createDataFrame(rows, schema).withColumn("captured_at", F.to_timestamp("captured_at"))
    for period in ("day", "month", "hour"):
        got = {r["record_id"]: r for r in warc.resolve_revisits(captures, period).collect()}
        assert {k: (r["status"], r["refers_to"]) for k, r in got.items()} == {
            3: ("resolved", 1), 4: ("changed", 1), 5: ("resolved", 2), 6: ("orphan", None), 7: ("orphan", None), 8: ("orphan", None), 9: ("resolved", 2)}
        assert got[3]["headers"] == {"etag": 'W/"a"', "content-type": "text/html", "age": "7"} and got[3]["digest"] == "d1"
    assert warc.resolve_revisits(captures.limit(0)).count() == 0
    # repeated rows give one row each and the same answer; other columns with the names used inside change nothing
    twice = captures.union(captures).withColumn("url_key", F.lit("clash")).withColumn("_found", F.lit(1)).withColumn("status", F.lit("x"))
    again = sorted((r["record_id"], r["status"], r["refers_to"]) for r in warc.resolve_revisits(twice).collect())
    assert again == sorted(2 * [(k, r["status"], r["refers_to"]) for k, r in got.items()])
