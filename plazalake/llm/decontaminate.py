"""Benchmark decontamination with DataFrame functions only.

A document holds an item if one of its windows, as many words long as the item, has a weighted
(repeats count) five-word-shingle similarity of 0.8 or more to it. Windows that share no shingle
cannot reach that, nor windows with shared shingles at fewer places than the threshold needs: every
other window is made, whether an item's shingle is aligned with it or not. An item of fewer words than
a shingle is one shorter shingle, looked up as such. All windows made are verified on the
shingles themselves. The join on shingles is the search: the 64-bit SimHash of windows and items is
only reported as a distance and decides nothing, as texts of few, heavily repeated shingles can differ
in many bits at any similarity below 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import BLANK_REGEX, row_key, table, text_of

SHINGLE = 5
SIMILARITY = 0.8
#: Item shingles up to this count (some 40 MB) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def words(column: str = "text") -> Column:
    return F.array_remove(F.split(F.lower(text_of(column)), BLANK_REGEX), "")


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is computed once a row. A plain projection would be merged into
    the functions of its elements and computed anew for each element."""
    return df.withColumn(name, F.explode(F.array(value)))


def shingle_hashes(w: Column, k: int = SHINGLE) -> Column:
    """A hash for each k-word shingle in order; fewer words are one shingle, no word is none."""
    at = F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))
    hashed = F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k))))
    return F.when(F.size(w) > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def simhash(of: str) -> tuple[list[Column], Column]:
    """Aggregates over hashes in column ``of``, and the fingerprint made of them: a bit is set if
    more than half of the hashes have it; repeats weigh as often."""
    ones = [F.sum(F.getbit(of, F.lit(b)).cast("long")).alias(f"_bit{b}") for b in range(64)]
    bits = [F.when(2 * F.col(f"_bit{b}") > F.col("_size"), F.lit((1 << b) - (1 << 64 if b == 63 else 0))).otherwise(F.lit(0)).cast("long") for b in range(64)]
    return [F.count(F.lit(1)).alias("_size"), *ones], reduce(Column.bitwiseOR, bits)


def _with_before(hashes: str) -> Column:
    """Each hash with the one before it; no row of an explosion then holds the array."""
    return F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.get(hashes, i - 1).alias("before")))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per doc_id and benchmark item found in it: doc_id, item_id, start (word, from 0),
    n_words (of the window), similarity, hamming, of the most similar window. Of ties those come first that align
    a shared shingle with its place in the item, then the earliest.

    Words are lower-cased. A document shorter than an item is one window. Null, empty and wordless
    texts match nothing on either side. Repeated rows and rows with a null id count once and can
    match; items with one text and different ids are all reported. Other columns are ignored.
    """
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words", "hamming")).alias("b")
    return _found(docs, benchmark, similarity).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("b.s")).alias("start"), "b.n_words", "b.similarity", "b.hamming"
    )


def _found(docs: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    """What ``contaminated`` gives, for each text of a doc_id by itself, named by _doc."""
    items = (
        computed(benchmark.select("item_id", "text", row_key("item_id").alias("_item")), "w", words()).filter(F.size("w") > 0).dropDuplicates(["_item"])
        .select("item_id", "_item", F.size("w").alias("_length"), shingle_hashes(F.col("w")).alias("_hashes"))
    )
    short = items.filter(F.col("_length") < SHINGLE)
    lengths = sorted(r["_length"] for r in short.select("_length").distinct().collect())
    items = items.filter(F.col("_length") >= SHINGLE)
    listed = items.select("_item", "_length", F.posexplode(_with_before("_hashes")).alias("_o", "x"))
    listed = listed.groupBy("_item", "_length", F.col("x.h").alias("_h"), F.col("x.before").alias("before")).agg(F.collect_list("_o").alias("at"))
    pieces = table(listed.groupBy("_item", "_length", "_h").agg(F.sum(F.size("at")).cast("int").alias("_b"), F.collect_list(F.struct("before", "at")).alias("_places")))
    few = pieces.agg(F.coalesce(F.sum("_b"), F.lit(0))).first()[0] <= BROADCAST_ROWS
    pieces = F.broadcast(pieces) if few else pieces

    texts = docs.select("doc_id", "text", row_key().alias("_doc"))
    split = computed(texts, "w", words())
    width = F.least("_n", "_length")
    size = lambda n: F.greatest(n - (SHINGLE - 1), F.lit(1))
    enough = F.ceil(similarity * (size(width) + size(F.col("_length"))) / (1 + similarity) - 1e-9)

    # what a pair shares at most, in any window: a row for each shared shingle, counted in the task that reads the text
    hashed = split.select("_doc", F.size("w").alias("_n"), F.explode(shingle_hashes(F.col("w"))).alias("_h"))
    shared = hashed.join(pieces.drop("_places"), "_h").groupBy("_doc", "_n", "_item", "_length", "_h", "_b").agg(F.count(F.lit(1)).alias("_a"))
    pairs = table(shared.groupBy("_doc", "_n", "_item", "_length").agg(F.sum(F.least("_a", "_b")).alias("_most")).filter(F.col("_most") >= enough).drop("_most"))

    some = computed(texts.join(pairs.select("_doc").distinct(), "_doc", "left_semi").dropDuplicates(["_doc"]), "w", words())
    some = table(some.select("doc_id", "_doc", shingle_hashes(F.col("w")).alias("_hashes")))
    met = some.select("_doc", F.posexplode(_with_before("_hashes")).alias("_p", "x")).select("_doc", "_p", F.col("x.h").alias("_h"), F.col("x.before").alias("_before"))
    # places of the item that do not go on with what stands before in the text: there aligned stretches begin
    opens = F.flatten(F.transform(F.filter("_places", lambda x: ~F.coalesce(x["before"] == F.col("_before"), F.lit(False))), lambda x: x["at"]))
    met = table(met.join(pieces.drop("_length"), "_h").join(pairs, ["_doc", "_item"]).withColumn("_opens", opens).drop("_places", "_before"))
    pair = ["_doc", "_item", "_n", "_length"]

    # A place counts in the windows that hold it but not the one _b places of its shingle before: their starts are a
    # range. Sums of range ends are the shared count of every start; it changes at range ends only.
    at = computed(met.groupBy(*pair, "_h", "_b").agg(F.collect_list("_p").alias("_ps")), "_ps", F.array_sort("_ps"))
    ranges = F.transform("_ps", lambda p, i: F.struct(
        F.greatest(p - size(width) + 1, F.coalesce(F.get("_ps", i - F.col("_b")), F.lit(-1)) + 1, F.lit(0)).alias("first"), F.least(p, F.col("_n") - width).alias("last")))
    counted = at.select(*pair, F.explode(ranges).alias("r")).filter(F.col("r.first") <= F.col("r.last"))
    ends = F.explode(F.array(
        F.struct(F.col("r.first").alias("start"), F.lit(1).alias("step")), F.struct((F.col("r.last") + 1).alias("start"), F.lit(-1).alias("step")))).alias("e")
    start = F.greatest(F.lit(0), F.least(F.col("_p") - F.col("_o"), F.col("_n") - width))
    fitting = met.select(*pair, "_p", F.explode("_opens").alias("_o")).select(*pair, start.alias("_start"), F.lit(0).alias("_step"), F.lit(True).alias("_fits"))
    steps = counted.select(*pair, ends).select(*pair, F.col("e.start").alias("_start"), F.col("e.step").alias("_step"), F.lit(False).alias("_fits")).union(fitting)
    by_start = steps.groupBy(*pair, "_start").agg(F.sum("_step").alias("_step"), F.max("_fits").alias("_fits")).filter(F.col("_start") <= F.col("_n") - width)
    common = by_start.withColumn("_common", F.sum("_step").over(Window.partitionBy(*pair).orderBy("_start")))

    similar = F.col("_common") / (size(width) + size(F.col("_length")) - F.col("_common"))
    verified = common.withColumn("similarity", similar).filter(F.col("similarity") >= similarity - 1e-12)
    best = F.max(F.struct("similarity", "_fits", (-F.col("_start")).alias("s"))).alias("b")
    found = table(verified.groupBy(*pair).agg(best).select("_doc", "_item", width.alias("n_words"), (-F.col("b.s")).alias("start"), F.col("b.similarity").alias("similarity")))

    aggregates, fp = simhash("_h")
    windows = some.join(found, "_doc").select("doc_id", "_doc", "_item", F.explode(F.slice("_hashes", F.col("start") + 1, size(F.col("n_words")))).alias("_h"))
    marked = windows.groupBy("doc_id", "_doc", "_item").agg(*aggregates).select("doc_id", "_doc", "_item", fp.alias("_fp"))
    known = items.select("item_id", "_item", F.explode("_hashes").alias("_h")).groupBy("item_id", "_item").agg(*aggregates).select("item_id", "_item", fp.alias("_their_fp"))
    hamming = F.bit_count(F.col("_fp").bitwiseXOR(F.col("_their_fp"))).alias("hamming")
    out = found.join(marked, ["_doc", "_item"]).join(known, "_item").select("doc_id", "_doc", "item_id", "start", "n_words", "similarity", hamming)
    for k in lengths:
        long_enough = split.filter(F.size("w") >= k).select("doc_id", "_doc", F.posexplode(shingle_hashes(F.col("w"), k)).alias("_p", "_h"))
        same = long_enough.join(short.filter(F.col("_length") == k).select("item_id", F.get("_hashes", F.lit(0)).alias("_h")), "_h")
        out = out.union(same.groupBy("doc_id", "_doc", "item_id").agg(F.min("_p").alias("start")).select(
            "doc_id", "_doc", "item_id", "start", F.lit(k).alias("n_words"), F.lit(1.0).alias("similarity"), F.lit(0).alias("hamming")))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns. A row goes by its
    own doc_id and text, so null and repeated doc_ids take nothing else along."""
    dropped = table(_found(docs, benchmark, similarity).select(F.col("doc_id").alias("_dropped_id"), F.col("_doc").alias("_dropped_doc")).distinct())
    same = docs["doc_id"].eqNullSafe(dropped["_dropped_id"]) & (row_key() == dropped["_dropped_doc"])
    return docs.join(dropped, same, "left_anti")
