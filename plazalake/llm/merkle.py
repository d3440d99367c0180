"""Merkle manifest of a dataset: a tree of three children for each source, and a tree over the sources.

Rows get their place within the source from one range sort: places follow from the number within a
partition and from the counts of the partitions before. A pass then climbs six levels at once inside
blocks of 729 consecutive nodes. Each level takes lag and lead columns at a fixed offset (1, 3, 9 ...
rows, since the first row of a node stands for it), masked by the slot in the run and by the run's
length: they are the siblings, and the first child's row hashes the parent. Blocks of all passes of a
level are equal in size, so no source, however large, is ordered in one task; on the way down a row
meets its block's path, which at most 729 rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import table

ARITY, LEVELS = 3, 6
#: Nodes of one block.
SPAN = ARITY**LEVELS
_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts joined; a null part makes it null."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as the text that is hashed: UTF-8 byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(start: Column, steps: Column) -> Column:
    """The root that ``start`` leads to over the siblings ``steps``."""
    return F.aggregate(steps, start, lambda h, s: digest(s["left"], h, s["right"]))


def siblings(steps: Column) -> Column:
    """The siblings of all levels, joined from left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def positions(df: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos``, the place of a row of ``tree`` in ``order``, from 0, and ``n``, the rows of
    that tree. Both are computed without ordering a tree in one task; ``order`` ends in a column that
    tells all rows apart."""
    w = Window.partitionBy(tree).orderBy("_part")
    stored = table(df.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33).alias("_part")  # the upper bits of that number name the partition
    parts = stored.groupBy(tree, part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(tree, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(Window.partitionBy(tree)).alias("n"))
    placed = stored.withColumn("_part", part).join(parts, [tree, "_part"])
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def lift(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, n, hash) with ``block``, ``steps`` (the siblings of up to six levels, as long
    as more than one node remains) and ``top``, the block's node above them, on the block's first row."""
    over = "OVER (PARTITION BY tree, block ORDER BY pos)"
    df = nodes.selectExpr("* EXCEPT (hash)", f"pos div {SPAN} AS block", "hash AS _node")
    for level in range(LEVELS):
        width = ARITY**level
        near = [f"{side}(_node, {i * width}) {over} AS _{side}{i}" for side in ("lag", "lead") for i in (1, 2)]
        # place in the run of three, nodes in that run, and whether the tree has more than one node here
        masks = [f"pos div {width} % {ARITY} AS _slot", f"least({ARITY}, (n + {width - 1}) div {width} - pos div {ARITY * width} * {ARITY}) AS _length", f"n > {width} AS _more"]
        left = "concat(if(_slot = 2, _lag2, ''), if(_slot >= 1, _lag1, ''))"
        right = "concat(if(_slot + 1 < _length, _lead1, ''), if(_slot + 2 < _length, _lead2, ''))"
        df = df.selectExpr("*", *near, *masks).selectExpr(
            "* EXCEPT (_node, _lag1, _lag2, _lead1, _lead2, _slot, _length, _more)",
            f"if(_more AND _node IS NOT NULL, struct({left} AS left, {right} AS right), NULL) AS _step{level}",
            f"if(pos % {ARITY * width} = 0, if(_more, sha2(concat(_node, {right}), 256), _node), NULL) AS _node",
        )
    # the first row of a node has its siblings; the node's other rows take them over
    names = [f"_step{level}" for level in range(LEVELS)]
    filled = ", ".join(f"last({name}, true) {over[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)" for name in names)
    return df.selectExpr(f"* EXCEPT (_node, {', '.join(names)})", f"filter(array({filled}), s -> s IS NOT NULL) AS steps", "_node AS top")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All passes, as stored tables, and (tree, top) of every tree."""
    passes, most = [], None
    while most is None or most > 1:
        passes.append(table(lift(nodes)))
        ceiling = F.expr(f"(n + {SPAN - 1}) div {SPAN}")
        nodes = passes[-1].filter(F.col("top").isNotNull()).select("tree", F.col("block").alias("pos"), ceiling.alias("n"), F.col("top").alias("hash"))
        most = nodes.agg(F.max("n")).first()[0] or 1
    return passes, nodes.select("tree", F.col("hash").alias("top"))


def manifest(rows: DataFrame, source: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """``rows`` with ``subroot`` (of the row's source), ``root`` (of all) and ``steps``, the siblings
    from the row's leaf by way of its subroot to the root.

    ``rows`` has a column ``leaf`` with digests. Per source, leaves ascend by ``order`` (null first); rows
    that tie there ascend by leaf, so that the order of the input does not matter, and rows repeated
    whole are leaves of their own. A null source is a source of its own and comes first. Other columns
    are carried along, whatever their names; an empty table gives an empty manifest.
    """
    given = F.struct(*rows.columns).alias("row")
    tree = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    keyed = rows.select(tree.alias("tree"), F.col(order).alias("key"), F.col(leaf).alias("hash"), F.monotonically_increasing_id().alias("tie"), given)
    passes, subroots = _climb(positions(table(keyed), "tree", ["key", "hash", "tie"]).drop("key", "tie"))

    forest = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("hash"))
    above, roots = _climb(positions(forest, "tree", ["name"]))
    path = above[-1].join(roots.withColumnRenamed("top", "root"), "tree").drop("top")
    for lower in reversed(above[:-1]):
        path = _below(lower, path, ["root"])
    path = path.select(F.col("name").alias("tree"), F.col("steps").alias("_above"), "root")

    # a tree has one block at the last pass
    path = passes[-1].drop("top").join(subroots.withColumnRenamed("top", "subroot"), "tree").join(path, "tree")
    path = path.withColumn("steps", F.concat("steps", "_above")).drop("_above")
    for lower in reversed(passes[:-1]):
        path = _below(lower, path, ["subroot", "root"])
    return path.select("row.*", "subroot", "root", F.col("steps").cast(_STEPS).alias("steps"))


def _below(lower: DataFrame, upper: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Rows of a pass with the path of the block they are in behind their own steps."""
    theirs = upper.select("tree", F.col("pos").alias("block"), F.col("steps").alias("_above"), *carried)
    return lower.drop("top").join(theirs, ["tree", "block"]).withColumn("steps", F.concat("steps", "_above")).drop("_above", "block")


def document_manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    Where 2 divides the unsigned crc32 of the decimal doc_id (null: of the empty text), the row is
    tampered with: the text loses its line feeds. ``folded_root`` is what the leaf then leads to over the
    original siblings, ``verified`` whether that is the root. Nulls hash as ``-``, and differ from empty texts.
    """
    def leaf_of(text: Column) -> Column:
        return leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    changed = tampered & F.contains("text", F.lit("\n"))
    # only a text that changes is hashed twice
    then = F.when(changed, leaf_of(F.replace("text", F.lit("\n"), F.lit(""))))
    found = manifest(docs.select("doc_id", "source", leaf_of(F.col("text")).alias("leaf"), then.alias("then")))
    folded = fold(F.coalesce("then", "leaf"), F.col("steps"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
