"""From raw documents to a training mixture, stage by stage.

Each stage is (name, function); the function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's docs. A classifier and a search on hashes
cannot be written in SQL, so ORACLE_SQL is None; tests hold the stages against brute force.

All stages keep or drop rows, never doc_ids: a null or repeated doc_id takes nothing else along. A null
text counts as empty: it is a copy of other empty texts, holds no benchmark item, and is toxic only if
the classifier's bias alone says so. Empty tables pass through; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plazalake.llm import decontaminate, exact, mixing, simhash, toxicity
from plazalake.llm.common import read, table, tune
from plazalake.llm.queries import MIX_WEIGHTS


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without rows predicted toxic; each is judged by its whole text, without labels all stay."""
    return toxicity.drop_toxic(docs, read(tune(spark), sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each text once every run of blanks is one space: that of the smallest doc_id, of
    ties any one."""
    tune(spark)
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each group of texts that chains of five-word similarity of 0.8 or more join: that
    of the smallest doc_id, of ties any one."""
    tune(spark)
    return simhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without rows that hold a benchmark item; without items all stay."""
    return decontaminate.drop_contaminated(docs, read(tune(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its text and its place in the mixture (block, slot, place, in_target); a
    null source counts as one of its own, and nothing is dropped."""
    tune(spark)
    return mixing.mix(docs, MIX_WEIGHTS, keep=("text",))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", drop_benchmark),
    ("mix_sources", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage keeps is written in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = table(docs)
    return docs
