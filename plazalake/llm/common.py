"""Shared helpers of the training-data operators: words, scratch tables, session settings."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.sources.scratch import new_path, scratch_dir

#: A word is a run of characters other than space and U+0009 to U+000D.
#: ``bytes.split()`` of UTF-8 text cuts at exactly these characters.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
BLANK_REGEX = r"[\x20\x09-\x0D]+"

#: Most rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS, BATCH_BYTES = "8192", str(8 << 20)

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker holds at once; the settings change no result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """While a scratch table is written, drop the shuffle files of that write when it is done."""
    before = spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
    except Exception as refused:  # the setting is unknown to this Spark version
        if "CANNOT_MODIFY" not in str(refused):
            raise
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back. This cuts lineage, outlives
    lost executors, gives the planner true sizes, and frees the shuffle files behind it."""
    spark = df.sparkSession
    path = new_path(spark)
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a number for each row, and that column's name. The numbers are stored with the
    rows: computed anew they could differ from job to job."""
    name = "_row"
    while name.lower() in map(str.lower, df.columns):
        name = f"_{name}"
    return table(df.withColumn(name, F.monotonically_increasing_id())), name


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's scratch tables; call it once results are stored."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """Text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identifies a row by its content, so null and repeated doc_ids join safely."""
    return F.xxhash64(F.coalesce(F.col(doc_id), F.lit(-1)), F.col(doc_id).isNull(), text_of(text))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
