"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.session import stage

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH = 8 << 20
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character untouched.

    ``lower`` is far quicker than ``translate`` and gives the same where it
    changes nothing but ASCII letters, which holds when it leaves the other
    characters of the value alone.
    """
    beyond = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    return F.when(F.lower(beyond) == beyond, F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def ascii_strip(c: Column) -> Column:
    """White space [\\x20\\x09-\\x0D] removed from both ends."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def hash128(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes under different seeds, together a 128-bit key; never null."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def small_batches(spark: SparkSession) -> None:
    """Hold the Arrow batches that go to Python workers to ``BATCH`` bytes, however long the texts are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH:
        spark.conf.set(key, str(BATCH))


def encoded(texts: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of one text after the other; what the batch held is given back at its end."""
    for value in texts.cast(pa.binary()):
        yield value.as_py()
    pa.default_memory_pool().release_unused()


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    """Words of each text; null has none. ``bytes.split`` splits at exactly the ASCII white space."""
    return pa.array([0 if t is None else len(t.split()) for t in encoded(texts)], pa.int64())


def numbered(df: DataFrame, order: Sequence[str], into: str = "rank") -> DataFrame:
    """``df`` with each row's 0-based place in the given order (nulls first), as one sequence over all rows.

    Rows are dealt by range and sorted inside their range; a range's first
    place is the sum of the ranges before it, one small row a range. No task
    sees more than its range. The numbers are frozen by a staged table.
    """
    spark = df.sparkSession
    local = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    local = stage(local).withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each range, so as many as there are shuffle partitions at most
    starts = F.broadcast(sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    return local.join(starts, "_range").withColumn(into, F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")
