"""An index from a row's key to the partition it stands in, so that a batch finds old rows without reading the table.

Parquet files of (key, year, batch) in ``BUCKETS`` folders by the key's hash,
sorted by key. A batch reads only the folders its own keys fall into and
appends one file to each. A key may be listed under several years; the newest
batch is right, the others cost a partition read for nothing. Folders with
more than ``FILES`` files are compacted to one entry a key before a batch
begins, from finished batches only, so a batch that is repeated after a
failure still finds the rows that it had not moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.session import stage

BUCKETS, FILES = 256, 8


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _folder(spark, path)
    return system.exists(at)


def _entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, year int, batch bigint, bucket int").parquet(path)


def add(rows: DataFrame, path: str, key: str, year: str, batch: int) -> None:
    """List the rows' keys under their years."""
    listed = rows.select(F.col(key).cast("string").alias("key"), F.col(year).cast("int").alias("year"), F.lit(batch).cast("bigint").alias("batch"), bucket(key).alias("bucket"))
    listed.distinct().repartition("bucket").sortWithinPartitions("bucket", "key").write.mode("append").partitionBy("bucket").parquet(path)


def years_of(rows: DataFrame, path: str, key: str) -> DataFrame:
    """(year): the partitions in which rows of these keys may stand; reads the touched folders only."""
    spark = rows.sparkSession
    touched = sorted(r["bucket"] for r in rows.select(bucket(key).alias("bucket")).distinct().collect())  # BUCKETS at most
    held = _entries(spark, path).filter(F.col("bucket").isin(touched))
    return held.join(rows.select(F.col(key).cast("string").alias("key")).distinct(), "key", "left_semi").select("year").distinct()


def crowded(spark: SparkSession, path: str, files: int = FILES) -> list[int]:
    """Folders that hold more than ``files`` files."""
    system, at = _folder(spark, path)
    out = []
    for folder in system.listStatus(at) if system.exists(at) else []:
        name = folder.getPath().getName()
        if name.startswith("bucket=") and sum(f.getPath().getName().endswith(".parquet") for f in system.listStatus(folder.getPath())) > files:
            out.append(int(name.removeprefix("bucket=")))
    return sorted(out)


def compact(spark: SparkSession, path: str, batch: int, files: int = FILES) -> list[int]:
    """Rewrite crowded folders with one entry a key from batches before ``batch``; later entries stay as they are."""
    due = crowded(spark, path, files)
    if due:
        held = _entries(spark, path).filter(F.col("bucket").isin(due))
        latest = held.filter(F.col("batch") < batch).groupBy("bucket", "key").agg(F.max_by("year", "batch").alias("year"), F.max("batch").alias("batch"))
        kept = stage(latest.unionByName(held.filter(F.col("batch") >= batch)))
        spread = kept.repartition("bucket").sortWithinPartitions("bucket", "key")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return due
