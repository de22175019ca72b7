"""New source files picked up once each, their years refreshed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from panelweave.operators.select import keep_one
from panelweave.sources import keyindex
from panelweave.sources.refresh import refresh_years
from panelweave.session import stage


def follow_files(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str, event_id: str, year: str = "year") -> StreamingQuery:
    """Load files that arrived since the last run, then stop.

    A batch writes the years it mentions and those its events stood in before,
    so an event whose year was revised leaves its old partition. Where an event
    stood is looked up in a key index beside the table, of which a batch reads
    only its own buckets. An event seen before is replaced by its row from the
    newest file. The merged years are staged before they overwrite the
    partitions they were read from.
    """
    index = f"{out.rstrip('/')}_keys"

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = stage(batch.withColumn("_old", F.lit(0)))
        years = {r[year] for r in fresh.select(year).distinct().collect()}  # calendar years: a few dozen at most
        if not years:
            return
        rows = fresh
        if keyindex.exists(session, out):
            held = session.read.schema(schema).parquet(out)
            if not keyindex.exists(session, index):
                keyindex.add(held, index, event_id, year, -1)
            keyindex.compact(session, index, number)
            years |= {r["year"] for r in keyindex.years_of(fresh, index, event_id).collect()}
            kept = held.filter(F.col(year).isin(sorted(years))).select(*schema.names)
            rows = fresh.unionByName(kept.withColumns({"_old": F.lit(1), "_age": F.lit(0).cast("bigint"), "_file": F.lit("")}))
        merged = stage(keep_one(rows, [event_id], [F.col("_old"), F.col("_age"), F.col("_file")]).select(*schema.names))
        # listed before it is written: a batch that fails in between is repeated and finds both places
        keyindex.add(merged.join(fresh.select(event_id).distinct(), event_id, "left_semi"), index, event_id, year, number)
        refresh_years(merged, out, sorted(years), year)

    stream = spark.readStream.schema(schema).parquet(folder)
    dated = stream.select("*", (-F.unix_micros("_metadata.file_modification_time")).alias("_age"), F.col("_metadata.file_path").alias("_file"))
    return dated.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
