"""Incremental snapshots as a stream: the latest version of each record, and counts by delivery window.

State is bounded by the watermark: rows later than ``lateness`` behind the newest
delivery are dropped from the stream and left to the batch comparison of snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_feed(spark: SparkSession, folder: str, schema, files_per_batch: int = 16) -> DataFrame:
    """New Parquet files below ``folder`` as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).parquet(folder)


def deduplicated(stream: DataFrame, keys: list[str], delivered: str, lateness: str = "60 days") -> DataFrame:
    """Each (key, content) once within the watermark."""
    return stream.withWatermark(delivered, lateness).dropDuplicatesWithinWatermark(keys)


def deliveries_by_window(stream: DataFrame, delivered: str, by: list[str], width: str = "1 day", lateness: str = "60 days") -> DataFrame:
    """Rows per window of delivery and the given columns."""
    return stream.withWatermark(delivered, lateness).groupBy(F.window(delivered, width), *by).agg(F.count("*").alias("rows"))


def upsert_latest(stream: DataFrame, target: str, keys: list[str], version: str, checkpoint: str) -> StreamingQuery:
    """Keeps ``target`` at the latest version of every key: each micro-batch is reduced to one row per key, merged and swapped in."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c not in keys]
        newest = F.max_by(F.struct(*rest), F.struct(F.col(version), F.xxhash64(*rest))).alias("r")
        old_path, new_path = f"{target}/v{(number + 1) % 2}", f"{target}/v{number % 2}"
        rows = batch
        if number:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(old_path))
        rows.groupBy(*keys).agg(newest).select(*keys, "r.*").select(*batch.columns).write.mode("overwrite").parquet(new_path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, batches: int) -> DataFrame:
    """The table after so many micro-batches."""
    return spark.read.parquet(f"{target}/v{(batches - 1) % 2}")
