"""Small reference files and published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_reference(spark: SparkSession, path: str, schema: str, comments: bool = True) -> DataFrame:
    """A CSV file with a header under a stated schema; lines that start with # are comments."""
    reader = spark.read.option("header", True).schema(schema)
    return (reader.option("comment", "#") if comments else reader).csv(path)


def read_published(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A published table: Parquet, or CSV under a stated schema."""
    return spark.read.option("header", True).schema(schema).csv(path) if schema else spark.read.parquet(path)
