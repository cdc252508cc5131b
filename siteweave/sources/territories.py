"""Service territories from a feature collection, plain or gzipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "features ARRAY<STRUCT<properties: STRUCT<Acronym: STRING, Utility: STRING, Type: STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>>>"


def read_territories(spark: SparkSession, path: str) -> DataFrame:
    """(utility, utility_name, utility_type, geometry): the acronym, or the name where it is blank; shapes as text."""
    f = spark.read.option("multiLine", True).schema(SCHEMA).json(path).select(F.explode("features").alias("f"))
    part = lambda name: F.col(f"f.properties.{name}")
    return f.select(F.coalesce(F.nullif(F.trim(part("Acronym")), F.lit("")), part("Utility")).alias("utility"), part("Utility").alias("utility_name"), part("Type").alias("utility_type"), shape_text(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry"))


def shape_text(kind: Column, coordinates: Column) -> Column:
    """WKT of the coordinates' JSON text, by turning pairs into 'lon lat' and brackets into parentheses."""
    pairs = F.regexp_replace(coordinates, r"\[\s*(-?[0-9.eE+-]+)\s*,\s*(-?[0-9.eE+-]+)\s*(?:,[^\]\[]*)?\]", "$1 $2")
    return F.when(kind.isin("Polygon", "MultiPolygon"), F.concat(F.upper(kind), F.lit(" "), F.translate(pairs, "[]", "()")))
