"""Writes published tables as Parquet and CSV, features as lines of GeoJSON, and a package description.

All data is written by the executors; only the description, a few kilobytes from the
schemas, is made on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteweave.functions.wkt import parse_polygons
from siteweave.schemas import publish
from siteweave.storage import ship


def write_table(df: DataFrame, folder: str, name: str, columns: list[str] | None = None, partition: str | None = None) -> None:
    """``folder/name.parquet`` and ``folder/name.csv``, with missing columns null."""
    out = publish(df, [*columns, *([partition] if partition and partition not in columns else [])]) if columns else df
    for kind in ("parquet", "csv"):
        writer = out.write.mode("overwrite").format(kind)
        if kind == "csv":
            writer = writer.option("header", True)
        if partition:
            writer = writer.partitionBy(partition)
        writer.save(f"{folder}/{name}.{kind}")


def point_features(df: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row with a position, as text."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))
    return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def footprint_features(df: DataFrame, properties: list[str], shape: str = "geometry_wkt", area: str = "footprint_sqft") -> DataFrame:
    """One feature per row with a readable outline and a measured area."""
    ship(df.sparkSession)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = []
            for text, kept in zip(batch[shape], batch["kept"]):
                polygons = [[[*map(list, ring), list(ring[0])] for ring in rings] for rings in parse_polygons(text)]
                if polygons:
                    geometry = {"type": "Polygon", "coordinates": polygons[0]} if len(polygons) == 1 else {"type": "MultiPolygon", "coordinates": polygons}
                    lines.append(json.dumps({"type": "Feature", "geometry": geometry, "properties": json.loads(kept)}))
            yield pd.DataFrame({"value": lines}, dtype="object")

    rows = df.where(F.col(shape).isNotNull() & F.col(area).isNotNull()).select(shape, F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}).alias("kept"))
    return rows.mapInPandas(make, "value string")


def write_features(features: DataFrame, folder: str, name: str) -> bool:
    """Lines of features; nothing is written and False returned where there are none."""
    if features.isEmpty():
        return False
    features.write.mode("overwrite").text(f"{folder}/{name}.geojsonl")
    return True


def package_description(name: str, title: str, tables: dict[str, DataFrame], sources: list[dict], descriptions: dict[str, str] | None = None) -> dict:
    """A tabular data package: fields of every table with type and description, and the sources used."""
    kinds = {T.DoubleType: "number", T.FloatType: "number", T.IntegerType: "integer", T.LongType: "integer", T.BooleanType: "boolean", T.DateType: "date", T.TimestampType: "datetime"}
    described = descriptions or {}

    def field(f: T.StructField) -> dict:
        out = {"name": f.name, "type": kinds.get(type(f.dataType), "string")}
        return out | ({"description": described[f.name]} if f.name in described else {})

    resources = [{"name": n.replace("_", "-"), "path": f"{n}.csv", "format": "csv", "encoding": "utf-8", "schema": {"fields": [field(f) for f in df.schema.fields]}} for n, df in tables.items()]
    return {"profile": "tabular-data-package", "name": name, "title": title, "sources": sources, "resources": resources}


#: What the fields of the published tables hold.
FIELD_TEXTS = {
    "state": "Jurisdiction the site lies in",
    "facility_id": "Slug of the name and digest of slug and position",
    "name": "Name in the most trusted source that has one",
    "operator": "Operator, or the text of the source where none is known",
    "operator_confidence": "How the operator was found: alias, alias_token, unattributed or unresolved",
    "facility_class": "colocation, wholesale, hyperscale, telecom or unknown",
    "lat": "Latitude of the largest measured outline, else the mean of the records",
    "lon": "Longitude, likewise",
    "utility": "Smallest retail territory that holds the site",
    "utility_candidates": "All retail territories that hold the site",
    "partial_occupancy": "More storeys than are credited: one tenant of a tower",
    "footprint_sqft": "Measured outline, square feet",
    "best_power_mw": "Load of the best evidence, MW",
    "power_ci_low_mw": "Lower bound of that load, MW",
    "power_ci_high_mw": "Upper bound of that load, MW",
    "power_tier": "Evidence of the load: A_attested, B_generator or C_area",
    "n_power_methods": "Kinds of evidence for the site's load",
    "est_annual_gwh": "Energy a year at the assumed utilisation, GWh",
    "source_list": "Sources of the records, by name",
    "n_sources": "Number of those sources",
    "method": "Evidence of the estimate",
    "basis": "What the estimate is made of",
    "it_load_mw": "Load of the estimate, MW",
    "pue_used": "Ratio of total to IT power that was assumed",
    "assumptions_json": "Assumptions of the estimate",
    "source_id": "Id of the record in its source",
    "source_url": "Where the record or the figure can be seen",
    "facilities": "Sites of the jurisdiction",
    "sum_it_load_mw": "Load of all sites with an estimate, MW",
    "anchor_twh": "Published energy of the jurisdiction, TWh a year",
}


def write_json(df: DataFrame, folder: str, name: str) -> None:
    """The few rows of a small result as lines of JSON in one file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}.json")


def write_text(df: DataFrame, folder: str, name: str) -> None:
    """Raw snapshot rows as JSON lines."""
    df.write.mode("overwrite").json(f"{folder}/{name}.json")


def write_description(spark, description: dict, folder: str) -> None:
    spark.createDataFrame([(json.dumps(description, indent=2),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/datapackage.json")
