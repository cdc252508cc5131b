"""Facilities of the interconnection registry: snapshot scan and rows to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave import dims, vocabulary
from siteweave.functions.keys import any_timestamp
from siteweave.operators.lookups import assign_state
from siteweave.schemas import conform

FACILITY = (
    "id BIGINT, org_id BIGINT, org_name STRING, name STRING, aka STRING, address1 STRING, address2 STRING, city STRING, state STRING, zipcode STRING, country STRING, status STRING, clli STRING, website STRING, "
    "latitude DOUBLE, longitude DOUBLE, net_count BIGINT, ix_count BIGINT, carrier_count BIGINT, campus_id BIGINT, available_voltage_services ARRAY<STRING>, diverse_serving_substations BOOLEAN, property STRING, created STRING, updated STRING"
)
KEPT_JSON = ("aka", "available_voltage_services", "campus_id", "carrier_count", "diverse_serving_substations", "id", "ix_count", "name", "net_count", "org_id", "org_name", "property")
BOXES = [(r[0], r[6]) for r in vocabulary.JURISDICTIONS] + list(vocabulary.EXTRA_BOXES)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Rows of snapshot files, each one array of objects, with the snapshot date of the folder."""
    rows = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").schema(FACILITY).json(path)
    return rows.withColumn("snapshot", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1))


def newest(rows: DataFrame, time: Column) -> DataFrame:
    """One row of each id: the latest updated, then the latest by ``time``."""
    rest = F.struct(*[c for c in rows.columns if c != "id"])
    order = F.struct(any_timestamp(F.col("updated")), time, F.xxhash64("name", "address1", "latitude", "longitude"))
    return rows.groupBy("id").agg(F.max_by(rest, order).alias("_r")).select("id", "_r.*")


def to_records(rows: DataFrame) -> DataFrame:
    """Records of rows in service (no status counts as such) with coordinates; the state is assigned, not taken."""
    kept = rows.where((F.coalesce("status", F.lit("ok")) == "ok") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    kept = assign_state(kept, dims.zip3_ranges(rows.sparkSession), BOXES, "state", "zipcode", "latitude", "longitude")
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    key = F.col("id").cast("string")
    out = kept.select(
        F.lit("peeringdb").alias("source"), key.alias("source_id"), F.concat(F.lit("https://www.peeringdb.com/fac/"), key).alias("source_url"), "name", F.col("org_name").alias("operator_raw"),
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.nullif(F.concat_ws(" ", text("address1"), text("address2")), F.lit("")).alias("address"), "city", F.col("assigned_state").alias("state"), F.col("zipcode").alias("postcode"),
        text("clli").alias("clli"), text("website").alias("website"), F.col("net_count").alias("pdb_net_count"), F.col("ix_count").alias("pdb_ix_count"), F.col("carrier_count").alias("pdb_carrier_count"), F.col("campus_id").alias("campus_raw"),
        F.to_json(F.struct(*KEPT_JSON), {"ignoreNullFields": "false"}).alias("raw_json"),
    )
    return conform(out)
