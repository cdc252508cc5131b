"""Mapped elements: the query text, snapshot scan, and elements to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions.projection import ring_centroid, ring_wkt
from siteweave.functions.ratings import year_of
from siteweave.schemas import conform
from siteweave.vocabulary import SITE_TAGS

ELEMENT = (
    "type STRING, id BIGINT, lat DOUBLE, lon DOUBLE, bounds STRUCT<minlat: DOUBLE, minlon: DOUBLE, maxlat: DOUBLE, maxlon: DOUBLE>, "
    "center STRUCT<lat: DOUBLE, lon: DOUBLE>, geometry ARRAY<STRUCT<lat: DOUBLE, lon: DOUBLE>>, tags MAP<STRING, STRING>"
)
MIRRORS = ("https://overpass-api.de/api/interpreter", "https://overpass.kumi.systems/api/interpreter", "https://overpass.private.coffee/api/interpreter")


def query_text(state: str) -> str:
    """Elements of one jurisdiction with one of the site tags, with tags and geometry."""
    lines = [f'  nwr(area.a)["{key}"="{value}"];' for key, values in SITE_TAGS.items() for value in values]
    return "\n".join([f'[out:json][timeout:300];\narea["ISO3166-2"="US-{state.upper()}"]["admin_level"="4"]->.a;\n(', *lines, ");\nout tags geom;"])


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Elements of snapshot files ``<state>/<date>/*.json`` with both as columns."""
    files = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").schema(f"elements ARRAY<STRUCT<{_struct(ELEMENT)}>>").json(path)
    named = files.select(F.explode("elements").alias("e"), F.col("_metadata.file_path").alias("file"))
    return named.select("e.*", F.regexp_extract("file", r"/([A-Z]{2})/(\d{4}-\d{2}-\d{2})/[^/]+$", 1).alias("file_state"), F.regexp_extract("file", r"/([A-Z]{2})/(\d{4}-\d{2}-\d{2})/[^/]+$", 2).alias("snapshot"))


def _struct(ddl: str) -> str:
    """Column DDL as struct fields."""
    out, depth, parts, current = [], 0, [], ""
    for sign in ddl:
        depth += (sign == "<") - (sign == ">")
        if sign == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += sign
    for part in [*parts, current]:
        name, kind = part.strip().split(" ", 1)
        out.append(f"{name}: {kind}")
    return ", ".join(out)


def latest_snapshot(df: DataFrame, column: str = "snapshot", within: str | None = None) -> DataFrame:
    """Rows of the latest snapshot only; of each value of ``within``, where snapshots are taken by jurisdiction."""
    keys = [within] if within else []
    # One row, or one for each jurisdiction.
    return df.join(F.broadcast(df.groupBy(*keys).agg(F.max(column).alias(column))), [*keys, column], "left_semi")


def is_site(tags: Column) -> Column:
    tests = [F.try_element_at(tags, F.lit(key)).isin(*values) for key, values in SITE_TAGS.items()]
    return F.coalesce(tests[0], F.lit(False)) | F.coalesce(tests[1], F.lit(False))


def to_records(elements: DataFrame) -> DataFrame:
    """Records of elements that have a position; a closed ring gives its centroid and outline."""
    tag = lambda *names: F.coalesce(*[F.nullif(F.try_element_at("tags", F.lit(n)), F.lit("")) for n in names])
    columns = set(elements.columns)
    ring = F.when(F.size("geometry") >= 3, F.col("geometry"))
    elements = elements.withColumn("_centre", ring_centroid(ring))
    centre = F.col("_centre")
    start = F.try_element_at("geometry", F.lit(1))
    middle = F.col("center") if "center" in columns else F.lit(None).cast("struct<lat: double, lon: double>")
    pick = lambda part: F.when(F.col("type") == "node", F.col(part)).otherwise(F.coalesce(centre[part], start[part], middle[part]))
    key = F.concat_ws("/", "type", F.col("id").cast("string"))
    # The jurisdiction it was asked for says more than the tag.
    state = F.coalesce(F.nullif(F.col("file_state"), F.lit("")), tag("addr:state")) if "file_state" in columns else tag("addr:state")
    rows = elements.select(
        F.lit("osm").alias("source"), key.alias("source_id"), F.concat(F.lit("https://www.openstreetmap.org/"), key).alias("source_url"), tag("name", "operator", "short_name").alias("name"), tag("operator").alias("operator_raw"),
        pick("lat").alias("lat"), pick("lon").alias("lon"), F.nullif(F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street")), F.lit("")).alias("address"), tag("addr:city").alias("city"), state.alias("state"),
        tag("addr:postcode").alias("postcode"), tag("construction", "disused").alias("status_raw"), year_of(tag("start_date")).alias("year_built"), tag("building:levels").alias("building_levels"),
        F.when(F.col("type") != "node", ring_wkt(ring)).alias("geometry_wkt"), tag("building").isNotNull().alias("is_building"), tag("clli").alias("clli"), tag("website").alias("website"), F.to_json("tags").alias("raw_json"),
    )
    return conform(rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()))
