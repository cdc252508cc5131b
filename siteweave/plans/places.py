"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.operators.spatial import containing_regions, near_pairs
from siteweave.storage import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "facilities").select(F.col("facility_id").alias("id"), "lat", "lon")
    regions = table(spark, sf_dir, "utilities").select(F.trim("utility").alias("region"), F.col("geometry").alias("shape"))
    near = near_pairs(points, 200.0).select(F.lit("near").alias("kind"), F.col("left_id").alias("facility_id"), F.col("right_id").alias("other_key"))
    inside = containing_regions(points, regions).select(F.lit("inside").alias("kind"), F.col("id").alias("facility_id"), F.col("region").alias("other_key"))
    return near.unionByName(inside)


QUERIES = {"p2_found": p2_found}
SQL: dict[str, str] = {
    "p2_found": r"""
WITH f AS (SELECT DISTINCT facility_id, lat, lon FROM facilities WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND NOT (lat = 0 AND lon = 0)),
n AS (SELECT a.facility_id, b.facility_id AS other_key, 2 * 6371008.8 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS m
      FROM f a JOIN f b ON a.facility_id < b.facility_id AND abs(a.lat - b.lat) < 0.0019),
shape AS (SELECT trim(utility) AS code, geometry, row_number() OVER () AS s FROM (SELECT DISTINCT utility, geometry FROM utilities WHERE geometry LIKE '%(%')),
ring AS (SELECT code, s, list_transform(regexp_extract_all(t, '-?[0-9.]+(?:[eE][-+]?[0-9]+)?'), lambda x: CAST(x AS DOUBLE)) AS v FROM (SELECT code, s, unnest(regexp_extract_all(geometry, '\(([^()]*)\)', 1)) AS t FROM shape)),
step AS (SELECT code, s, v, unnest(range(1, len(v) - 2, 2)) AS i FROM ring),
edge AS (SELECT code, s, v[i] AS x1, v[i + 1] AS y1, v[i + 2] AS x2, v[i + 3] AS y2 FROM step),
hit AS (SELECT code, s, facility_id FROM edge JOIN f ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT 'near' AS kind, facility_id, other_key FROM n WHERE m <= 200 UNION ALL SELECT DISTINCT 'inside', facility_id, code FROM hit
"""
}
