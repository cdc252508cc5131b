"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions.keys import any_timestamp
from siteweave.operators.snapshot_diff import canonical_rows, snapshot_changes
from siteweave.storage import table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    peering = table(spark, sf_dir, "peeringdb_fac")
    mapped = table(spark, sf_dir, "overpass_datacenters")
    ignore = ("retrieved_at", "created", "updated", "id")
    a = canonical_rows(peering, "peeringdb", F.concat(F.lit("peeringdb|"), F.col("id").cast("string")), "snapshot_date", any_timestamp(F.col("updated")), F.col("retrieved_at"), ignore, ("latitude", "longitude"))
    b = canonical_rows(mapped, "osm", F.concat(F.lit("osm|"), F.col("type"), F.lit("/"), F.col("id").cast("string")), "snapshot_date", F.lit(None).cast("timestamp"), F.col("retrieved_at"), (*ignore, "type"), ("lat", "lon"))
    found = snapshot_changes(a.unionByName(b))
    return found.select(F.col("series").alias("source"), F.substring_index("key", "|", -1).alias("source_id"), F.date_format("snap", "yyyy-MM-dd").alias("snapshot_date"), "change")


QUERIES = {"p7_found": p7_found}
_PLAIN = ("aka", "address1", "address2", "city", "clli", "country", "name", "org_name", "property", "state", "status", "website", "zipcode")
_NUMBERS = ("campus_id", "carrier_count", "diverse_serving_substations", "ix_count", "net_count", "org_id")
_TRIMMED = "coalesce(trim({}, chr(9) || chr(10) || chr(13) || ' ' || chr(160)), '')"
_NEAR = "(({0} IS NULL AND {1} IS NULL) OR coalesce(abs({0} - {1}) < 0.000000999999, false))"
_CONTENT = " || chr(0) || ".join([*(_TRIMMED.format(c) for c in _PLAIN), *(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _NUMBERS), "array_to_string(list_sort(list_transform(available_voltage_services, lambda x: trim(x))), chr(31))"]).replace("chr(0)", "chr(1)")
_POINTS = " AND ".join(_NEAR.format(f"then_.{c}", f"now_.{c}") for c in ("c1", "c2", "c3", "c4", "c5", "c6"))

SQL: dict[str, str] = {
    "p7_found": f"""
WITH p AS (SELECT 'peeringdb' AS series, 'peeringdb|' || id AS k, snapshot_date AS d, TRY_CAST(updated AS TIMESTAMPTZ) AS u, retrieved_at AS r, {_CONTENT} AS t, CASE WHEN isnan(latitude) THEN NULL ELSE latitude END AS c1, CASE WHEN isnan(longitude) THEN NULL ELSE longitude END AS c2,
  CAST(NULL AS DOUBLE) AS c3, CAST(NULL AS DOUBLE) AS c4, CAST(NULL AS DOUBLE) AS c5, CAST(NULL AS DOUBLE) AS c6, CAST([] AS STRUCT(lat DOUBLE, lon DOUBLE)[]) AS g FROM peeringdb_fac),
o AS (SELECT 'osm', 'osm|' || type || '/' || id, snapshot_date, CAST(NULL AS TIMESTAMPTZ), retrieved_at,
  array_to_string(list_sort(list_transform(list_filter(map_entries(tags), lambda e: coalesce(trim(e.value), '') <> ''), lambda e: e.key || chr(30) || trim(e.value))), chr(31)),
  lat, lon, bounds.minlat, bounds.minlon, bounds.maxlat, bounds.maxlon, coalesce(geometry, []) FROM overpass_datacenters),
x AS (SELECT * FROM p UNION ALL SELECT * FROM o),
y AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series, k, d ORDER BY u DESC NULLS LAST, r DESC, t) AS n FROM x) WHERE n = 1),
s AS (SELECT series, d, lag(d) OVER (PARTITION BY series ORDER BY d) AS b FROM (SELECT DISTINCT series, d FROM y)),
now_ AS (SELECT y.* FROM y JOIN s ON s.series = y.series AND s.d = y.d WHERE s.b IS NOT NULL),
then_ AS (SELECT y.* REPLACE (s.d AS d) FROM y JOIN s ON s.series = y.series AND s.b = y.d),
j AS (SELECT coalesce(now_.series, then_.series) AS source, coalesce(now_.k, then_.k) AS k, coalesce(now_.d, then_.d) AS d,
  CASE WHEN then_.k IS NULL THEN 'added' WHEN now_.k IS NULL THEN 'removed'
       WHEN NOT (now_.t = then_.t AND {_POINTS} AND len(now_.g) = len(then_.g)
            AND len(list_filter(range(1, len(now_.g) + 1), lambda i: NOT coalesce(abs(now_.g[i].lat - then_.g[i].lat) < 0.000000999999 AND abs(now_.g[i].lon - then_.g[i].lon) < 0.000000999999, false))) = 0) THEN 'changed' END AS change
  FROM now_ FULL JOIN then_ ON now_.series = then_.series AND now_.k = then_.k AND now_.d = then_.d)
SELECT source, split_part(k, '|', 2) AS source_id, strftime(d, '%Y-%m-%d') AS snapshot_date, change FROM j WHERE change IS NOT NULL
"""
}
