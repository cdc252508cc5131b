"""Version histories of mapped elements, and what they say about construction years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.sources.osm import is_site


def summarise(versions: DataFrame) -> DataFrame:
    """One row per element from its versions (type, id, version, timestamp text, user, changeset, tags)."""
    order = "version"
    first = F.min_by(F.struct("timestamp", "user", "changeset"), order)
    last = F.max_by("tags", order)
    out = versions.withColumn("site", is_site(F.col("tags"))).groupBy("type", "id").agg(first.alias("f"), last.alias("t"), F.count("*").cast("int").alias("n_versions"), F.expr("min_by(timestamp, version) FILTER (WHERE site)").alias("tagged"))
    tag = lambda n: F.try_element_at("t", F.lit(n))
    year = lambda c: F.year(c.try_cast("timestamp"))
    return out.select(
        F.col("type").alias("osm_type"), F.col("id").alias("osm_id"), F.concat_ws("/", "type", F.col("id").cast("string")).alias("source_id"), tag("name").alias("name"), "n_versions", F.col("f.timestamp").alias("created_ts"),
        F.col("f.user").alias("created_user"), F.col("f.changeset").alias("created_changeset"), F.col("tagged").alias("datacenter_tagged_ts"), tag("start_date").alias("start_date_tag"),
        year(F.col("f.timestamp")).alias("created_year"), year(F.col("tagged")).alias("datacenter_tagged_year"),
    )


def start_date_validation(history: DataFrame) -> DataFrame:
    """Elements with a readable start year, and how far their creation is from it, by year."""
    real = F.regexp_extract("start_date_tag", r"([0-9]{4})", 1).try_cast("int")
    rows = history.withColumn("real_year", real).where(F.col("real_year").between(1850, 2100))
    return rows.select("source_id", "name", "real_year", F.col("created_year").alias("osm_created_year"), "datacenter_tagged_year", (F.col("created_year") - F.col("real_year")).alias("error_years"), "n_versions").orderBy("real_year", "source_id")
