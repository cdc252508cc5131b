"""Emission units of permitted facilities: extract scan, units to records and a generator inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions.ratings import is_generator, rating_kw
from siteweave.operators.analytics import keep_first
from siteweave.schemas import conform
from siteweave.vocabulary import NAICS

COLUMNS = ("eis_facility_id", "company_name", "site_name", "primary_naics_code", "site_latitude", "site_longitude", "address", "city", "zip_code", "eis_unit_id", "unit_type", "unit_description", "process_description", "scc")


def read_extracts(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, empty fields as empty text, with state and snapshot of the folders."""
    schema = ", ".join(f"{c} STRING" for c in COLUMNS)
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("emptyValue", "").option("quote", '"').option("escape", '"').schema(schema).csv(path)
    file = F.col("_metadata.file_path")
    named = rows.withColumns({"state": F.regexp_extract(file, r"/([A-Z]{2})/[^/]+/[^/]+$", 1), "snapshot": F.regexp_extract(file, r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1)})
    return named.select(*[F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS], "state", "snapshot")


def region_extract(raw: DataFrame, states: list[str]) -> DataFrame:
    """Units of the wanted industries and states from a raw region file; of repeated (facility, unit) the first."""
    rows = raw.where(F.upper("state").isin(*states) & F.trim("primary_naics_code").isin(*NAICS)).withColumn("_ord", F.monotonically_increasing_id())
    kept = keep_first(rows, ["eis_facility_id", "eis_unit_id"], ["_ord"]).drop("_ord")
    return kept.select("state", *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in COLUMNS])


def _text(name: str):
    c = F.trim(name)
    return F.when((c != "") & (F.lower(c) != "nan"), c)


def by_facility(units: DataFrame, order: str = "eis_unit_id") -> DataFrame:
    """One row per facility: attributes of its first unit, counts of units, generators and ratings; partial sums before the shuffle."""
    rows = units.withColumn("gen", is_generator(F.col("scc"), F.col("unit_description"), F.col("process_description")))
    rows = rows.withColumn("kw", F.when(F.col("gen"), F.coalesce(rating_kw(F.concat_ws(" ", "unit_description", "process_description")))))
    first = F.struct(*[c for c in ("company_name", "site_name", "primary_naics_code", "site_latitude", "site_longitude", "address", "city", "zip_code", "state") if c in units.columns])
    return rows.groupBy("eis_facility_id").agg(
        F.min_by(first, F.struct(order, F.xxhash64(first))).alias("f"), F.count_if("gen").cast("int").alias("n_generator_units"), F.count("*").cast("int").alias("n_units_total"),
        F.count("kw").cast("int").alias("n_units_rated"), F.coalesce(F.sum("kw"), F.lit(0.0)).alias("rated_kw_sum"),
    ).select("eis_facility_id", "f.*", "n_generator_units", "n_units_total", "n_units_rated", "rated_kw_sum")


def to_records(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, generator inventory) of facilities with a readable position."""
    rows = by_facility(units).withColumns({"lat": F.col("site_latitude").try_cast("double"), "lon": F.col("site_longitude").try_cast("double")}).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    name = F.coalesce(_text("site_name"), _text("company_name"))
    detail = F.to_json(F.struct("eis_facility_id", F.col("n_units_total").alias("n_units"), F.col("primary_naics_code").alias("primary_naics")))
    records = rows.select(
        F.lit("epa_nei").alias("source"), F.col("eis_facility_id").alias("source_id"), F.concat(F.lit("https://enviro.epa.gov/enviro/efsystemquery.frs_program?fac_search=facility_id&fac_value="), "eis_facility_id").alias("source_url"),
        name.alias("name"), _text("company_name").alias("operator_raw"), "lat", "lon", _text("address").alias("address"), _text("city").alias("city"), F.upper("state").alias("state"), _text("zip_code").alias("postcode"), detail.alias("raw_json"),
    )
    inventory = rows.select(F.lit("epa_nei").alias("source"), F.col("eis_facility_id").alias("source_id"), name.alias("name"), "lat", "lon", "n_generator_units", "n_units_total", "n_units_rated", "rated_kw_sum")
    return conform(records), inventory
