"""The common record shape, the published shapes, and contracts on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, NUM, FLAG = T.StringType(), T.DoubleType(), T.BooleanType()

RECORD = T.StructType(
    [T.StructField(n, TEXT) for n in ("source", "source_id", "source_url", "name", "operator_raw")]
    + [T.StructField(n, NUM) for n in ("lat", "lon")]
    + [T.StructField(n, TEXT) for n in ("address", "city", "state", "postcode", "status_raw")]
    + [T.StructField(n, NUM) for n in ("year_built", "building_levels", "footprint_sqm")]
    + [T.StructField("geometry_wkt", TEXT), T.StructField("is_building", FLAG)]
    + [T.StructField(n, TEXT) for n in ("clli", "website")]
    + [T.StructField(n, NUM) for n in ("pdb_net_count", "pdb_ix_count", "pdb_carrier_count")]
    + [T.StructField(n, TEXT) for n in ("campus_raw", "raw_json")]
)

# Column order of the published tables.
FACILITY_COLUMNS = (
    "facility_id name operator operator_confidence facility_class lat lon address city postcode utility utility_candidates year_built building_levels_reported "
    "building_levels_used partial_occupancy footprint_sqft est_gross_sqft est_white_space_sqft best_power_mw power_ci_low_mw power_ci_high_mw power_tier "
    "n_power_methods est_annual_gwh pdb_net_count pdb_ix_count pdb_carrier_count clli website source_list n_sources"
).split()
POWER_COLUMNS = (
    "facility_id method basis it_load_mw ci_low_mw ci_high_mw annual_gwh pue_used n_generator_units generator_nameplate_mw partial_occupancy stated_value_mw "
    "source_url retrieved_at quote assumptions_json"
).split()


def conform(df: DataFrame) -> DataFrame:
    """The 24 columns of a record: missing ones null, numbers parsed where they can be, ``is_building`` never null."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in RECORD.fields:
        c = F.col(f"`{have[field.name]}`") if field.name in have else F.lit(None)
        if field.name == "is_building":
            c = F.coalesce(c.cast("boolean"), F.lit(False))
        elif isinstance(field.dataType, T.DoubleType):
            c = c.cast("string").try_cast("double") if field.name in have and isinstance(df.schema[have[field.name]].dataType, T.StringType) else c.cast("double")
        else:
            c = c.cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            c = F.nanvl(c, F.lit(None).cast("double"))
        out.append(c.alias(field.name))
    return df.select(*out)


def empty_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RECORD)


def publish(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The given columns in order, null where the frame has none."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def facility_rules(in_some_box: Column) -> dict[str, Column]:
    """What must hold for every published facility."""
    size = lambda c: F.col(c).between(0, 2000)
    ordered = (F.col("power_ci_low_mw") <= F.col("best_power_mw") + 1e-9) & (F.col("best_power_mw") <= F.col("power_ci_high_mw") + 1e-9)
    return {
        "facility_id_present": F.col("facility_id").isNotNull(),
        "name_present": F.col("name").isNotNull(),
        "position_present": F.col("lat").isNotNull() & F.col("lon").isNotNull(),
        "lat_range": F.col("lat").between(-90, 90),
        "lon_range": F.col("lon").between(-180, 180),
        "inside_a_jurisdiction": in_some_box,
        "power_range": F.col("best_power_mw").isNull() | size("best_power_mw"),
        "tier_known": F.col("power_tier").isNull() | F.col("power_tier").isin("A_attested", "B_generator", "C_area"),
        "sources_counted": F.col("n_sources") >= 1,
        "interval_ordered": F.coalesce(ordered, F.lit(True)),
    }


def power_rules() -> dict[str, Column]:
    size = lambda c: F.col(c).between(0, 2000)
    return {
        "method_known": F.col("method").isin("A_attested", "B_generator", "C_area"),
        "basis_present": F.col("basis").isNotNull(),
        "assumptions_present": F.col("assumptions_json").isNotNull(),
        "load_range": size("it_load_mw"),
        "interval_ordered": F.col("ci_low_mw") <= F.col("ci_high_mw") + 1e-9,
        "attested_has_url": (F.col("method") != "A_attested") | (F.length(F.coalesce("source_url", F.lit(""))) > 0),
    }


def violations(df: DataFrame, rules: dict[str, Column], unique: str | None = None) -> DataFrame:
    """(rule, violations) of every rule in one pass; a null outcome violates."""
    sums = [F.sum(F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(1)).alias(name) for name, ok in rules.items()]
    row = df.agg(*sums)
    listed = row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("violations")) for n in rules])).alias("r")).select("r.*")
    if unique:
        extra = df.groupBy(unique).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("violations"))
        listed = listed.unionByName(extra.select(F.lit(f"{unique}_unique").alias("rule"), "violations"))
    return listed
