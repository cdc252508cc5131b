"""Dimension tables from the fixed values; each has at most a few hundred rows, so plans may broadcast them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave import vocabulary as v
from siteweave.functions.similarity import operator_key


def jurisdictions(spark: SparkSession) -> DataFrame:
    rows = [(code, name, region, float(anchor), float(low), float(high)) for code, name, region, anchor, low, high, _ in v.JURISDICTIONS]
    return spark.createDataFrame(rows, "state string, state_name string, region int, anchor_twh double, anchor_low_twh double, anchor_high_twh double")


def boxes(spark: SparkSession) -> DataFrame:
    """(state, min_lon, min_lat, max_lon, max_lat), one row per box."""
    rows = [(r[0], *map(float, r[6])) for r in v.JURISDICTIONS] + [(code, *map(float, box)) for code, box in v.EXTRA_BOXES]
    return spark.createDataFrame(rows, "state string, min_lon double, min_lat double, max_lon double, max_lat double")


def zip3_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(v.ZIP3_RANGES), "low int, high int, state string")


def priors(spark: SparkSession) -> DataFrame:
    columns = "facility_class string, year_min int, year_max int, w_low double, w_mid double, w_high double, pue_low double, pue_mid double, pue_high double, ord int"
    rows = [(c, a, b, *map(float, rest), k) for k, (c, a, b, *rest) in enumerate(v.DENSITY_PRIORS)]
    return spark.createDataFrame(rows, columns)


def operator_aliases(spark: SparkSession, listed: DataFrame | None = None) -> DataFrame:
    """(alias_key, canonical, ord): keys with and without blanks, the first registered for each key; of ``listed`` (canonical, alias, line) or the fixed rows."""
    if listed is None:
        listed = spark.createDataFrame([(canonical, alias, k) for k, (canonical, alias) in enumerate(v.OPERATOR_ALIASES)], "canonical string, alias string, line bigint")
    raw = F.explode(F.array(F.struct(F.col("alias").alias("raw"), (F.col("line") * 2).alias("ord")), F.struct(F.col("canonical").alias("raw"), (F.col("line") * 2 + 1).alias("ord"))))
    keyed = listed.select("canonical", raw.alias("r")).select("canonical", "r.ord", operator_key(F.col("r.raw")).alias("key"))
    both = keyed.select(F.explode(F.array(F.struct("key", (F.col("ord") * 2).alias("o")), F.struct(F.replace("key", F.lit(" "), F.lit("")).alias("key"), (F.col("ord") * 2 + 1).alias("o")))).alias("k"), "canonical")
    return both.where(F.col("k.key") != "").groupBy(F.col("k.key").alias("alias_key")).agg(F.min_by("canonical", "k.o").alias("canonical"), F.min("k.o").alias("ord"))


def unattributed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in v.UNATTRIBUTED], "pattern string").select(operator_key(F.col("pattern")).alias("pattern"))


def overlays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in v.OVERLAY_TERRITORIES], "utility_name string")
