"""Aggregates behind the figures and reports; drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.storage import Scratch
from siteweave.vocabulary import TIERS

NO_OPERATOR = "Operator not established"


def filled(c: Column, instead: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(instead))


def top_operators(fac: DataFrame, n: int = 16) -> DataFrame:
    """Load by operator and tier with whiskers, the ``n`` largest; rows with an estimate only."""
    rows = fac.where(F.col("best_power_mw").isNotNull()).withColumn("op", filled(F.col("operator"), NO_OPERATOR))
    tiers = [F.coalesce(F.sum(F.when(F.col("power_tier") == t, F.col("best_power_mw"))), F.lit(0.0)).alias(t) for t in TIERS]
    by = rows.groupBy("op").agg(*tiers, F.sum("best_power_mw").alias("total_mw"), F.sum("power_ci_low_mw").alias("low"), F.sum("power_ci_high_mw").alias("high"), F.count("*").alias("estimated_sites"))
    sites = fac.withColumn("op", filled(F.col("operator"), NO_OPERATOR)).groupBy("op").agg(F.count("*").alias("total_sites"))
    out = by.join(sites, "op").select(F.col("op").alias("operator"), *TIERS, "total_mw", F.greatest(F.lit(0.0), F.col("total_mw") - F.col("low")).alias("whisker_low"), F.greatest(F.lit(0.0), F.col("high") - F.col("total_mw")).alias("whisker_high"), "estimated_sites", "total_sites")
    return out.orderBy(F.desc("total_mw"), "operator").limit(n)


def load_by(fac: DataFrame, column: str, n: int = 12) -> DataFrame:
    """Load and sites by a column without its nulls, the ``n`` with most load."""
    by = fac.where(F.col(column).isNotNull()).groupBy(column).agg(F.coalesce(F.sum("best_power_mw"), F.lit(0.0)).alias("total_mw"), F.count("*").alias("sites"), F.count("best_power_mw").alias("sites_with_power"))
    return by.orderBy(F.desc("total_mw"), column).limit(n)


def running_share(df: DataFrame, value: str, key: str) -> DataFrame:
    """Rank by value descending and the cumulative share of the total, without one task holding all rows.

    Rows are range-partitioned by value, ranked inside their partition, and shifted by
    the counts and sums of the partitions before, a table with one row per partition.
    """
    rows = df.where(F.col(value).isNotNull()).repartitionByRange(F.desc(value), F.col(key)).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part").orderBy(F.desc(value), key)
    rows = rows.withColumn("_r", F.row_number().over(inside)).withColumn("_s", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_t"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_t").over(before), F.lit(0.0)).alias("_t0"), F.sum("_t").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    joined = rows.join(F.broadcast(offsets), "_part")  # one row per partition
    return joined.withColumn("rank", (F.col("_r") + F.col("_n0")).cast("bigint")).withColumn("cumulative_share", (F.col("_s") + F.col("_t0")) / F.col("_all")).drop("_part", "_r", "_s", "_n0", "_t0", "_all")


def evidence_composition(fac: DataFrame) -> DataFrame:
    """Sites and load by tier; the row without a tier last."""
    known = F.array(*[F.lit(t) for t in TIERS])
    by = fac.groupBy("power_tier").agg(F.count("*").alias("sites"), F.coalesce(F.sum("best_power_mw"), F.lit(0.0)).alias("total_mw"))
    return by.withColumn("place", F.when(F.col("power_tier").isNull(), F.lit(99)).otherwise(F.array_position(known, F.col("power_tier"))).cast("int")).orderBy("place")


def completeness(fac: DataFrame) -> DataFrame:
    """(item, known, share) of ten facts about facilities in one pass."""
    checks = {
        "located": F.col("lat").isNotNull() & F.col("lon").isNotNull(),
        "operator_resolved": F.col("operator_confidence").isin("alias", "alias_token"),
        "utility_assigned": F.col("utility").isNotNull(),
        "footprint_measured": F.col("footprint_sqft").isNotNull(),
        "any_estimate": F.col("best_power_mw").isNotNull(),
        "generator_evidence": F.col("power_tier") == TIERS[1],
        "cited_figure": F.col("power_tier") == TIERS[0],
        "several_sources": F.col("n_sources") > 1,
        "several_methods": F.col("n_power_methods") > 1,
        "year_known": F.col("year_built").isNotNull(),
    }
    row = fac.agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    return row.select("n", F.explode(F.array(*[F.struct(F.lit(k).alias("item"), F.col(k).alias("known")) for k in checks])).alias("x")).select("x.item", "x.known", F.when(F.col("n") > 0, F.col("x.known") / F.col("n")).alias("share"))


def average_rank(df: DataFrame, value: str, into: str) -> DataFrame:
    """Ranks with ties averaged, from counts per distinct value, which are range-partitioned and shifted by the counts of the partitions before."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_c")).repartitionByRange(value).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    counts = Scratch(df.sparkSession, "ranks").cut(counts.withColumn("_below", F.coalesce(F.sum("_c").over(inside), F.lit(0))))
    sizes = counts.groupBy("_part").agg(F.sum("_c").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    # One row per partition.
    ranks = counts.join(F.broadcast(offsets), "_part").select(F.col(value), (F.col("_below") + F.col("_n0") + (F.col("_c") + 1) / 2).alias(into))
    return df.join(ranks, value, "left")


def spearman(df: DataFrame, x: str, y: str, least: int = 5) -> DataFrame:
    """(n, rho): correlation of average ranks over rows with both values; null below ``least`` rows."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    ranked = average_rank(average_rank(rows, x, "_rx"), y, "_ry")
    return ranked.agg(F.count("*").alias("n"), F.corr("_rx", "_ry").alias("rho")).select("n", F.when(F.col("n") >= least, F.col("rho")).alias("rho"))


def cumulative_by_year(events: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(year, column counts so far) for every year between the first and the last."""
    years = events.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).alias("year")) for c in columns])).alias("e")).select("e.*").where(F.col("year").isNotNull())
    counts = years.groupBy("year").agg(*[F.count_if(F.col("what") == c).alias(c) for c in columns])
    span = counts.agg(F.min("year").alias("a"), F.max("year").alias("b")).where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("year"))
    so_far = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    return span.join(counts, "year", "left").select("year", *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in columns])


def error_profile(df: DataFrame, error: str, x: str, y: str, label: str) -> DataFrame:
    """Median error, most frequent error, the label of the worst one, and the correlation of x and y without it."""
    worst = df.agg(F.max_by(label, F.struct(F.abs(error).alias("e"), F.col(label))).alias("worst"))
    rest = df.join(F.broadcast(worst), F.col(label) == F.col("worst"), "left_anti").agg(F.corr(x, y).alias("corr_without_worst"))
    whole = df.agg(F.count("*").alias("n"), F.percentile(error, F.lit(0.5)).alias("median_error"), F.mode(error, True).alias("modal_error"))
    return whole.join(worst).join(rest)  # one row each


def summary_by_state(fac: DataFrame, states: DataFrame) -> DataFrame:
    """Counts, totals and the anchor comparison of every jurisdiction with facilities."""
    by = fac.groupBy("state").agg(
        F.count("*").alias("facilities"), F.count("footprint_sqft").alias("with_footprint"), F.count("best_power_mw").alias("with_power_estimate"), F.count_if(F.col("n_sources") > 1).alias("multi_source"),
        F.bround(F.coalesce(F.sum("best_power_mw"), F.lit(0.0)), 1).alias("sum_it_load_mw"), (F.coalesce(F.sum("est_annual_gwh"), F.lit(0.0)) / 1000).alias("twh"),
        *[F.count_if(F.col("power_tier") == t).alias(f"tier_{t[0].lower()}_facilities") for t in TIERS],
    )
    out = by.join(F.broadcast(states), "state")  # 51 rows
    return out.select("state", "state_name", "facilities", "with_footprint", "with_power_estimate", "multi_source", "sum_it_load_mw", F.bround("twh", 2).alias("sum_annual_twh"), "tier_a_facilities", "tier_b_facilities", "tier_c_facilities", "anchor_twh", "anchor_low_twh", "anchor_high_twh", F.col("twh").between(F.col("anchor_low_twh"), F.col("anchor_high_twh")).alias("within_anchor_range"))


def numbered_ids(df: DataFrame, key: str, order: list) -> DataFrame:
    """Adds ``<key>-<n>`` with n from 0 in order where a key occurs several times."""
    same = Window.partitionBy(key)
    return df.withColumn("unique_id", F.when(F.count("*").over(same) > 1, F.concat_ws("-", F.col(key).cast("string"), (F.row_number().over(same.orderBy(*order)) - 1).cast("string"))).otherwise(F.col(key).cast("string")))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of every key in the given order; null keys are a key of their own."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")
