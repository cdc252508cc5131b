"""Load estimates with intervals from cited figures, generator fleets and floor area; the best of them per site; totals against anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.operators.lookups import prior_of
from siteweave.vocabulary import ATTESTED_BAND, CRITICAL_TO_IT, GENERATOR_KW, HOURS, REDUNDANCY, SQM_PER_SQFT, STOREY_CAP, TIERS, UTILISATION, UTILISATION_BAND, WHITE_SPACE


def gwh(mw: Column, pue: Column, utilisation: float = UTILISATION) -> Column:
    return mw * pue * utilisation * HOURS / 1000


def gross_area(df: DataFrame, footprint: str = "footprint_sqft", levels: str = "building_levels") -> DataFrame:
    """Adds building_levels_used, partial_occupancy, est_gross_sqft and its lower bound; storeys above the cap count as partly occupied."""
    storeys = F.when(F.col(levels).between(1, 200), F.col(levels)).otherwise(F.lit(1.0))
    used = F.least(storeys, F.lit(float(STOREY_CAP)))
    return df.withColumn("building_levels_used", used).withColumn("partial_occupancy", storeys > STOREY_CAP).withColumn("est_gross_sqft", F.col(footprint) * used).withColumn("est_gross_sqft_min", F.when(storeys > STOREY_CAP, F.col(footprint)).otherwise(F.col(footprint) * used))


def sqft(square_metres: Column) -> Column:
    return square_metres / SQM_PER_SQFT


def area_estimates(facilities: DataFrame) -> DataFrame:
    """From floor area; a facility without one gives no row."""
    rows = facilities.where(F.col("est_gross_sqft") > 0).withColumn("p", prior_of(F.col("facility_class"), F.col("year_built")))
    low_area = F.when(F.col("partial_occupancy"), F.col("est_gross_sqft_min")).otherwise(F.col("est_gross_sqft"))
    mw = lambda area, share, density: area * share * density / 1e6
    low, mid, high = mw(low_area, WHITE_SPACE[0], F.col("p.w_low")), mw(F.col("est_gross_sqft"), WHITE_SPACE[1], F.col("p.w_mid")), mw(F.col("est_gross_sqft"), WHITE_SPACE[2], F.col("p.w_high"))
    return rows.select(
        "facility_id", F.lit(TIERS[2]).alias("method"), F.lit("floor_area_density").alias("basis"), mid.alias("it_load_mw"), low.alias("ci_low_mw"), high.alias("ci_high_mw"),
        gwh(mid, F.col("p.pue_mid")).alias("annual_gwh"), gwh(low, F.col("p.pue_low"), UTILISATION_BAND[0]).alias("annual_gwh_low"), gwh(high, F.col("p.pue_high"), UTILISATION_BAND[1]).alias("annual_gwh_high"), F.col("p.pue_mid").alias("pue_used"),
        (F.col("est_gross_sqft") * WHITE_SPACE[1]).alias("est_white_space_sqft"), "partial_occupancy",
    )


def fleet_estimates(facilities: DataFrame, links: DataFrame, inventory: DataFrame) -> DataFrame:
    """From generator fleets: rated units as rated, the others by the prior rating; redundancy and the critical share taken off."""
    fleets = links.where(F.col("source") == "epa_nei").join(inventory, "source_id").groupBy("facility_id").agg(*[F.sum(c).alias(c) for c in ("n_generator_units", "n_units_rated", "rated_kw_sum")])
    rows = facilities.select("facility_id", "facility_class", "year_built").join(fleets.where(F.col("n_generator_units") > 0), "facility_id").withColumn("p", prior_of(F.col("facility_class"), F.col("year_built")))
    nameplate = lambda kw: (F.col("rated_kw_sum") + (F.col("n_generator_units") - F.col("n_units_rated")) * kw) / 1000
    load = lambda kw, redundancy: nameplate(kw) / redundancy * CRITICAL_TO_IT
    mid = load(GENERATOR_KW[1], REDUNDANCY[1])
    return rows.select(
        "facility_id", F.lit(TIERS[1]).alias("method"), F.lit("backup_generator_fleet").alias("basis"), mid.alias("it_load_mw"), F.least(load(GENERATOR_KW[0], REDUNDANCY[2]), mid).alias("ci_low_mw"),
        F.greatest(load(GENERATOR_KW[2], REDUNDANCY[0]), mid).alias("ci_high_mw"), gwh(mid, F.col("p.pue_mid")).alias("annual_gwh"), F.col("p.pue_mid").alias("pue_used"),
        F.col("n_generator_units").cast("bigint").alias("n_generator_units"), nameplate(GENERATOR_KW[1]).alias("generator_nameplate_mw"),
    )


def attested_estimates(cited: DataFrame) -> DataFrame:
    """From cited figures (facility_id, stated_value_mw, basis, source_url, facility_class, year_built)."""
    rows = cited.where(F.col("stated_value_mw") > 0).withColumn("p", prior_of(F.col("facility_class"), F.col("year_built")))
    load = F.when(F.col("basis") == "it_load", F.col("stated_value_mw")).when(F.col("basis") == "critical_load", F.col("stated_value_mw") * CRITICAL_TO_IT).otherwise(F.col("stated_value_mw") / F.col("p.pue_mid"))
    return rows.select("facility_id", F.lit(TIERS[0]).alias("method"), "basis", load.alias("it_load_mw"), (load * (1 - ATTESTED_BAND)).alias("ci_low_mw"), (load * (1 + ATTESTED_BAND)).alias("ci_high_mw"), gwh(load, F.col("p.pue_mid")).alias("annual_gwh"), F.col("p.pue_mid").alias("pue_used"), "stated_value_mw", "source_url", *[c for c in ("retrieved_at", "quote", "cited_order") if c in cited.columns])


def tier_rank(method: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in TIERS]), method)


def best_estimates(estimates: DataFrame) -> DataFrame:
    """One row per facility: for each column the first non-null value in order of precedence, and the number of methods. Cited figures of one facility go by cited_order, if there is one."""
    order = F.struct(tier_rank(F.col("method")), F.col("cited_order")) if "cited_order" in estimates.columns else tier_rank(F.col("method"))
    first = lambda c, n: F.expr(f"min_by({c}, rank) FILTER (WHERE {c} IS NOT NULL)").alias(n)
    named = (("it_load_mw", "best_power_mw"), ("ci_low_mw", "power_ci_low_mw"), ("ci_high_mw", "power_ci_high_mw"), ("method", "power_tier"), ("annual_gwh", "est_annual_gwh"))
    return estimates.withColumn("rank", order).groupBy("facility_id").agg(*[first(c, n) for c, n in named], F.count_distinct("method").cast("bigint").alias("n_power_methods"))


def tier_agreement(estimates: DataFrame) -> DataFrame:
    """Quartiles of the ratio right/left for each pair of tiers over facilities that have both."""
    wide = estimates.groupBy("facility_id").pivot("method", list(TIERS)).agg(F.min_by("it_load_mw", "cited_order") if "cited_order" in estimates.columns else F.first("it_load_mw", ignorenulls=True))
    pairs = [(a, b) for i, a in enumerate(TIERS) for b in TIERS[i + 1 :]]
    rows = F.explode(F.array(*[F.struct(F.lit(f"{a} vs {b}").alias("pair"), F.when(F.col(a) > 0, F.col(b) / F.col(a)).alias("ratio")) for a, b in pairs]))
    quarters = F.percentile("ratio", F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]))
    return wide.select(rows.alias("r")).select("r.*").where(F.col("ratio").isNotNull()).groupBy("pair").agg(F.count("*").alias("n_facilities"), quarters.alias("q")).select("pair", "n_facilities", F.col("q")[1].alias("median_ratio"), F.col("q")[0].alias("p25_ratio"), F.col("q")[2].alias("p75_ratio"))


def reconcile(facilities: DataFrame, anchor: float, low: float, high: float) -> DataFrame:
    """Bottom-up totals against the anchor, in one row."""
    totals = facilities.agg(F.coalesce(F.sum("best_power_mw"), F.lit(0.0)).alias("mw"), F.coalesce(F.sum("est_annual_gwh"), F.lit(0.0)).alias("gwh"), F.count("best_power_mw").alias("n"))
    twh = F.col("gwh") / 1000
    return totals.select(
        F.bround("mw", 1).alias("bottom_up_it_load_mw"), F.bround(twh, 2).alias("bottom_up_annual_twh"), F.lit(anchor).alias("top_down_anchor_twh"),
        F.array(F.lit(low), F.lit(high)).alias("top_down_range_twh"), twh.between(low, high).alias("within_anchor_range"),
        F.when(twh > 0, F.bround(F.lit(anchor) / twh, 3)).alias("implied_calibration_factor"), F.col("n").alias("n_facilities_with_power"),
    )


def calibrate(facilities: DataFrame, report: DataFrame, enabled: bool) -> DataFrame:
    """Scales modelled loads by the implied factor if asked and the total is outside the band; cited figures stay."""
    if not enabled:
        return facilities.withColumn("calibration_applied", F.lit(False))
    one = F.broadcast(report.select(F.when(~F.col("within_anchor_range"), F.col("implied_calibration_factor")).alias("_factor")))  # one row
    moves = F.col("_factor").isNotNull() & ~F.col("power_tier").eqNullSafe(F.lit(TIERS[0]))
    scaled = {c: F.when(moves, F.col(c) * F.col("_factor")).otherwise(F.col(c)) for c in ("best_power_mw", "power_ci_low_mw", "power_ci_high_mw", "est_annual_gwh")}
    return facilities.join(one).withColumns(scaled).withColumn("calibration_applied", F.col("_factor").isNotNull()).drop("_factor")
