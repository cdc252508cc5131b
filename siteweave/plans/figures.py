"""The tables behind all figures and the map, with the rules for leaving one out. Small results; drawing is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.operators import analytics, power
from siteweave.sources.history import start_date_validation
from siteweave.vocabulary import TIERS

# Marker sizes in pixels, and what the tiers are called.
MARKER_MIN, MARKER_MAX = 6.0, 46.0
TIER_NAMES = {"A_attested": "cited figure", "B_generator": "generator permits", "C_area": "floor area"}


def shown(c: Column, unit: str = "", digits: int = 1) -> Column:
    """A number with thousands separated, or that there is none."""
    return F.coalesce(F.concat(F.format_number(c, digits), F.lit(unit)), F.lit("not estimated"))


def marker_size(mw: Column, most: Column) -> Column:
    """Area in proportion to load, so the diameter goes with its root; never below the least size."""
    return F.when(most > 0, F.greatest(F.lit(MARKER_MIN), F.sqrt(F.greatest(F.lit(0.0), F.coalesce(mw, F.lit(0.0))) / most) * MARKER_MAX)).otherwise(F.lit(MARKER_MIN))


def map_points(facilities: DataFrame) -> DataFrame:
    """(facility_id, lat, lon, layer, size, label) of every facility with a position."""
    most = F.broadcast(facilities.agg(F.max("best_power_mw").alias("_most")))  # one row
    names = F.create_map(*[F.lit(x) for pair in TIER_NAMES.items() for x in pair])
    line = lambda title, c: F.when(c.isNotNull(), F.concat(F.lit(f"{title}: "), c))
    load = F.concat(shown(F.col("best_power_mw"), " MW"), F.lit(" ("), shown(F.col("power_ci_low_mw")), F.lit(" to "), shown(F.col("power_ci_high_mw")), F.lit(")"))
    estimate = F.when(F.col("power_tier").isNull(), F.lit("Load: no estimate")).otherwise(F.concat_ws("\n", line("Load", load), line("Evidence", names[F.col("power_tier")]), line("A year", shown(F.col("est_annual_gwh"), " GWh", 0))))
    label = F.concat_ws(
        "\n", "name", "operator", "city", estimate, line("Utility", F.col("utility")), line("Class", F.col("facility_class")), F.when(F.col("footprint_sqft").isNotNull(), line("Footprint", shown(F.col("footprint_sqft"), " sq ft", 0))),
        F.when(F.col("pdb_net_count") > 0, line("Networks", F.col("pdb_net_count").cast("int").cast("string"))), line("Sources", F.col("source_list")), F.when(F.col("partial_occupancy"), F.lit("Part of a taller building; the share used is unknown")),
    )
    rows = facilities.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(most)
    return rows.select("facility_id", "lat", "lon", F.coalesce("power_tier", F.lit("none")).alias("layer"), marker_size(F.col("best_power_mw"), F.col("_most")).alias("size"), label.alias("label"))


def all_figures(facilities: DataFrame, estimates: DataFrame, history: DataFrame | None = None) -> dict[str, DataFrame]:
    """The figures that the data allow: none without facilities; load figures need an estimate, the utility figure a utility, the correlation five rows, the timeline a readable start year."""
    if facilities.isEmpty():
        return {}
    out = {"evidence_composition": analytics.evidence_composition(facilities), "completeness": analytics.completeness(facilities), "map_points": map_points(facilities)}
    if not facilities.where(F.col("best_power_mw").isNotNull()).isEmpty():
        out |= {"top_operators": analytics.top_operators(facilities), "rank_size": analytics.running_share(facilities.select("facility_id", "best_power_mw"), "best_power_mw", "facility_id")}
    if not facilities.where(F.col("utility").isNotNull()).isEmpty():
        out["load_by_utility"] = analytics.load_by(facilities, "utility")
    agreement = power.tier_agreement(estimates).where(F.col("pair") == f"{TIERS[1]} vs {TIERS[2]}")
    if not agreement.isEmpty():
        out["tier_agreement"] = agreement
    related = analytics.spearman(facilities, "best_power_mw", "pdb_net_count")
    if not related.where(F.col("rho").isNotNull()).isEmpty():
        out["interconnection_vs_load"] = related
    if history is not None:
        checked = start_date_validation(history)
        if not checked.isEmpty():
            out |= {"start_date_validation": checked, "timeline": analytics.cumulative_by_year(history, ("created_year", "datacenter_tagged_year")), "timeline_error": analytics.error_profile(checked, "error_years", "real_year", "osm_created_year", "source_id")}
    return out
