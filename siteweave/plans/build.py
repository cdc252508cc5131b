"""The whole build for all jurisdictions in one plan: records, classes, facilities, estimates, totals, published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave import dims, vocabulary
from siteweave.functions.projection import area_m2
from siteweave.operators import analytics, classify, evidence, lookups, power
from siteweave.operators.resolve import resolve
from siteweave.schemas import FACILITY_COLUMNS, POWER_COLUMNS, facility_rules, power_rules, violations
from siteweave.sinks import writers
from siteweave.storage import Scratch, ship

BOXES = [(r[0], r[6]) for r in vocabulary.JURISDICTIONS] + list(vocabulary.EXTRA_BOXES)
ALL_BOXES = [b for _, b in BOXES]


@dataclass
class Built:
    facilities: DataFrame
    links: DataFrame
    review: DataFrame
    excluded: DataFrame
    estimates: DataFrame
    agreement: DataFrame
    summary: DataFrame


def placed(records: DataFrame) -> DataFrame:
    """Records with the jurisdiction they belong to: the one their source names, else that of the postcode, else the one box or the smallest that holds them."""
    zips = dims.zip3_ranges(records.sparkSession)
    out = lookups.assign_state(records, zips, BOXES, "state", "postcode", "lat", "lon", "_state")
    return out.withColumn("state", F.coalesce("_state", lookups.smallest_box(F.col("lat"), F.col("lon"), BOXES))).drop("_state")


def measured(records: DataFrame) -> DataFrame:
    """Footprints from outlines of buildings; a site outline or a point has none."""
    ship(records.sparkSession)
    area = F.when(F.col("is_building") & F.col("geometry_wkt").isNotNull(), area_m2("geometry_wkt", F.coalesce("state", F.lit(""))))
    return records.withColumn("footprint_sqm", F.coalesce("footprint_sqm", area))


def tagged(records: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Records with operator, class and the rule that leaves them out, if any; ``aliases`` (canonical, alias, line) in place of the fixed ones."""
    spark = records.sparkSession
    aliases, vehicles = dims.operator_aliases(spark, aliases), dims.unattributed(spark)
    named = lookups.resolve_operators(records, "operator_raw", aliases, vehicles)
    by_name = lookups.resolve_operators(named.where(F.col("operator").isNull()).drop("operator", "operator_confidence"), "name", aliases, vehicles)
    both = named.where(F.col("operator").isNotNull()).unionByName(by_name)
    return classify.classify(both, lookups.in_own_boxes(F.col("state"), F.col("lat"), F.col("lon"), BOXES))


def explained(estimates: DataFrame) -> DataFrame:
    """Estimates with the basis and the assumptions that are published with them."""
    assumptions = F.to_json(F.struct("method", "pue_used", "partial_occupancy"), {"ignoreNullFields": "false"})
    return estimates.withColumn("assumptions_json", assumptions).withColumn("basis", F.coalesce(F.col("basis"), F.lit("modelled")) if "basis" in estimates.columns else F.lit("modelled"))


def build(records: DataFrame, inventory: DataFrame, territories: DataFrame | None = None, overrides: DataFrame | None = None, filings: DataFrame | None = None, aliases: DataFrame | None = None) -> Built:
    """All tables from records in the common shape, the generator inventory, territories, hand-entered figures, figures of filings and operator aliases.

    Territories with a state serve facilities of that state only.
    """
    spark = records.sparkSession
    scratch = Scratch(spark, "build")
    # Read several times below, so places and areas are worked out once.
    rows = scratch.cut(tagged(scratch.cut(measured(placed(records))), aliases))
    facilities, links, review = resolve(rows.where(F.col("exclusion_rule").isNull()))
    gated = scratch.cut(classify.fleet_gate(facilities, links, inventory))
    kept = gated.where(F.col("exclusion_rule").isNull()).drop("exclusion_rule", "fleet_units")
    links = scratch.cut(links.join(kept.select("facility_id"), "facility_id", "left_semi"))
    excluded = rows.where(F.col("exclusion_rule").isNotNull()).unionByName(gated.where(F.col("exclusion_rule").isNotNull()), allowMissingColumns=True)
    kept = power.gross_area(kept.withColumnRenamed("building_levels", "building_levels_reported"), levels="building_levels_reported")
    if territories is not None:
        kept = kept.join(evidence.serving_territories(evidence.in_states_of(kept, territories), territories, dims.overlays(spark)), "facility_id", "left")
    else:
        kept = kept.withColumns({"utility": F.lit(None).cast("string"), "utility_candidates": F.lit(None).cast("string")})
    kept = scratch.cut(kept)
    parts = [power.area_estimates(kept), power.fleet_estimates(kept, links, inventory)]
    cited = evidence.cited_figures(kept, overrides, filings)
    if cited is not None:
        parts.append(power.attested_estimates(cited.join(kept.select("facility_id", "facility_class", "year_built"), "facility_id")))
    estimates = parts[0]
    for part in parts[1:]:
        estimates = estimates.unionByName(part, allowMissingColumns=True)
    estimates = scratch.cut(explained(estimates))
    white = estimates.groupBy("facility_id").agg(F.max("est_white_space_sqft").alias("est_white_space_sqft"))
    out = scratch.cut(kept.join(power.best_estimates(estimates), "facility_id", "left").join(white, "facility_id", "left"))
    summary = analytics.summary_by_state(out, dims.jurisdictions(spark))
    return Built(out, links, review, excluded, estimates.drop("cited_order"), power.tier_agreement(estimates), summary)


def reconciliation(facilities: DataFrame, states: DataFrame) -> DataFrame:
    """Bottom-up totals against the anchors of the jurisdictions that have facilities, in one row."""
    anchors = states.join(facilities.select("state").distinct(), "state", "left_semi").agg(F.sum("anchor_twh"), F.sum("anchor_low_twh"), F.sum("anchor_high_twh")).first()
    return power.reconcile(facilities, *(x or 0.0 for x in anchors))


def write_national(facilities: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Summary by jurisdiction, reconciliation and description of all jurisdictions below ``folder/national``; returns the first two."""
    spark, out = facilities.sparkSession, f"{folder}/national"
    states = dims.jurisdictions(spark)
    summary = analytics.summary_by_state(facilities, states).orderBy(F.desc("sum_it_load_mw"), "state")
    totals = reconciliation(facilities, states)
    writers.write_table(summary, out, "summary")
    writers.write_json(totals, out, "reconciliation")
    tables = {"summary": summary, "facilities": facilities}
    writers.write_description(spark, writers.package_description("national-registry", "Facilities and load by jurisdiction", tables, sources_of(facilities), writers.FIELD_TEXTS), out)
    return summary, totals


def sources_of(facilities: DataFrame) -> list[dict]:
    """The sources that records of the published facilities come from."""
    used = {r[0] for r in facilities.select(F.explode(F.split("source_list", ","))).distinct().collect()}  # a handful
    return [{"title": s} for s in vocabulary.SOURCE_PRIORITY if s in used]


def write_all(built: Built, folder: str) -> None:
    """Six tables, points, footprints, the reconciliation and the package description."""
    spark = built.facilities.sparkSession
    states = ["state", *FACILITY_COLUMNS]
    writers.write_table(built.facilities, folder, "facilities", states)
    writers.write_table(built.estimates, folder, "power_estimates", POWER_COLUMNS)
    writers.write_table(built.links, folder, "facility_sources")
    writers.write_table(built.review.orderBy(F.desc("score"), "left_source", "left_source_id", "right_source", "right_source_id"), folder, "dedupe_review")
    writers.write_table(built.excluded, folder, "exclusions")
    writers.write_table(built.summary.orderBy(F.desc("sum_it_load_mw"), "state"), folder, "summary")
    if not built.agreement.isEmpty():
        writers.write_table(built.agreement, folder, "tier_agreement")
    shown = ["facility_id", "name", "operator", "facility_class", "footprint_sqft", "best_power_mw", "power_tier"]
    writers.write_features(writers.point_features(built.facilities, shown), folder, "facilities_points")
    writers.write_features(writers.footprint_features(built.facilities, shown), folder, "facility_footprints")
    tables = {"facilities": built.facilities.select(*[c for c in states if c in built.facilities.columns]), "power_estimates": built.estimates, "facility_sources": built.links}
    writers.write_description(spark, writers.package_description("facility-registry", "Facilities and load estimates", tables, sources_of(built.facilities), writers.FIELD_TEXTS), folder)
    writers.write_json(reconciliation(built.facilities, dims.jurisdictions(spark)), folder, "reconciliation")


def check(facilities: DataFrame, estimates: DataFrame) -> DataFrame:
    """(rule, violations, table): violations of the contracts on both published tables."""
    inside = lookups.in_any_box(F.col("lat"), F.col("lon"), ALL_BOXES)
    a = violations(facilities, facility_rules(inside), unique="facility_id").withColumn("table", F.lit("facilities"))
    url = F.col("source_url") if "source_url" in estimates.columns else F.lit(None).cast("string")
    return a.unionByName(violations(estimates.withColumn("source_url", url), power_rules()).withColumn("table", F.lit("power_estimates")))


def read_raw(spark: SparkSession, raw: str) -> tuple[DataFrame, DataFrame]:
    """(records, inventory) from the snapshot folders below ``raw``, each source at its latest snapshot, by jurisdiction where it is taken so."""
    from siteweave.sources import nei, osm, peeringdb

    elements = osm.latest_snapshot(osm.read_snapshots(spark, f"{raw}/osm"), within="file_state")
    registry = peeringdb.newest(osm.latest_snapshot(peeringdb.read_snapshots(spark, f"{raw}/peeringdb")), F.lit(0))
    units = osm.latest_snapshot(nei.read_extracts(spark, f"{raw}/epa_nei"), within="state")
    from_units, inventory = nei.to_records(units)
    return osm.to_records(elements).unionByName(peeringdb.to_records(registry)).unionByName(from_units), inventory


def _latest(spark: SparkSession, pattern: str) -> str | None:
    """The path with the latest date among those that fit the pattern, if any does."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return max((f.getPath().toString() for f in found or []), default=None)


# The layer of territories and the filings are California's.
EVIDENCE_STATE = "CA"
OVERRIDES = "match_name STRING, match_operator STRING, basis STRING, value_mw DOUBLE, source_url STRING, retrieved_at STRING, quote STRING"


def read_evidence(spark: SparkSession, raw: str) -> dict[str, DataFrame | None]:
    """Territories, overrides, filings and operator aliases below ``raw``, each None where there is none.

    ``cec_gis/<date>/*.geojson[.gz]``; ``reference/manual_overrides.csv`` and ``reference/operator_aliases.csv``; ``ceqanet/<date>/search`` and ``detail``, JSON lines of
    (development_type, window_start, html) and (sch_number, source_url, html).
    """
    from siteweave.sources import filings, tables, territories

    layer, listed, search = _latest(spark, f"{raw}/cec_gis/*/*.geojson*"), _latest(spark, f"{raw}/reference/manual_overrides.csv"), _latest(spark, f"{raw}/ceqanet/*/search")
    found: dict[str, DataFrame | None] = {"territories": None, "overrides": None, "filings": None, "aliases": None}
    if names := _latest(spark, f"{raw}/reference/operator_aliases.csv"):
        found["aliases"] = tables.read_reference(spark, names, "canonical STRING, alias STRING").withColumn("line", F.monotonically_increasing_id())
    if layer:
        found["territories"] = territories.read_territories(spark, layer).withColumn("state", F.lit(EVIDENCE_STATE))
    if listed:
        found["overrides"] = tables.read_reference(spark, listed, OVERRIDES).withColumn("line", F.monotonically_increasing_id())
    if search:
        titles = filings.discover(spark.read.schema("development_type STRING, window_start STRING, html STRING").json(search)).select("sch_number", "title")
        day = search.rstrip("/").split("/")[-2]
        pages = spark.read.schema("sch_number STRING, source_url STRING, html STRING").json(search[: -len("search")] + "detail").distinct()
        found["filings"] = filings.harvest(pages.join(titles, "sch_number").withColumn("retrieved_at", F.lit(day))).withColumn("state", F.lit(EVIDENCE_STATE))
    return found
