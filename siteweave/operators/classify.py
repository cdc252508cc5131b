"""Ordered text rules that tag records, and classes from operators and names.

The patterns are parameters; the defaults are the fixed values below. The first
rule that matches is kept with the row, so that what was left out can be audited.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.vocabulary import COLOCATION, HYPERSCALE, TELECOM, WHOLESALE

# Rule names and their patterns, in order.
RULES = (
    ("education_facility", r"(?i)\b(universit|college|campus\s+comput|school\s+district|community\s+college|student|academic|sdsu|ucla|ucsd|cal\s?poly|csu\b|uc\s+(berkeley|davis|irvine|merced|riverside))\b"),
    ("server_room_not_facility", r"(?i)\b(computer\s+room|server\s+room|comput(er|ing)\s+lab|machine\s+room|it\s+closet|network\s+closet|open\s+computing\s+facility)\b"),
    ("government_non_commercial", r"(?i)\b(post\s+office|postal\s+service|usp[os]\b|terminal\s+annex|city\s+hall|county\s+of\b|police|fire\s+station|public\s+library|water\s+district)\b"),
    ("healthcare_facility", r"(?i)\b(hospital|medical\s+cent(er|re)|clinic|health\s+system|kaiser|sutter)\b"),
    ("enterprise_self_operated", r"(?i)\b(cisco|fujitsu|avnet|mechanics\s+bank|tri\s+counties\s+bank|cbs\s+inc|regulus|alexandria\s+real\s+estate|wave\s+broadband|digital\s?path|iscs|charter\s+communications|econtactlive|deliverex|jamestown|somo\s+village)\b"),
)
TELECOM_NAME = r"(?i)\b(switching\s+cent(er|re)|central\s+office|telephone\s+exchange|toll\s+cent(er|re)|wire\s+cent(er|re))\b"


def first_rule(text: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, pattern in rules:
        out = out.when(text.rlike(pattern), F.lit(name))
    return out


def site_class(operator: Column, name: Column) -> Column:
    is_in = lambda names: F.coalesce(operator.isin(*names), F.lit(False))
    telecom = is_in(TELECOM) | F.coalesce(name.rlike(TELECOM_NAME), F.lit(False))
    return F.when(is_in(HYPERSCALE), "hyperscale").when(is_in(WHOLESALE), "wholesale").when(is_in(COLOCATION), "colocation").when(telecom, "telecom").otherwise("unknown")


def classify(records: DataFrame, inside: Column, trusted_source: str = "peeringdb", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Adds facility_class and exclusion_rule; a null rule means in scope. ``records`` has operator resolved."""
    text = F.concat_ws(" ", "name", "operator_raw")
    trusted = F.col("source") == trusted_source
    kind = site_class(F.col("operator"), F.col("name"))
    by_text = F.when(~trusted, first_rule(text, rules))
    rule = F.coalesce(by_text, F.when((kind == "telecom") & ~trusted, "telecom_central_office"), F.when(~inside, "outside_state"))
    return records.withColumn("facility_class", kind).withColumn("exclusion_rule", rule)


def fleet_gate(facilities: DataFrame, links: DataFrame, inventory: DataFrame, minimum: int = 4) -> DataFrame:
    """Adds fleet_units and exclusion_rule for facilities that only the inventory knows and whose fleet is too small."""
    fleet = links.where(F.col("source") == "epa_nei").join(inventory.select("source_id", "n_generator_units"), "source_id", "left").groupBy("facility_id").agg(F.coalesce(F.sum("n_generator_units"), F.lit(0)).alias("fleet_units"))
    out = facilities.join(fleet, "facility_id", "left").withColumn("fleet_units", F.coalesce("fleet_units", F.lit(0)))
    small = (F.col("source_list") == "epa_nei") & (F.col("fleet_units") < minimum)
    return out.withColumn("exclusion_rule", F.when(small, "nei_only_insufficient_generator_fleet"))
