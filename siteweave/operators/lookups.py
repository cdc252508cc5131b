"""Joins with small ordered tables: ranges, boxes, aliases and ordered fallbacks.

The table on the right is a dimension; it is broadcast only up to a counted size,
and then the probed side is never shuffled for the join itself. Where several rows of it can
apply, the choice is made inside the row by an ordered aggregate over the few hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.ratings import postcode_prefix
from siteweave.functions.similarity import operator_key
from siteweave.vocabulary import DEFAULT_YEAR, DENSITY_PRIORS, JURISDICTIONS, UNATTRIBUTED_LABEL

#: Rows of a table that a plan here may send to every task; its size is counted first.
BROADCAST_ROWS = 10_000
STATE_CODES = tuple(row[0] for row in JURISDICTIONS)


def prior_of(facility_class: Column, year: Column) -> Column:
    """The density and PUE row of a class and year as a struct: the class's row for the year, else its first row.

    The table is short, so it becomes one expression and the join disappears.
    """
    classes = {row[0] for row in DENSITY_PRIORS}
    known = F.when(facility_class.isin(*classes), facility_class).otherwise(F.lit("unknown"))
    when = F.coalesce(year.cast("int"), F.lit(DEFAULT_YEAR))
    row = lambda r: F.struct(*[F.lit(float(x)).alias(n) for n, x in zip(("w_low", "w_mid", "w_high", "pue_low", "pue_mid", "pue_high"), r[3:])])
    hits = [F.when((known == r[0]) & when.between(r[1], r[2]), row(r)) for r in DENSITY_PRIORS]
    firsts = {r[0]: r for r in reversed(DENSITY_PRIORS)}
    return F.coalesce(*hits, *[F.when(known == c, row(r)) for c, r in firsts.items()])


def range_lookup(df: DataFrame, value: Column, ranges: DataFrame, low: str, high: str, take: str, into: str) -> DataFrame:
    """``take`` of the range of whole numbers that holds the value; ranges are disjoint, gaps give null.

    Up to BROADCAST_ROWS ranges go to every task; more of them are written out number by number for an equi-join.
    """
    rows = ranges.select(F.col(low).alias("_low"), F.col(high).alias("_high"), F.col(take).alias(into))
    if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(rows), value.between(F.col("_low"), F.col("_high")), "left").drop("_low", "_high")
    each = rows.select(F.explode(F.sequence("_low", "_high")).alias("_low"), into)
    return df.join(each, value == F.col("_low"), "left").drop("_low")


def only_box(lat: Column, lon: Column, boxes: list[tuple[str, tuple[float, float, float, float]]]) -> Column:
    """The one code whose boxes hold the position; null where none or several do."""
    by_code: dict[str, list[Column]] = {}
    for code, (x0, y0, x1, y1) in boxes:
        by_code.setdefault(code, []).append(lon.between(x0, x1) & lat.between(y0, y1))
    hits = F.filter(F.array(*[F.when(reduce(lambda a, b: a | b, tests), F.lit(code)) for code, tests in by_code.items()]), lambda c: c.isNotNull())
    return F.when(F.size(hits) == 1, hits[0])


def smallest_box(lat: Column, lon: Column, boxes: list[tuple[str, tuple[float, float, float, float]]]) -> Column:
    """The code of the smallest box that holds the position; null where none does."""
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    return F.coalesce(*[F.when(lon.between(b[0], b[2]) & lat.between(b[1], b[3]), F.lit(code)) for code, b in sorted(boxes, key=lambda row: area(row[1]))])


def in_own_boxes(state: Column, lat: Column, lon: Column, boxes: list[tuple[str, tuple[float, float, float, float]]]) -> Column:
    """Inside a box of the row's own jurisdiction, edges in; false for a missing position or an unknown jurisdiction."""
    by_code: dict[str, list[Column]] = {}
    for code, (x0, y0, x1, y1) in boxes:
        by_code.setdefault(code, []).append(lon.between(x0, x1) & lat.between(y0, y1))
    chain = F.when(F.lit(False), F.lit(False))
    for code, tests in by_code.items():
        chain = chain.when(state == code, reduce(lambda a, b: a | b, tests))
    return F.coalesce(chain, F.lit(False))


def in_any_box(lat: Column, lon: Column, boxes: list[tuple[float, float, float, float]]) -> Column:
    """Inside the union of boxes, edges in; false for a missing position."""
    return F.coalesce(reduce(lambda a, b: a | b, [lon.between(x0, x1) & lat.between(y0, y1) for x0, y0, x1, y1 in boxes]), F.lit(False))


def assign_state(df: DataFrame, zip_ranges: DataFrame, boxes: list, state: str, postcode: str, lat: str, lon: str, into: str = "assigned_state") -> DataFrame:
    """Two-letter text as it is, a full name, a state before the postcode, the postcode's range, the one box; else null."""
    text = F.upper(F.trim(F.coalesce(state, F.lit(""))))
    names = F.create_map(*[F.lit(x) for code, name, *_ in JURISDICTIONS for x in (name.upper(), code)])
    before = F.regexp_extract(F.upper(F.trim(postcode)), r"^([A-Z]{2})\b", 1)
    hit = range_lookup(df.withColumn("_prefix", postcode_prefix(F.col(postcode))), F.col("_prefix"), zip_ranges, "low", "high", "state", "_zip_state")
    chosen = F.coalesce(F.when(text.rlike("^[A-Z]{2}$"), text), F.try_element_at(names, text), F.when(before.isin(*STATE_CODES), before), F.col("_zip_state"), only_box(F.col(lat), F.col(lon), boxes))
    return hit.withColumn(into, chosen).drop("_prefix", "_zip_state")


def resolve_operators(df: DataFrame, raw: str, aliases: DataFrame, unattributed: DataFrame, prefix: str = "") -> DataFrame:
    """Adds operator and operator_confidence: alias, unattributed, alias_token or unresolved, in that order.

    Distinct texts are resolved once; whether the aliases are broadcast is left to their measured size.
    """
    texts = df.select(F.col(raw).alias("_raw")).where(F.trim(raw) != "").distinct().withColumn("_key", operator_key(F.col("_raw"))).where(F.col("_key") != "")
    exact = aliases.select(F.col("alias_key").alias("_k1"), F.col("canonical").alias("_exact"))
    joined = aliases.select(F.col("alias_key").alias("_k2"), F.col("canonical").alias("_joined"))
    texts = texts.join(exact, F.col("_key") == F.col("_k1"), "left").join(joined, F.replace("_key", F.lit(" "), F.lit("")) == F.col("_k2"), "left")
    vehicles = F.broadcast(unattributed.groupBy().agg(F.collect_set("pattern").alias("_patterns")))  # one row
    texts = texts.join(vehicles).withColumn("_spv", F.exists("_patterns", lambda p: F.col("_key").contains(p) | p.contains(F.col("_key")))).drop("_patterns")
    # Whole-word containment through the words themselves: an alias is a candidate where its first word occurs.
    heads = aliases.where(F.col("alias_key").contains(" ") | (F.length("alias_key") >= 3)).select(F.split("alias_key", " ")[0].alias("_head"), "alias_key", "canonical", "ord")
    words = texts.where(F.col("_exact").isNull() & F.col("_joined").isNull() & ~F.col("_spv")).select("_raw", "_key", F.explode(F.array_distinct(F.split("_key", " "))).alias("_head"))
    inside = F.concat(F.lit(" "), "_key", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("alias_key"), F.lit(" ")))
    weight = F.length(F.replace("alias_key", F.lit(" "), F.lit("")))
    tokens = words.join(heads, "_head").where(inside).groupBy("_raw").agg(F.max_by("canonical", F.struct(weight.alias("w"), (-F.col("ord")).alias("o"))).alias("_token"))
    texts = texts.join(tokens, "_raw", "left")
    name = F.coalesce("_exact", "_joined", F.when(F.col("_spv"), F.lit(UNATTRIBUTED_LABEL)), "_token")
    how = F.when(F.coalesce("_exact", "_joined").isNotNull(), "alias").when(F.col("_spv"), "unattributed").when(F.col("_token").isNotNull(), "alias_token").otherwise("unresolved")
    known = texts.select("_raw", name.alias("_name"), how.alias("_how"))
    out = df.join(known, F.col(raw) == F.col("_raw"), "left")
    # A text without any key is no operator; one that nothing resolves stands for itself.
    standing = F.when(F.col("_how").isNotNull(), F.coalesce("_name", F.trim(raw)))
    return out.withColumn(f"{prefix}operator", standing).withColumn(f"{prefix}operator_confidence", F.coalesce("_how", F.lit("unresolved"))).drop("_raw", "_name", "_how")
