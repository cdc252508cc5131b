"""The surviving values of a group of duplicate records, field by field.

A record dominates another of its group if it has at least as many usable fields,
is trusted at least as much and is at least as recent, and is better in one of the
three. The undominated records are the first layer, the undominated ones of the rest
the second, and so on, as many layers as there are: a record's layer is one more than
the highest of those that dominate it.

Within a layer the policy decides: most trusted, then latest, then smallest id. The
first record of the first layer is the base. A field that it lacks is filled from the
records after it in that layer, then from the successive layers. The policy has the
last word between layers too: completeness counts fields, so a record that alone is
trusted most for a field may stand behind a fuller one that lacks it; the layers are
gone through to the end, and a later layer's record takes the field if the policy puts
it before what was found so far. ``layer`` tells where each value came from.

Records of a group with the same usable fields and trust differ in recency only,
so all but the latest of them are dominated by it and have nothing that it lacks.
They are reduced to it before the shuffle, which leaves at most 2**fields times the
number of trust ranks per group, however large the group is; layers are those of
the records left.

Defined results for odd input: a null trust comes after every rank, a null time
before every other; equal records count once; a group without a usable value of
a field gives no row for it; a null group is none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_TRUST = 1 << 30


def _dominates(d: Column, c: Column) -> Column:
    alike = (d["full"] >= c["full"]) & (d["trust"] <= c["trust"]) & (d["ago"] <= c["ago"])
    return alike & ((d["full"] > c["full"]) | (d["trust"] < c["trust"]) | (d["ago"] < c["ago"]))


def survivors(records: DataFrame, group: str, usable: Sequence[tuple[str, Column]], trust: Column, time: Column, identity: Sequence[str]) -> DataFrame:
    """(group, field, *identity, layer): the record that gives the surviving value of each field.

    ``usable``: field names, and whether a record's value of it can be used; ``identity``:
    text columns that name a record, compared in that order for ties.
    """
    mask = reduce(lambda x, y: x + y, [F.when(F.coalesce(ok, F.lit(False)), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, ok) in enumerate(usable)])
    # Microseconds before an end of time, so that smaller is better for every part of the policy.
    ago = -F.coalesce(F.unix_micros(time.cast("timestamp")), F.lit(-(1 << 62)))
    rows = records.select(F.col(group).alias("grp"), mask.cast("int").alias("mask"), F.coalesce(trust.cast("int"), F.lit(NO_TRUST)).alias("trust"), ago.alias("ago"), F.struct(*identity).alias("id"))
    rows = rows.where(F.col("grp").isNotNull() & (F.col("mask") > 0))
    reduced = rows.groupBy("grp", "mask", "trust").agg(F.min(F.struct("ago", "id")).alias("best"))
    record = F.struct("trust", "best.ago", (-F.bit_count("mask")).alias("lack"), "best.id", "mask")
    ordered = F.transform(F.array_sort(F.collect_list(record)), lambda c: F.struct(c["trust"].alias("trust"), c["ago"].alias("ago"), (-c["lack"]).alias("full"), c["id"].alias("id"), c["mask"].alias("mask"), F.lit(1).alias("layer")))
    lists = reduced.groupBy("grp").agg(ordered.alias("records"))
    # In this order a record comes after all that dominate it, whose layers are known by then.
    empty = F.filter("records", lambda c: F.lit(False))
    layered = F.aggregate("records", empty, lambda done, c: F.concat(done, F.array(c.withField("layer", _layer(done, c)))))
    # By layer, and within each by the policy.
    policy = F.transform(layered, lambda c: F.struct(c["layer"].alias("layer"), c["trust"].alias("trust"), c["ago"].alias("ago"), c["id"].alias("id"), c["mask"].alias("mask")))
    lists = lists.select("grp", F.array_sort(policy).alias("ordered"))
    fields = F.explode(F.array(*[_first_with(k, name) for k, (name, _) in enumerate(usable)]))
    out = lists.withColumn("win", fields).where(F.col("win.taken").isNotNull())
    return out.select(F.col("grp").alias(group), F.col("win.field").alias("field"), *[F.col(f"win.taken.id.{c}").alias(c) for c in identity], F.col("win.taken.layer").alias("layer"))


def _layer(done: Column, c: Column) -> Column:
    above = F.transform(F.filter(done, lambda d: _dominates(d, c)), lambda d: d["layer"])
    return F.coalesce(F.array_max(above), F.lit(0)) + 1


def _first_with(k: int, name: str) -> Column:
    """Layer after layer: the record in front of its layer, and one of a later layer where the policy puts it before."""
    having = F.filter("ordered", lambda c: c["mask"].bitwiseAND(F.lit(1 << k)) != 0)
    rank = lambda c: F.struct(c["trust"], c["ago"], c["id"])
    before = F.aggregate(having, F.try_element_at(having, F.lit(1)), lambda best, c: F.when(rank(c) < rank(best), c).otherwise(best))
    return F.struct(F.lit(name).alias("field"), before.alias("taken"))
