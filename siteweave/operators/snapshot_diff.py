"""What changed between consecutive full snapshots of a table.

Keys fall into hash ranges. Every range of every snapshot has a digest, and
ranges form a Merkle tree; trees of consecutive snapshots are compared from the
top, and only rows of leaf ranges whose digests differ are read again and compared
one by one. Only digests are written: one row for about ROWS_A_LEAF rows of a
snapshot, and for every level above a FANOUTth of that.

Defined results for odd input:

* null and blank text are alike, as are missing and blank map values, null and
  empty lists, NaN and null numbers; order in lists and maps is ignored;
* of several rows of one key in one snapshot the one with the latest version
  counts, then the latest tie column, then the greatest digest;
* rows with a null key or a null snapshot are no records and are left out;
* an empty table, or one snapshot only, gives no rows; columns that are not
  compared may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteweave.storage import Scratch

BLANKS = " \t\r\n "
#: The stated step less the rounding of degrees in binary, so that two values written one step apart differ.
COORDINATE_STEP = 0.000001 - 1e-12
FANOUT_BITS = 4
#: Rows of a snapshot in a leaf: few, so that a leaf without a change is likely.
ROWS_A_LEAF = 8


def _trim(c: Column) -> Column:
    return F.coalesce(F.trim(c, F.lit(BLANKS)), F.lit(""))


def _canonical(c: Column, kind: T.DataType) -> Column:
    """A text that is equal for values that count as equal."""
    if isinstance(kind, T.StringType):
        return _trim(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(c), F.lit("")).otherwise(F.coalesce(c.cast("string"), F.lit("")))
    if isinstance(kind, T.ArrayType):
        items = F.transform(c, lambda x: _canonical(x, kind.elementType))
        return F.coalesce(F.array_join(F.array_sort(items), "\x1f"), F.lit(""))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("k"), _canonical(e["value"], kind.valueType).alias("v")))
        kept = F.array_sort(F.filter(entries, lambda e: e["v"] != ""))
        return F.coalesce(F.array_join(F.transform(kept, lambda e: F.concat(e["k"], F.lit("\x1e"), e["v"])), "\x1f"), F.lit(""))
    if isinstance(kind, T.StructType):
        return F.concat_ws("\x1d", *[_canonical(c[f.name], f.dataType) for f in kind.fields])
    return F.coalesce(c.cast("string"), F.lit(""))


def _is_point_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and all(isinstance(f.dataType, T.DoubleType) for f in kind.elementType.fields)


def _is_box(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and all(isinstance(f.dataType, T.DoubleType) for f in kind.fields)


def _points(c: Column, a: str, b: str) -> Column:
    return F.transform(c, lambda p: F.struct(p[a].alias("a"), p[b].alias("b")))


def canonical_rows(df: DataFrame, series: str, key: Column, snapshot: str, version: Column, tie: Column, ignore: Sequence[str], coordinates: Sequence[str]) -> DataFrame:
    """One row (series, key, snap, digest a, digest b, coords, ring) per delivered row, in one narrow pass.

    ``series`` names the table; each has its own snapshot dates, and several can be compared in one run.
    ``coordinates`` names double columns compared with a tolerance; boxes (structs of
    doubles) and point lists are compared so as well.
    """
    content, coords, rings = [], [], []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f"`{field.name}`")
        if field.name in ignore or field.name == snapshot:
            continue
        if field.name in coordinates:
            coords.append(F.nanvl(c, F.lit(None).cast("double")))
        elif _is_box(field.dataType):
            coords += [F.nanvl(c[f.name], F.lit(None).cast("double")) for f in field.dataType.fields]
        elif _is_point_list(field.dataType):
            rings.append(_points(c, *(f.name for f in field.dataType.elementType.fields[:2])))
        else:
            content.append(_canonical(c, field.dataType))
    text = F.concat_ws("\x00", *content) if content else F.lit("")
    out = df.select(
        F.lit(series).alias("series"),
        key.alias("key"),
        F.col(f"`{snapshot}`").cast("date").alias("snap"),
        version.alias("version"),
        tie.alias("tie"),
        F.xxhash64(text).alias("a"),
        F.xxhash64(F.lit("second"), text).alias("b"),
        (F.array(*coords) if coords else F.array().cast("array<double>")).alias("coords"),
        (F.flatten(F.array(*[F.coalesce(r, F.array().cast("array<struct<a:double,b:double>>")) for r in rings])) if rings else F.array().cast("array<struct<a:double,b:double>>")).alias("ring"),
    )
    return out.where(F.col("key").isNotNull() & F.col("snap").isNotNull())


def _near(x: Column, y: Column) -> Column:
    return F.coalesce(F.abs(x - y) < COORDINATE_STEP, F.lit(False)) | (x.isNull() & y.isNull())


def _alike(left: str, right: str) -> Column:
    """Equal content, coordinates within the step; point lists in any order."""
    l, r = (lambda n: F.col(f"{left}.{n}")), (lambda n: F.col(f"{right}.{n}"))
    same_coords = F.forall(F.zip_with(l("coords"), r("coords"), _near), lambda x: x)
    point = lambda p, q: _near(p["a"], q["a"]) & _near(p["b"], q["b"])
    in_order = F.forall(F.zip_with(l("ring"), r("ring"), point), lambda x: x)
    found = lambda these, those: F.forall(these, lambda p: F.exists(those, lambda q: point(p, q)))
    ring = (F.size(l("ring")) == F.size(r("ring"))) & (in_order | (found(l("ring"), r("ring")) & found(r("ring"), l("ring"))))
    return (l("a") == r("a")) & (l("b") == r("b")) & same_coords & ring


def snapshot_changes(rows: DataFrame, leaf_bits: int | None = None) -> DataFrame:
    """(series, key, snap, change) against the snapshot just before, from ``canonical_rows``.

    ``rows`` is read twice: for the digests, and for the leaves that differ.
    ``leaf_bits``: the tree has 2**leaf_bits leaves a snapshot; by default as many as
    leave about ROWS_A_LEAF rows in each at any size.
    """
    scratch = Scratch(rows.sparkSession, "snapshot-diff")
    counts = scratch.cut(rows.groupBy("series", "snap").count())
    if leaf_bits is None:
        widest = counts.agg(F.max("count")).first()[0] or 1
        leaf_bits = max(1, (widest // ROWS_A_LEAF).bit_length())
    rows = rows.withColumn("bucket", F.shiftrightunsigned(F.xxhash64("key"), 64 - leaf_bits))
    # A snapshot is the later one of one step and the earlier one of the next; one row for each date.
    order = Window.partitionBy("series").orderBy("snap")
    dates = counts.select("series", "snap", F.lag("snap").over(order).alias("before"), F.lead("snap").over(order).alias("after"))
    roles = F.array(F.when(F.col("before").isNotNull(), F.struct(F.col("snap").alias("step"), F.lit(True).alias("now"))), F.when(F.col("after").isNotNull(), F.struct(F.col("after").alias("step"), F.lit(False).alias("now"))))
    steps = scratch.cut(dates.select("series", "snap", F.explode(F.filter(roles, lambda r: r.isNotNull())).alias("r")).select("series", "snap", "r.step", "r.now"))

    version = F.struct("version", "tie", "a", "b")
    digest = F.xxhash64("key", "a", "b", "coords", "ring")
    newest = rows.groupBy("series", "snap", "bucket", "key").agg(F.max_by(digest, version).alias("digest"))
    leaves = newest.groupBy("series", "snap", "bucket").agg(F.bit_xor("digest").alias("x"), F.sum(F.col("digest").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n"))
    leaves = leaves.select("series", "snap", "bucket", F.xxhash64("x", "s", "n").alias("d")).join(steps, ["series", "snap"])
    side = lambda now: F.max(F.when(F.col("now") == now, F.col("d")))
    level = scratch.cut(leaves.groupBy("series", "step", F.col("bucket").alias("node")).agg(side(True).alias("now"), side(False).alias("then")))
    # Upwards: the digests of a node's children make its own.
    levels = [level]
    for _ in range(FANOUT_BITS, leaf_bits, FANOUT_BITS):
        mixed = lambda c: F.bit_xor(F.xxhash64("node", c)).alias(c)
        level = scratch.cut(level.groupBy("series", "step", F.shiftright("node", FANOUT_BITS).alias("parent")).agg(mixed("now"), mixed("then")).withColumnRenamed("parent", "node"))
        levels.append(level)
    # Downwards: children of nodes that differ only.
    differing: DataFrame | None = None
    for level in reversed(levels):
        if differing is not None:
            level = level.withColumn("parent", F.shiftright("node", FANOUT_BITS)).join(differing.withColumnRenamed("node", "parent"), ["series", "step", "parent"], "left_semi")
        differing = scratch.cut(level.where(~F.col("now").eqNullSafe(F.col("then"))).select("series", "step", "node"))
    scratch.drop(*levels)

    doubtful = rows.join(steps, ["series", "snap"]).join(differing.withColumnRenamed("node", "bucket"), ["series", "step", "bucket"], "left_semi")
    row = F.struct("a", "b", "coords", "ring")
    of = lambda now: F.max_by(F.when(F.col("now") == now, row), F.when(F.col("now") == now, version))
    both = doubtful.groupBy("series", "step", "bucket", "key").agg(of(True).alias("now"), of(False).alias("then"))
    change = F.when(F.col("then").isNull(), "added").when(F.col("now").isNull(), "removed").when(~_alike("now", "then"), "changed")
    return both.select("series", "key", F.col("step").alias("snap"), change.alias("change")).where(F.col("change").isNotNull())
