"""Which delivered values can be used, and which delivery of a record is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.keys import key_part

#: Words that stand in for a missing text, after lower case and without signs at the ends.
STAND_INS = (
    "n/a", "na", "n.a", "none", "null", "nil", "nan", "unknown", "unk", "unnamed", "not available", "not applicable", "not disclosed", "not provided",
    "not specified", "not known", "undisclosed", "withheld", "address withheld", "name withheld", "tbd", "tba", "tbc", "to be determined", "to be announced",
    "to be confirmed", "pending", "missing", "no name", "no address", "no data", "unspecified", "confidential", "redacted", "test", "xxx", "xx", "x", "various",
    "unnamed data center", "unnamed datacenter", "unnamed data centre", "unnamed site", "unnamed facility", "unnamed building", "data center name", "name unknown",
    "address unknown", "unknown address", "unknown name", "private", "anonymous",
)


def text_usable(c: Column) -> Column:
    """Neither null, blank, signs only nor a stand-in."""
    bare = F.regexp_replace(F.lower(c), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.coalesce((bare != "") & ~bare.isin(*STAND_INS), F.lit(False))


def area_usable(c: Column) -> Column:
    """A number of square metres that a building can have: 1 to 5 million, and no whole number of nines or of digits in a row."""
    filler = (c == F.floor(c)) & (F.format_string("%.0f", c).rlike(r"^9{4,}$") | c.isin(12345.0, 123456.0, 1234567.0))
    return F.coalesce(~F.isnan(c) & (c >= 1) & (c <= 5e6) & ~filler, F.lit(False))


def valid_deliveries(records: DataFrame) -> DataFrame:
    """Of each record the delivery with the greatest updated_at, then row_id; with src and sid, the parts of its key."""
    rows = records.withColumn("src", key_part(F.col("source"))).withColumn("sid", key_part(F.col("source_id")))
    rows = rows.where((F.col("src") != "") & (F.col("sid") != ""))
    keep = [c for c in rows.columns if c not in ("src", "sid")]
    newest = F.max_by(F.struct(*keep), F.struct(F.coalesce(F.col("updated_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), F.col("row_id")))
    return rows.groupBy("src", "sid").agg(newest.alias("r")).select("src", "sid", "r.*")
