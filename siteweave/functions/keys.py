"""Record keys and mixed time notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_part(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"), F.lit(" \t\r\n ")))


def record_key(source: Column, source_id: Column) -> Column:
    """``source|source_id``, lower case without outer blanks; null where a part is null or blank."""
    s, i = key_part(source), key_part(source_id)
    return F.when((s != "") & (i != ""), F.concat(s, F.lit("|"), i))


def any_timestamp(c: Column) -> Column:
    """Text in ISO notation with Z, an offset or none (then UTC), or epoch seconds; else null."""
    text = F.trim(c)
    # A clock time without zone is UTC whatever the session's zone.
    text = F.when(text.rlike(r":\d{2}(?:\.\d+)?$") & ~text.rlike(r"[+-]\d{2}:\d{2}$"), F.concat(text, F.lit("Z"))).otherwise(text)
    return F.coalesce(
        text.try_cast("timestamp"),
        F.when(text.rlike(r"^\d{9,11}$"), F.timestamp_seconds(text.try_cast("bigint"))),
    )
