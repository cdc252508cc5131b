"""Ratings, years, postcodes and power figures in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siteweave.vocabulary import GENERATOR_SCC

RATING = r"(?i)([0-9][0-9,]*(?:\.[0-9]+)?)\s*(KW|MW|KVA|BHP|HP)\b"
MENTION = r"(?i)([^.\n]{0,140}?)([0-9][0-9,]*(?:\.[0-9]+)?)\s*(?:MW|megawatts?)([^.\n]{0,140})"
LOAD_HINT = r"(?i)\b(?:load|demand|capacity|connected|critical|it\s+load|power|electrical|substation|service|utility)\b"
GENERATOR_TEXT = r"(?i)\b(?:generator|gen\s?set|ic\s+engine|standby|emergency)\b"
POSTCODE = r"^(?:[A-Z]{2}\s+)?([0-9]{5})(?:-[0-9]{4})?$"


def number_of(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def rating_kw(text: Column) -> Column:
    """The first rating in the text in kW; null where it is outside 50 to 5,000."""
    unit = F.upper(F.regexp_extract(text, RATING, 2))
    factor = F.when(unit == "KW", 1.0).when(unit == "MW", 1000.0).when(unit == "KVA", 0.8).when(unit.isin("BHP", "HP"), 0.746)
    kw = number_of(F.regexp_extract(text, RATING, 1)) * factor
    return F.when(kw.between(50.0, 5000.0), kw)


def is_generator(scc: Column, unit: Column, process: Column) -> Column:
    """By classification code, else by words of the descriptions."""
    by_code = F.coalesce(scc.startswith(GENERATOR_SCC[0]) | scc.startswith(GENERATOR_SCC[1]), F.lit(False))
    return by_code | F.concat_ws(" ", unit, process).rlike(GENERATOR_TEXT)


def year_of(text: Column) -> Column:
    """The year in the first four characters if these are digits, 1900 to 2100."""
    digits = F.regexp_replace(F.substring(text, 1, 4), "[^0-9]", "")
    year = F.when(F.length(digits) == 4, digits.try_cast("int"))
    return F.when(year.between(1900, 2100), year)


def postcode_prefix(text: Column) -> Column:
    """First three digits as a number of what looks like a five-digit postcode, with a state before it or four digits after."""
    return F.regexp_extract(F.upper(F.trim(text)), POSTCODE, 1).substr(1, 3).try_cast("int")


def power_mentions(text: Column) -> Column:
    """Array of (value_mw, basis, quote): figures of 0.5 to 1,500 MW that words about load stand near.

    No figure's surroundings cross a full stop or a line end, so only such parts of the
    text as name the unit are searched; each figure's parts are read from its own match.
    """
    parts = F.filter(F.split(text, r"\.(?![0-9])|\n(?!\s*(?i:MW|megawatt))"), lambda p: p.rlike("(?i)MW|megawatt"))
    whole = F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(MENTION), F.lit(0))))

    def mention(m: Column) -> Column:
        near = F.lower(F.concat_ws(" ", F.regexp_extract(m, MENTION, 1), F.regexp_extract(m, MENTION, 3)))
        basis = F.when(near.contains("critical") | near.contains("it load"), "critical_load").otherwise("total_facility")
        value = number_of(F.regexp_extract(m, MENTION, 2))
        return F.struct(value.alias("value_mw"), basis.alias("basis"), F.substring(F.regexp_replace(F.trim(m), r"\s+", " "), 1, 400).alias("quote"), near.rlike(LOAD_HINT).alias("about_load"))

    kept = F.filter(F.transform(whole, mention), lambda m: m["about_load"] & m["value_mw"].between(0.5, 1500.0))
    return F.transform(kept, lambda m: F.struct(m["value_mw"].alias("value_mw"), m["basis"].alias("basis"), m["quote"].alias("quote")))
