"""Names, addresses and codes of sites, compared with built-in functions; one Arrow kernel for the block ratio."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siteweave.vocabulary import NAME_STOPWORDS, OPERATOR_NOISE, STREET_SHORT

CODE_PATTERN = r"^[a-z]{2,4}[0-9]{1,3}[a-z]?$"
FULL_NEAR_M, REACH_M = 60.0, 1000.0


def _words(c: Column) -> Column:
    """Lower-case runs of letters and digits; an empty list for null."""
    cleaned = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]+", " ")
    return F.filter(F.split(cleaned, " "), lambda w: w != "")


def operator_key(c: Column) -> Column:
    x = F.regexp_replace(F.lower(c), "[^a-z0-9& ]", " ")
    x = F.regexp_replace(x, rf"\b(?:{'|'.join(OPERATOR_NOISE)})\b", " ")
    return F.trim(F.regexp_replace(x, " +", " "))


def name_tokens(c: Column) -> Column:
    return F.array_except(F.array_distinct(_words(c)), F.array(*[F.lit(w) for w in NAME_STOPWORDS]))


def code_tokens(c: Column) -> Column:
    return F.filter(name_tokens(c), lambda t: t.rlike(CODE_PATTERN))


def short_address(c: Column) -> Column:
    """The address in short words; empty for null."""
    short = F.create_map(*[F.lit(x) for pair in STREET_SHORT.items() for x in pair])
    return F.array_join(F.transform(_words(c), lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def street_number(address: Column) -> Column:
    return F.nullif(F.regexp_extract(address, "^([0-9]+)", 1), F.lit(""))


def jaccard(a: Column, b: Column) -> Column:
    """0 where either set is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def distance_credit(metres: Column) -> Column:
    """1 up to 60 m, falling to 0 at 1,000 m."""
    return F.when(metres <= FULL_NEAR_M, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - (metres - FULL_NEAR_M) / (REACH_M - FULL_NEAR_M)))


@lru_cache(maxsize=200_000)
def _ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """Equal texts and missing ones need no comparison; a worker compares two texts once."""
    return pd.Series([0.0 if not x or not y else 1.0 if x == y else _ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def block_ratio(a: Column | str, b: Column | str) -> Column:
    """Share of letters in matching blocks (longest block first, then left and right of it); 0 where either text is empty. Not symmetric."""
    return F.pandas_udf(_ratios, "double")(a, b)


def cannot_link(a_codes: Column, b_codes: Column, a_number: Column, b_number: Column) -> Column:
    """Why two records can't be one site; null where nothing forbids it."""
    codes = (F.size(a_codes) > 0) & (F.size(b_codes) > 0) & ~F.arrays_overlap(a_codes, b_codes)
    return F.when(codes, "distinct_site_codes").when(a_number != b_number, "distinct_street_numbers")


def pair_score(distance: Column, name: Column, address: Column, operator: Column, shared_code: Column, both_operators: Column, metres: Column) -> Column:
    """Weighted sum with floors for decisive evidence, then the cap for another operator at a distance."""
    score = 0.34 * distance + 0.24 * name + 0.22 * address + 0.20 * operator
    score = F.when(shared_code, F.greatest(score, F.lit(0.82))).otherwise(score)
    score = F.when((operator >= 0.99) & (metres <= 250), F.greatest(score, F.lit(0.80))).otherwise(score)
    score = F.when((operator >= 0.99) & (address >= 0.90), F.greatest(score, F.lit(0.82))).otherwise(score)
    score = F.when(both_operators & (operator < 0.55) & (metres > 150), F.least(score, F.lit(0.45))).otherwise(score)
    return F.least(score, F.lit(1.0))


def five_places(c: Column) -> Column:
    """A coordinate with five decimals, rounded by its exact binary value; the formatter of the JVM rounds its shortest decimal form, which differs at ties.

    The number is cut at 2**-20, so that either part times 100,000 is exact.
    """
    x = F.abs(c)
    high = F.floor(x * 1048576.0).cast("double") / 1048576.0
    scaled, rest = high * 100000.0, (x - high) * 100000.0
    whole = F.floor(scaled)
    gap = F.lit(0.5) - (scaled - whole.cast("double"))
    up = F.when(rest > gap, 1).when(rest == gap, whole % 2).otherwise(0)
    n = (whole + up).cast("bigint")
    text = F.concat(F.floor(n / 100000).cast("string"), F.lit("."), F.lpad((n % 100000).cast("string"), 5, "0"))
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), text)


def facility_id(name: Column, lat: Column, lon: Column) -> Column:
    """A readable slug of the name with six digits of a digest of slug and position."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    slug = F.coalesce(F.nullif(F.substring(slug, 1, 44), F.lit("")), F.lit("facility"))
    digest = F.sha1(F.concat_ws("|", slug, five_places(lat), five_places(lon)))
    return F.concat(slug, F.lit("-"), F.substring(digest, 1, 6))
