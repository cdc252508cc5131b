"""Names of organisations as people typed them, linked to a list of organisations.

Suffix blocking: of every name on the list, its coined word and the short forms
that people make of it (first letters, consonants only), all suffixes of at least
MIN_SUFFIX letters are indexed, and of each word read backwards too, so that a
slip at either end leaves a suffix whole. A suffix that many organisations share is
refined with the first letter of the name, and dropped only if more than COMMON_SHARE
of all organisations still have it then; a pair with more in common than that also
shares its longer suffixes, which are indexed to their full length.

Pairs from the index are compared by the longest common subsequence. The ratio of the
name to the listed writing ranks the candidates; a part of the name counts as the
organisation's word for its trade if it is a subsequence of it but for one sign in
seven (TRADE_RATIO), so any way to shorten it is one, and the rest must be the coined
word: whole, with one slip of the pen, or a short form of it beside that trade.

Names that carry no organisation's word are linked to none, also where their
first letters or their trade agree with one.

Defined results for odd input: null, blank and sign-only names are linked to none;
of two organisations that fit equally well the one with the smaller id is taken;
repeated rows count once; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.text import fold
from siteweave.storage import Scratch

MIN_SUFFIX = 3
#: Share of the listed organisations that may have a suffix before it is refined, and after; so few as COMMON are never too many.
COMMON_SHARE, COMMON = 0.04, 12
#: Share of the coined word that the name must have as a common subsequence; a short form of half the word still has that.
MIN_RATIO = 0.5
#: Share of the shorter of two words for a trade that must be common to both.
TRADE_RATIO = 0.85

LEGAL = ("inc", "incorporated", "llc", "lp", "llp", "ltd", "limited", "corp", "corporation", "co", "company", "holdings", "holding", "group", "plc", "the", "and")
STATES = (
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware", "district of columbia", "florida", "georgia", "hawaii",
    "idaho", "illinois", "indiana", "iowa", "kansas", "kentucky", "louisiana", "maine", "maryland", "massachusetts", "michigan", "minnesota", "mississippi",
    "missouri", "montana", "nebraska", "nevada", "new hampshire", "new jersey", "new mexico", "new york", "north carolina", "north dakota", "ohio", "oklahoma",
    "oregon", "pennsylvania", "rhode island", "south carolina", "south dakota", "tennessee", "texas", "utah", "vermont", "west virginia", "virginia", "washington",
    "wisconsin", "wyoming",
)
#: Other words for a trade, without blanks, that are no way to shorten it; a parameter of ``link_names``.
TRADE_ALIASES = {"telecom": ("telecommunications",), "interconnect": ("ix",), "hosting": ("hostingservices", "hostingservice", "hostingsvcs", "hostingsvc")}


def words_of(c: Column) -> Column:
    """Folded words without legal forms, a leading article, possessive endings and a state at the end."""
    x = F.regexp_replace(fold(c), r"['`´‘’]s\b", "")
    x = F.regexp_replace(x, r"\bl\s*\.\s*l\s*\.\s*c\b\.?", "llc")
    x = F.regexp_replace(x, r"\bl\s*\.\s*p\b\.?", "lp")
    x = F.regexp_replace(x, r"(?<=[a-z0-9])[-‐-―](?=[a-z0-9])", "")
    x = F.regexp_replace(x, r"[^a-z0-9]+", " ")
    x = F.regexp_replace(x, rf"\b(?:{'|'.join(LEGAL)})\b", " ")
    x = F.trim(F.regexp_replace(x, " +", " "))
    return F.regexp_replace(x, rf"(?: of| in)? (?:{'|'.join(STATES)})$", "")


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by the bit-parallel method."""
    where: dict[str, int] = {}
    for i, sign in enumerate(a):
        where[sign] = where.get(sign, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for sign in b:
        hit = row & where.get(sign, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def within_one_slip(a: str, b: str) -> bool:
    """Equal, or one letter more, fewer or other, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    ra, rb = a[i:], b[i:]
    return ra[1:] == rb[1:] or ra[1:] == rb or ra == rb[1:] or (len(ra) > 1 and len(rb) > 1 and ra[0] == rb[1] and ra[1] == rb[0] and ra[2:] == rb[2:])


def slips(a: str, b: str) -> int:
    """Letters added, left out, replaced or swapped with a neighbour, at least; 9 where the lengths tell that it is over 2."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 2:
        return 9
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, older[j - 2] + 1)
            row.append(best)
    return row[-1]


def skeletons(word: str) -> set[str]:
    bare = "".join(c for c in word if c not in "aeiou")
    return {bare, word[:1] + "".join(c for c in word[1:] if c not in "aeiou")}


def short_forms(word: str) -> set[str]:
    cut = {word[:n] for n in range(4, len(word))}
    return {f for f in cut | skeletons(word) if len(f) >= MIN_SUFFIX and f != word}


@lru_cache(maxsize=65_536)
def same_trade(part: str, trade: str, aliases: tuple[str, ...] = ()) -> bool:
    """Whether a part of a name is the word for a trade or short for it."""
    if part in aliases:
        return True
    if len(part) < 2 or len(part) > len(trade) + 3 or part[0] != trade[0]:
        return False
    return lcs_length(part, trade) >= TRADE_RATIO * min(len(part), len(trade))


@lru_cache(maxsize=4096)
def _short_forms(coined: str) -> tuple[str, ...]:
    return tuple(sorted(short_forms(coined), key=lambda f: (-len(f), f)))


def closeness(text: str, coined: str, trade: str, aliases: tuple[str, ...] = ()) -> float:
    """0 for another body; else larger the closer: 3 for the coined word itself, 2 and its ratio for a slip, 1 and its ratio for a short form."""
    if lcs_length(text, coined) < MIN_RATIO * len(coined):
        return 0.0
    if text == coined:
        return 3.0
    ratio = max(lcs_length(text, full) / max(len(text), len(full)) for full in (coined + trade, trade + coined))
    # The name as a head and what stands behind it, and the other way about.
    parts = lambda n: ((text[:n], text[n:]), (text[len(text) - n :], text[: len(text) - n])) if 0 < n < len(text) else ()
    if any(head == coined and same_trade(rest, trade, aliases) for head, rest in parts(len(coined))):
        return 3.0
    if len(coined) >= 5:
        if any(within_one_slip(text, full) for full in (coined, coined + trade, trade + coined)):
            return 2 + ratio
        for n in (len(coined), len(coined) - 1, len(coined) + 1):
            if any(within_one_slip(head, coined) and same_trade(rest, trade, aliases) for head, rest in parts(n)):
                return 2 + ratio
    for form in _short_forms(coined):
        if any(head == form and same_trade(rest, trade, aliases) for head, rest in parts(len(form))):
            return 1 + ratio / 2 + len(form) / 100
    return 0.0


def _suffix_keys(batches: Iterator[pd.DataFrame], longest: int | None = None) -> Iterator[pd.DataFrame]:
    """Suffixes of names, of up to ``longest`` letters; of listed names, where that is not given, with those of their short forms."""
    for batch in batches:
        rows = set()
        for ident, text in zip(batch["ident"], batch["text"]):
            words = text.split()
            joined = "".join(words)
            forms = {joined, *words}
            for at in range(1, len(words)):
                forms |= {"".join(words[:at]), "".join(words[at:])}
            if longest is None and words:
                forms |= short_forms(words[0])
            for form in forms:
                for way, letters in (("<", form), (">", form[::-1])):
                    rows |= {(ident, joined[:1], way + letters[-n:]) for n in range(MIN_SUFFIX, min(len(letters), longest or len(letters)) + 1)}
        yield pd.DataFrame(list(rows), columns=["ident", "initial", "suffix"])


def link_names(names: DataFrame, listed: DataFrame, aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(text, id, score): every distinct name text (as ``words_of`` gives it) and the listed organisation (id, name) that it denotes."""
    spark = names.sparkSession
    aliases = TRADE_ALIASES if aliases is None else aliases
    scratch = Scratch(spark, "names")
    # Few bytes but much work per row: spread over all tasks, by a key of its own, since one that a distinct has left would be coalesced by size.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = names.select(F.col("text").alias("ident")).where(F.length(F.replace("ident", F.lit(" "), F.lit(""))) >= MIN_SUFFIX).distinct().withColumn("text", F.col("ident")).repartition(tasks, F.xxhash64("ident"))
    bodies = scratch.cut(listed.select(F.col("id").cast("string").alias("ident"), words_of(F.col("name")).alias("text")).where(F.col("text") != "").distinct())
    keys = "ident string, initial string, suffix string"
    index = scratch.cut(bodies.repartition(tasks, F.xxhash64("ident")).mapInPandas(_suffix_keys, keys).distinct())
    size = bodies.agg(F.count("*"), F.max(F.length("text"))).first()
    many, longest = max(COMMON, int(COMMON_SHARE * size[0])), size[1] or MIN_SUFFIX
    common = index.groupBy("suffix").count().where(F.col("count") > many).select("suffix")
    plain = index.join(common, "suffix", "left_anti").select(F.col("suffix").alias("block"), F.col("ident").alias("body"))
    refined = index.join(common, "suffix", "left_semi").select(F.concat("suffix", F.lit("|"), "initial").alias("block"), F.col("ident").alias("body"))
    kept = refined.join(refined.groupBy("block").count().where(F.col("count") <= many).select("block"), "block", "left_semi")
    blocks = plain.unionByName(kept)
    asked = texts.mapInPandas(lambda b: _suffix_keys(b, longest), keys)
    asked = asked.withColumn("block", F.explode(F.array("suffix", F.concat("suffix", F.lit("|"), "initial")))).select("ident", "block")
    pairs = asked.join(blocks, "block").select("ident", "body").distinct()
    pairs = pairs.join(bodies.select(F.col("ident").alias("body"), F.split("text", " ").alias("w")), "body")
    pairs = pairs.repartition(tasks, F.xxhash64("ident", "body"))
    pairs = pairs.select("ident", "body", F.col("w")[0].alias("coined"), F.array_join(F.slice("w", 2, 100), "").alias("trade"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [closeness(i.replace(" ", ""), c, t, aliases.get(t, ())) for i, c, t in zip(batch["ident"], batch["coined"], batch["trade"])]
            out = pd.DataFrame({"text": batch["ident"], "id": batch["body"], "score": scores})
            yield out[out["score"] > 0]

    found = pairs.mapInPandas(compare, "text string, id string, score double")
    best = F.max(F.struct("score", (-F.col("id").cast("bigint")).alias("nid")))
    return found.groupBy("text").agg(best.alias("b")).select("text", (-F.col("b.nid")).cast("int").alias("id"), F.col("b.score").alias("score"))
