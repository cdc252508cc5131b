"""Text folding with built-in functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folds() -> tuple[str, str]:
    """Single letters with marks and their plain letters, by the decomposition rule of Unicode."""
    pairs = []
    for point in range(0xC0, 0x250):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain.isascii() and plain.isalpha():
            pairs.append((chr(point), plain))
    pairs += [("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"), ("đ", "d"), ("ı", "i")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


FOLD_FROM, FOLD_TO = _folds()


def fold(c: Column) -> Column:
    """Lower case without accents; sharp s and ligatures spelled out."""
    x = F.translate(c, FOLD_FROM, FOLD_TO)
    x = F.regexp_replace(x, r"\p{M}+", "")
    for sign, plain in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("Æ", "ae"), ("Œ", "oe")):
        x = F.replace(x, F.lit(sign), F.lit(plain))
    return F.lower(x)
