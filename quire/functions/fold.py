"""JVM-side folding of text: case, accents and width, without a Python UDF.

The translation tables are made by rule from Unicode's own data, so they need no upkeep.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Composed Latin, Greek and Cyrillic letters, and their base letters."""
    src, dst = [], []
    for first, last in ((0xC0, 0x24F), (0x370, 0x4FF), (0x1E00, 0x1FFF)):
        for code in range(first, last + 1):
            ch = chr(code)
            base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
            if base != ch and len(base) == 1:
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


@lru_cache(maxsize=1)
def width_table() -> tuple[str, str]:
    """Full-width ASCII forms and the ideographic space, and what they stand for."""
    codes = range(0xFF01, 0xFF5F)
    return "".join(map(chr, codes)) + "　", "".join(chr(c - 0xFEE0) for c in codes) + " "


def fold_case(c: Column) -> Column:
    """Caseless form: lower case with the sharp s as ss, as in full case folding."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def strip_accents(c: Column) -> Column:
    """Letters without their accents, composed or in parts."""
    return F.regexp_replace(F.translate(c, *accent_table()), r"\p{M}+", "")


def narrow(c: Column) -> Column:
    """Full-width forms as the ordinary characters they stand for."""
    return F.translate(c, *width_table())


def loose(c: Column) -> Column:
    """Letters and digits only, caseless, without accents: the form in which free entries are compared."""
    return F.regexp_replace(strip_accents(fold_case(narrow(c))), r"[^\p{L}\p{N}]+", "")
