"""Instrument codes and names in one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def market_code(c: Column) -> Column:
    """SHSE.600000, 600000SH, 600000.sh or 600000 to 600000.SH; what has no six digits is NULL."""
    up = F.upper(F.trim(c))
    digits = F.regexp_extract(up, r"(?:^|[^0-9])([0-9]{6})(?:[^0-9]|$)", 1)
    named = F.when(up.rlike(r"SH"), F.lit("SH")).when(up.rlike(r"SZ"), F.lit("SZ"))
    market = F.coalesce(named, F.when(digits.startswith("6"), F.lit("SH")).otherwise(F.lit("SZ")))
    return F.when(digits != "", F.concat_ws(".", digits, market))


def vendor_code(c: Column) -> Column:
    """600000.SH to SHSE.600000."""
    m = market_code(c)
    return F.concat(F.when(m.endswith("SH"), F.lit("SHSE.")).otherwise(F.lit("SZSE.")), F.substring(m, 1, 6))


def is_a_share(c: Column) -> Column:
    """Six digits and a market, without the B shares (900, 200)."""
    m = market_code(c)
    return F.coalesce(m.rlike(r"^[0-9]{6}\.(SH|SZ)$") & ~m.startswith("900") & ~m.startswith("200"), F.lit(False))


_FULL = "".join(chr(0xFEE0 + i) for i in range(0x21, 0x7F)) + chr(0x3000)
_HALF = "".join(chr(i) for i in range(0x21, 0x7F)) + " "


def plain_name(c: Column) -> Column:
    """Full-width characters as half-width ones, all but letters, digits and Han as one underscore, upper case."""
    half = F.translate(c, _FULL, _HALF)
    return F.upper(F.regexp_replace(F.regexp_replace(half, "[^0-9A-Za-z一-龥]+", "_"), "^_+|_+$", ""))


def industry_column(standard: Column, level: Column, name: Column) -> Column:
    return F.concat(F.lit("IND_"), standard, F.lit("_L"), level.cast("string"), F.lit("__"), plain_name(name))
