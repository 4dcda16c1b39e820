"""Canonical entity ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(stored: Column, prefix: str = "S1", digits: int = 9) -> Column:
    """prefix, a dash and the number in the id in `digits` digits; null where there is no such number.

    Accepts blanks around, either case, and any separator or none between prefix and number. A number of
    more digits is kept whole.
    """
    number = F.regexp_extract(stored, rf"(?i)^\s*(?:{prefix}[^0-9]*)?0*([0-9]+)\s*$", 1)
    padded = F.when(F.length(number) >= digits, number).otherwise(F.lpad(number, digits, "0"))
    return F.when(number != "", F.concat(F.lit(f"{prefix}-"), padded))
