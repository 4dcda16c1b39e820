"""Salting of hot keys from a summary of fixed size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 4096
PIECES = 256


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


def salts_by_slot(df: DataFrame, key: Column, min_rows: int = 20_000) -> dict[int, int]:
    """Slots of keys that hold more than 1/PIECES of all rows, with the number of salts each needs.

    Keys are hashed to SLOTS slots and rows are counted by slot, so the driver sees at most SLOTS counts
    and the result has fewer than PIECES entries whatever the data. A key that shares a hot slot is salted
    as well, which costs little and changes nothing in the result.
    """
    counts = df.groupBy(slot(key).alias("slot")).count().collect()
    target = max(min_rows, sum(r["count"] for r in counts) / PIECES)
    return {r["slot"]: math.ceil(r["count"] / target) for r in counts if r["count"] > target}


def n_salts(key: Column, salts: dict[int, int]) -> Column:
    """How many salts the key has: 1 unless its slot is hot."""
    if not salts:
        return F.lit(1)
    known = F.create_map(*[F.lit(x) for k, v in sorted(salts.items()) for x in (k, v)])
    return F.coalesce(F.try_element_at(known, slot(key).cast("int")), F.lit(1))


def salt(key: Column, spread: Column, salts: dict[int, int]) -> Column:
    """Salt of a row, from a column that varies within the key."""
    if not salts:
        return F.lit(0)
    return F.pmod(F.xxhash64(spread, F.lit(7)), n_salts(key, salts)).cast("int")


def all_salts(key: Column, salts: dict[int, int]) -> Column:
    """Every salt of the key, for the side that must meet all its pieces."""
    return F.explode(F.sequence(F.lit(0), n_salts(key, salts) - 1))
