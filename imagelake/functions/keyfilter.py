"""A one-hash Bloom filter as a bounded broadcast semi-join.

Rows that can't meet any of some keys are dropped before a shuffle: keys become
slots (a hash modulo ``slots``), of which there are at most ``slots`` whatever the
number of keys, so their distinct list may always be broadcast. A row whose slot is
wanted stays, rightly or (with a chance of keys / slots) wrongly: the exact join
comes after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20


def key_filter(rows: DataFrame, keys: DataFrame, on: list[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` without those whose ``on`` columns match no row of ``keys`` for certain."""
    slot = F.pmod(F.xxhash64(*on), F.lit(slots)).alias("_slot")
    wanted = keys.select(slot).distinct()  # at most ``slots`` rows
    return rows.withColumn("_slot", slot).join(F.broadcast(wanted), "_slot", "left_semi").drop("_slot")
