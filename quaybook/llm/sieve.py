"""Parting rows by a list of keys without moving the rows that aren't on it.

A list of keys that is too long to be broadcast makes a join shuffle both
sides, whole texts too. Here a bitmap goes to every task instead, where each
listed key has set one bit: rows whose bit isn't set can't be on the list and
stay where they lie; only the others, the listed ones and few more (at most
about one in ``BITS_A_KEY`` of the rest), are left for an exact join. The bitmap
is bounded: a list longer than it was made for leaves more rows to that join,
and no row is ever taken for a listed one by its bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.plans.stages import write_stage

BITS_A_KEY = 32
BLOCK = 15  # log2 of the bits of one bitmap, as Spark's bitmap functions have them
MOST = 28  # log2 of all bits, 32 MB


def _place(columns: list[Column], log_bits: int) -> Column:
    """The bit of a key; a null has one too."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << log_bits))


def parted(rows: DataFrame, on: list[str], listed: DataFrame, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(rows that are not on the list, rows that may be), by the columns
    ``on``, which have the same names and types in ``listed``. Nulls count as
    equal. ``listed`` should be a written stage, as it is read twice."""
    log_bits = min(max((BITS_A_KEY * listed.count()).bit_length(), BLOCK), most)
    place = _place([F.col(c) for c in on], log_bits)
    # Keys are dealt out before they become bitmaps, so no task sends bitmaps of few keys.
    blocks = write_stage(
        listed.select(F.shiftright(place, BLOCK).alias("__block"), place.bitwiseAND((1 << BLOCK) - 1).alias("__bit"))
        .repartition("__block").groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__bits")), "bits")
    bit = F.col("__place").bitwiseAND((1 << BLOCK) - 1)
    byte = F.conv(F.hex(F.substr("__bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    # The hint is safe, as the bits are bounded; a shuffle would move all rows.
    marked = (rows.withColumn("__place", place)
              .join(F.broadcast(blocks), F.shiftright("__place", BLOCK) == F.col("__block"), "left")
              .withColumn("__set", F.coalesce(F.getbit(byte, bit.bitwiseAND(7).cast("int")), F.lit(0).cast("tinyint"))))
    return (marked.where("__set = 0").select(*rows.columns), marked.where("__set = 1").select(*rows.columns))
