"""A mark of fixed size for rows whose key may be among some keys, to spare a join the shuffle of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, ROW = 1 << 23, 1 << 15
"""A megabyte in rows of 4 KB, whatever the number of keys: with more keys more rows are marked, never one too few."""


def flagged_in(rows: DataFrame, keys: DataFrame, column: str, key: str) -> DataFrame:
    """``rows`` with ``flagged``: whether ``column`` has its bit in the bitmap of ``keys``; it has for all that are among them."""
    bit_of = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    bits = keys.select((bit_of(key) / ROW).cast("int").alias("bitmap_row"), (bit_of(key) % ROW).alias("at"))
    bitmaps = bits.groupBy("bitmap_row").agg(F.bitmap_construct_agg("at").alias("bitmap"))
    at = bit_of(column) % ROW
    byte = F.conv(F.hex(F.substring("bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    joined = rows.join(F.broadcast(bitmaps), (bit_of(column) / ROW).cast("int") == F.col("bitmap_row"), "left")
    return joined.select(*rows.columns, F.coalesce(flag, F.lit(False)).alias("flagged"))


def maybe_in(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The flagged rows."""
    return flagged_in(rows, keys, column, column).where("flagged").drop("flagged")
