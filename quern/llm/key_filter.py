"""A filter of fixed size for rows whose key may occur in another table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 27


def maybe_in(rows: DataFrame, keys: DataFrame, on: list[str], column: str) -> DataFrame:
    """Add whether a row's key may occur among ``keys``: never False if it does.

    A bitmap of FILTER_BITS hash positions is built from the keys and broadcast; it
    has 16 MB whatever their number.  Bits that clash only let more rows through.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bitmap = keys.groupBy(bucket.alias("__bucket")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
    power = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))
    found = byte.cast("int").bitwiseAND(power) > 0
    return (
        rows.join(F.broadcast(bitmap), bucket == F.col("__bucket"), "left")
        .withColumn(column, F.coalesce(found, F.lit(False)))
        .drop("__bucket", "__bits")
    )
