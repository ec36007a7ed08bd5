"""Inner indexes in use, as bitmaps that tell which cells have a partner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.plans.limits import BROADCAST_LIMIT_BYTES

# Values of an index in one of Spark's bitmaps, and its bytes.
POSITIONS, BYTES = 32_768, 4_096


def bitmaps(cells: DataFrame, index: str) -> DataFrame:
    """Rows ``(bucket, bits)``: for each 32,768 values of an index, which of them are in use. Each
    task sends 4 KB for a bucket it has met, however many cells it holds."""
    place = F.col(index)
    return cells.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def fits(extent: int) -> bool:
    """Whether the bitmaps of an index below ``extent`` may be broadcast: a bit for each value."""
    return (extent // POSITIONS + 1) * BYTES <= BROADCAST_LIMIT_BYTES


def with_partner(cells: DataFrame, index: str, used: DataFrame) -> DataFrame:
    """The cells whose index is set in the bitmaps ``used``, which are broadcast: the caller has
    seen that they fit. Nothing is shuffled, so cells without a partner go where they are read.
    """
    place = F.bitmap_bit_position(F.col(index))
    columns = cells.columns
    met = cells.withColumns({
        "__bucket": F.bitmap_bucket_number(F.col(index)), "__byte": F.expr(f"cast({_position(index)} div 8 as int)"),
        "__bit": (place % 8).cast("int"),
    }).join(F.broadcast(used.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))), "__bucket")
    byte = F.conv(F.hex(F.substring("__bits", F.col("__byte") + 1, F.lit(1))), 16, 10).cast("bigint")
    return met.where(F.getbit(byte, F.col("__bit")) == 1).select(*columns)


def _position(index: str) -> str:
    return f"bitmap_bit_position(`{index}`)"
