"""Tables of bits that tell which keys can be among given ones, of bounded size whatever the number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB


def bits_for(n: int) -> int:
    """A size for ``n`` keys: some 64 bits each, ``BITS`` at most."""
    return min(BITS, 1 << max(16, (64 * n).bit_length()))


def _bit(key: Column, size: int) -> Column:
    """Number of a key's bit, from 1 on as the bitmap functions count."""
    return F.pmod(F.xxhash64(key), F.lit(size)) + 1


def bit_table(keys: DataFrame, key: str, size: int = BITS) -> DataFrame:
    """(_bucket, _bits) of the keys."""
    bit = _bit(F.col(key), size)
    return (keys.groupBy(F.bitmap_bucket_number(bit).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")))


def with_may(rows: DataFrame, bits: DataFrame, key: str, size: int = BITS) -> DataFrame:
    """``rows`` with ``_may``: false only where the key is not among those of ``bits``."""
    columns = rows.columns
    bit = _bit(F.col(key), size)
    placed = rows.withColumn("_place", F.bitmap_bit_position(bit))
    looked = placed.join(F.broadcast(bits), F.bitmap_bucket_number(bit) == F.col("_bucket"), "left")
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_place DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    may = F.coalesce(F.getbit(byte, F.expr("CAST(_place % 8 AS INT)")) == 1, F.lit(False))
    return looked.select(*columns, may.alias("_may"))
