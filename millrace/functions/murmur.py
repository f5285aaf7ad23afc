"""The public 32-bit Murmur3 hash of buckets, with seed 0, in Spark's own functions.

Integers of any width, dates (days) and timestamps (microseconds) are hashed as 8 bytes; the lowest 31 bits of the
hash, modulo the number of buckets, are the bucket. Spark's ``hash`` is the same function with another seed. It starts
from what it made of the columns before, so behind a constant whose hash is 0 it hashes with seed 0. Texts keep Spark's own
hash, which treats their last one to three bytes in another way than the public one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The hash function's constants, and the seed of Spark's ``hash``.
C1, C2, ADDED, FINAL1, FINAL2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
SPARK_SEED = 42
MASK = 0xFFFFFFFF


def _constant_with_hash_0() -> int:
    """The 32-bit integer that Spark hashes to 0, by undoing the steps of the function."""
    inverse = lambda c: pow(c, -1, 1 << 32)
    back = lambda x, r: ((x >> r) | (x << (32 - r))) & MASK
    state = 4  # the length, which the last step takes off
    mixed = back((state - ADDED) * inverse(5) & MASK, 13) ^ SPARK_SEED
    value = back(mixed * inverse(C2) & MASK, 15) * inverse(C1) & MASK
    return value - (1 << 32) if value >> 31 else value


def murmur3(value: Column, data_type: T.DataType) -> Column:
    """The hash of a column as a 32-bit integer; null stays null."""
    if isinstance(data_type, T.DateType):
        number = F.unix_date(value).cast("long")
    elif isinstance(data_type, T.TimestampNTZType):
        # Days and the time within them, so the session's time zone plays no part.
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value)
        number = micros.cast("long")
    elif isinstance(data_type, (T.IntegerType, T.LongType)):
        number = value.cast("long")
    elif isinstance(data_type, T.StringType):
        return F.hash(value)
    else:
        raise ValueError(f"A {data_type.simpleString()} column has no buckets.")
    return F.when(number.isNotNull(), F.hash(F.lit(_constant_with_hash_0()), number))


def bucket(value: Column, data_type: T.DataType, buckets: int) -> Column:
    return F.pmod(murmur3(value, data_type).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(buckets))
