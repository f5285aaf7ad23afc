"""The public bucket hash: known values, and a plain implementation on many others."""

from __future__ import annotations

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.murmur import bucket, murmur3

EPOCH = datetime.datetime(1970, 1, 1)


def of_long(n: int) -> int:
    """The two blocks of an 8-byte integer, step by step."""
    m32, h = 0xFFFFFFFF, 0
    turn = lambda x, r: ((x << r) | (x >> (32 - r))) & m32
    for k in (n & m32, (n >> 32) & m32):
        h ^= turn(k * 0xCC9E2D51 & m32, 15) * 0x1B873593 & m32
        h = (turn(h, 13) * 5 + 0xE6546B64) & m32
    h ^= 8
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> shift)) * factor & m32
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_known_values(spark):
    """Examples of the public specification for the integer 34, a day and a time of it."""
    day, time = datetime.date(2017, 11, 16), datetime.datetime(2017, 11, 16, 22, 31, 8)
    schema = T.StructType().add("i", T.IntegerType()).add("l", T.LongType()).add("d", T.DateType()).add("t", T.TimestampNTZType())
    df = spark.createDataFrame([(34, 34, day, time), (None, None, None, None)], schema)
    got = df.select(*[murmur3(F.col(f.name), f.dataType).alias(f.name) for f in schema]).collect()
    assert tuple(got[0]) == (2017239379, 2017239379, -653330422, -2047944441)
    assert tuple(got[1]) == (None,) * 4


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.integers(-(2**40), 2**45)), min_size=20, max_size=60))
def test_against_plain(spark, rows):
    data = [(n, EPOCH + datetime.timedelta(microseconds=t)) for n, t in rows]
    schema = T.StructType().add("n", T.LongType()).add("t", T.TimestampNTZType())
    hashed = [murmur3(F.col(f.name), f.dataType).alias(f.name) for f in schema]
    buckets = [bucket(F.col(f.name), f.dataType, 13).alias(f"{f.name}_bucket") for f in schema]
    for row, (n, t) in zip(spark.createDataFrame(data, schema).select(*hashed, *buckets).collect(), rows):
        expected = (of_long(n), of_long(t))
        assert tuple(row) == (*expected, *((h & 0x7FFFFFFF) % 13 for h in expected))
