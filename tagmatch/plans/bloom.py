"""Bloom filters as a column expression, to leave out rows before a shuffle.

A filter is an array of longs, made by an aggregation and given to the rows by a scalar
subquery. Its size is a parameter, whatever the number of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key for about one false positive in a hundred, with HASHES hashes.
BITS_PER_KEY, HASHES = 10, 4
WORD = 64


def filter_bits(keys: int, max_bits: int) -> int:
    """Bits of a filter for so many keys: a multiple of 64, and no more than ``max_bits``."""
    return min(max(-(-keys * BITS_PER_KEY // WORD), 1), max(max_bits // WORD, 1)) * WORD


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in range(HASHES)]


def bloom_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row: (bits), an array of bits / 64 longs in which the places of each key are set.

    Bits are put together per long before they are exchanged. The one task that makes the
    array reads one row per long, of which there are bits / 64 at most.
    """
    if bits % WORD:
        raise ValueError(f"bits must be a multiple of {WORD}, not {bits}")
    place = keys.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    one = F.lit(1).cast("bigint")
    mask = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    words = place.select(F.expr("CAST(place DIV 64 AS INT)").alias("word"), mask.alias("mask"))
    every = keys.sparkSession.range(bits // WORD).select(
        F.col("id").cast("int").alias("word"), (one - one).alias("mask")
    )
    filled = words.unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    held = F.array_sort(F.collect_list(F.struct("word", "mask")))
    return filled.agg(held["mask"].alias("bits"))


def may_hold(key: Column, bloom: DataFrame, bits: int) -> Column:
    """Whether the filter may hold a key: always true for its keys, and for NULL never."""
    array = bloom.scalar()

    def is_set(place: Column) -> Column:
        word = F.get(array, F.floor(place / WORD).cast("int"))
        return F.getbit(word, (place % WORD).cast("int")) == 1

    found = is_set(_places(key, bits)[0])
    for place in _places(key, bits)[1:]:
        found = found & is_set(place)
    return key.isNotNull() & found
