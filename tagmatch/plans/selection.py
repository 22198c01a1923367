"""The n smallest keys of a large table without sorting it.

Each round counts the keys in some equal parts of the range in which the nth one lies, and
goes on with the part that holds it. A round is one aggregation with at most PARTS counts
as its result, and a 64-bit range is down to one value after seven rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that a range is divided into per round.
PARTS = 1024

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def nth_smallest(keys: DataFrame, key: str, n: int) -> int | None:
    """The nth smallest value of a whole-number column without NULL, counted with
    repetitions; None if there are fewer than n."""
    if dict(keys.dtypes)[key] not in _WHOLE:
        raise TypeError(f"{key} must be of one of the types {_WHOLE}")
    if n < 1:
        raise ValueError(f"n must be 1 at least, not {n}")
    # Decimals hold differences of any two longs.
    values = keys.select(F.col(key).cast("decimal(20,0)").alias("key"))
    ends = values.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("key").alias("rows")).first()
    if ends["rows"] < n:
        return None
    low, high = int(ends["low"]), int(ends["high"])
    while low < high:
        width = -(-(high - low + 1) // PARTS)
        part = F.expr(f"CAST((key - {low}BD) DIV {width}BD AS INT)")
        inside = values.filter(f"key BETWEEN {low}BD AND {high}BD")
        counts = sorted(inside.groupBy(part.alias("part")).count().collect())
        for row in counts:
            if n <= row["count"]:
                break
            n -= row["count"]
        low = low + row["part"] * width
        high = min(high, low + width - 1)
    return low


def smallest(keys: DataFrame, key: str, n: int) -> DataFrame:
    """Rows with the n smallest values of a column of distinct whole numbers: a filter, so
    rows stay where they are. The keys are read some seven times; store them before."""
    if n < 1:
        return keys.filter(F.lit(False))
    last = nth_smallest(keys, key, n)
    return keys if last is None else keys.filter(F.col(key) <= F.lit(last))
