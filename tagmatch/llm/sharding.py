"""Sharding by histogram sort.

Documents are ordered by a hash of their text, then of their id. Splitters between
shards are found by counting, over all partitions, the exact bytes below candidate
key boundaries; the interval that holds a splitter is cut finer each round, until a
boundary meets the tolerance. Then all rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.sources.shared import stored

SHARDS = 8
#: A shard's end may miss its share by this part of a shard's bytes.
TOLERANCE = 1e-4
#: Candidate boundaries in each interval and round: 2 to this power.
PROBE_BITS = 10

_KEY_BITS = 63
#: Low bits of the key that tell equal texts apart; above them is the text's hash.
_ID_BITS = 23


@dataclass
class Splitter:
    """Rows with (key, seq) below it belong to earlier shards; below is their bytes."""

    key: int = 0
    seq: int = 0
    below: int = 0


@dataclass
class _Interval:
    low: int
    bits: int
    below: int


def _sizes(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with their size, checksum and key. ``seq`` tells apart rows that even
    share the key; it is stored with them and so never drawn anew."""
    text = F.coalesce(F.col("text"), F.lit(""))
    text_part = F.shiftrightunsigned(F.xxhash64(text), 64 - (_KEY_BITS - _ID_BITS))
    id_part = F.shiftrightunsigned(F.xxhash64(F.col("doc_id")), 64 - _ID_BITS)
    rows = docs.select(
        *dict.fromkeys(["doc_id", *columns]),
        (F.octet_length(text) + 1).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        F.shiftleft(text_part, _ID_BITS).bitwiseOR(id_part).alias("_key"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    return stored(rows, "sized")


def _probe(rows: DataFrame, column: str, intervals: list[_Interval], bits: int) -> dict[tuple[int, int], int]:
    """Exact bytes in each cell of each interval. Intervals are equal or apart."""
    cells = {(i.low, i.bits) for i in intervals}
    value, place, cell = F.col(column), F.lit(None).cast("long"), F.lit(None).cast("long")
    for low, width in cells:
        inside = (value >= low) & (value - low < (1 << width) if width < _KEY_BITS else F.lit(True))
        place = F.when(inside, F.lit(low)).otherwise(place)
        cell = F.when(inside, F.shiftrightunsigned(value - low, max(width - bits, 0)).cast("long")).otherwise(cell)
    counted = (
        rows.select(place.alias("low"), cell.alias("cell"), "_size")
        .filter("low IS NOT NULL")
        .groupBy("low", "cell")
        .agg(F.sum("_size").alias("bytes"))
    )
    return {(r["low"], r["cell"]): r["bytes"] for r in counted.collect()}


def _refine(rows: DataFrame, column: str, goals: list[int], start: _Interval, tolerance: float) -> list[_Interval]:
    """For each goal, the boundary with bytes below it nearest to the goal (an interval of
    bits -1), or the single value (bits 0) that straddles it beyond the tolerance."""
    found = [start] * len(goals)
    while True:
        due = [i for i in found if i.bits > 0]
        if not due:
            return found
        bits = min(PROBE_BITS, max(i.bits for i in due))
        counts = _probe(rows, column, due, bits)
        for n, (interval, goal) in enumerate(zip(found, goals)):
            if interval.bits <= 0:
                continue
            step = max(interval.bits - bits, 0)
            own = sorted((cell, size) for (low, cell), size in counts.items() if low == interval.low)
            below, nearest = interval.below, _Interval(interval.low, -1, interval.below)
            inner = nearest
            for cell, size in own:
                low = interval.low + (cell << step)
                inner = _Interval(low, step, below)
                for edge in (_Interval(low, -1, below), _Interval(low + (1 << step), -1, below + size)):
                    if abs(edge.below - goal) < abs(nearest.below - goal):
                        nearest = edge
                below += size
                if below >= goal:
                    break
            found[n] = nearest if abs(nearest.below - goal) <= tolerance else inner


def find_splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Splitter]:
    """The shards - 1 boundaries between shards of nearly equal bytes.

    A boundary cuts through equal texts only where their group misses the tolerance,
    and is at last the border of the row nearest to the goal."""
    total, last = rows.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.max("_seq")).first()
    goals = [total * n // shards for n in range(1, shards)]
    slack = total / shards * tolerance
    splitters = []
    keys = _refine(rows, "_key", goals, _Interval(0, _KEY_BITS, 0), slack)
    seq_bits = max(1, (last or 0).bit_length())
    for interval, goal in zip(keys, goals):
        if interval.bits < 0:
            splitters.append(Splitter(interval.low, 0, interval.below))
            continue
        # Rows of one key straddle the goal: cut between them, by seq.
        own = rows.filter(F.col("_key") == interval.low)
        (place,) = _refine(own, "_seq", [goal], _Interval(0, seq_bits, interval.below), slack)
        if place.bits < 0:
            splitters.append(Splitter(interval.low, place.low, place.below))
            continue
        size = own.filter(F.col("_seq") == place.low).agg(F.sum("_size")).first()[0]
        after = abs(place.below + size - goal) < abs(place.below - goal)
        splitters.append(Splitter(interval.low, place.low + after, place.below + after * size))
    return splitters


def _shard_of(splitters: list[Splitter]) -> Column:
    key, seq, shard = F.col("_key"), F.col("_seq"), F.lit(0)
    for n, s in enumerate(splitters, start=1):
        shard = F.when((key > s.key) | ((key == s.key) & (seq >= s.seq)), F.lit(n)).otherwise(shard)
    return shard


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, columns: list[str] = []) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text),
    and the given further columns.

    Size is the text's UTF-8 bytes plus one; a null text counts as empty. Shards hold
    nearly equal bytes, and equal texts stay together where that allows it. Slots number
    a shard's rows from 0 without gaps in key order. Repeated rows have slots of their
    own. An empty table gives no rows. A further column named like a result column is
    left out.
    """
    results = ("doc_id", "size", "text_crc32", "shard", "slot")
    columns = [c for c in columns if c not in results]
    rows = _sizes(docs, columns)
    splitters = find_splitters(rows, shards, tolerance)
    order = ["_shard", "_key", "_seq"]
    dealt = rows.withColumn("_shard", _shard_of(splitters)).repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    dealt = stored(
        dealt.withColumns({"_part": F.spark_partition_id(), "_row": row.bitwiseAND((1 << 33) - 1)}), "dealt"
    )
    parts = dealt.groupBy("_shard", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, and one more for each shard's border.
    offsets = parts.select("_shard", "_part", "_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    numbered = dealt.join(F.broadcast(offsets), ["_shard", "_part"])
    return numbered.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("_before") + F.col("_row") - F.col("_first")).alias("slot"),
        *columns,
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, tolerance: float = TOLERANCE) -> None:
    """Write whole documents into one folder per shard, in slot order within files."""
    shard(docs, shards, tolerance, docs.columns).write.partitionBy("shard").parquet(path)
