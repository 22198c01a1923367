"""How big tables meet: checked broadcasts, and splitting of hot keys.

Every join of the package goes one of two ways. A table whose measured size is
under ``Scale.broadcast_bytes`` is broadcast. Any other table is joined on its
key plus a salt, where only hot keys get more than one salt. A key is hot when it
alone holds more than ``Scale.hot_share`` of all rows, or more than
``Scale.partition_share`` of the rows of an average shuffle partition. So there are
never more than the greater of ``1 / hot_share`` and ``partitions / partition_share``
hot keys, and that list may always be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmatch.sources.shared import shuffles_deleted


@dataclass(frozen=True)
class Scale:
    """Size rules for joins and groupings.

    broadcast_bytes: largest measured table that is broadcast; 0 turns it off.
    hot_share, partition_share, hot_rows: a key is hot when its rows exceed the number
        and, besides, either this share of all rows or this share of an average
        shuffle partition. The shares bound how many keys can be hot, the row count
        keeps small inputs from being split for nothing.
    salts: pieces a hot key is split into.
    page_ids: item ids per page of a user's item list.
    word_pages: pages of a user's tag profile, whatever the data.
    filter_bits: bits of a Bloom filter at most, which goes to every task.
    """

    broadcast_bytes: int = 32 * 1024 * 1024
    hot_share: float = 1e-4
    partition_share: float = 0.5
    hot_rows: int = 1_000_000
    salts: int = 64
    page_ids: int = 1_000_000
    word_pages: int = 4
    filter_bits: int = 64 * 1024 * 1024

    def hot_limit(self, all_rows: int, partitions: int) -> float:
        """Rows above which a key is hot."""
        share = min(self.hot_share, self.partition_share / max(partitions, 1))
        return max(self.hot_rows, share * all_rows)


def text_bytes() -> Column:
    """Aggregate: size of all rows written as text."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))


def hot_keys(rows: DataFrame, key: str, scale: Scale, times: str | None = None) -> DataFrame | None:
    """Keys that hold more than their share of the rows, None if there are none. A row
    counts as often as its column ``times`` says, if one is named.

    Runs one job that returns two numbers. Only if some key is hot, a second one
    lists the hot keys on the driver, which is safe because their number is bounded.
    Plans without hot keys thus stay as simple as without the rule.
    """
    number = F.sum(times) if times else F.count(F.lit(1))
    per_key = rows.groupBy(key).agg(number.alias("key_rows"))
    with shuffles_deleted(rows.sparkSession):
        seen = per_key.agg(F.sum("key_rows").alias("all"), F.max("key_rows").alias("most")).first()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = scale.hot_limit(seen["all"] or 0, partitions)
    if (seen["most"] or 0) <= limit:
        return None
    found = per_key.filter(F.col("key_rows") > limit).select(key).collect()
    return rows.sparkSession.createDataFrame(found, rows.select(key).schema)


def join_salted(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    hot: DataFrame | None,
    spread_on: list[str],
    scale: Scale,
) -> DataFrame:
    """Inner join of many rows with a table too large to broadcast.

    Rows of a hot key are spread over ``scale.salts`` pieces by a hash of the
    ``spread_on`` columns, which a repeated task computes the same way again. The
    table's row of a hot key is repeated once per piece, any other stays single.
    """
    if hot is None:
        return rows.join(table, key)
    hot = F.broadcast(hot.select(key).withColumn("is_hot", F.lit(True)))
    piece = F.pmod(F.xxhash64(*spread_on), F.lit(scale.salts)).cast("int")
    pieces = F.sequence(F.lit(0), F.lit(scale.salts - 1))
    salted_rows = rows.join(hot, key, "left").withColumn(
        "salt", F.when(F.col("is_hot"), piece).otherwise(F.lit(0))
    )
    salted_table = table.join(hot, key, "left").withColumn(
        "salt", F.explode(F.when(F.col("is_hot"), pieces).otherwise(F.array(F.lit(0))))
    )
    return (
        salted_rows.drop("is_hot")
        .join(salted_table.drop("is_hot"), [key, "salt"])
        .drop("salt")
    )


def semi_join(rows: DataFrame, keys: DataFrame, key: str, scale: Scale) -> DataFrame:
    """Rows whose key is in ``keys``, where both sides may be of any size."""
    wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    hot = hot_keys(rows, key, scale)
    if hot is None:
        return rows.join(wanted, key, "left_semi")
    ordinary = rows.join(F.broadcast(hot), key, "left_anti").join(wanted, key, "left_semi")
    hot_wanted = wanted.join(F.broadcast(hot), key, "left_semi")
    return ordinary.unionByName(rows.join(F.broadcast(hot_wanted), key, "left_semi"))
