"""A smaller, consistent dataset around chosen users."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmatch.operators.interactions import distinct_items, sample_interactions, seeded_draw
from tagmatch.plans.bloom import bloom_filter, filter_bits, may_hold
from tagmatch.plans.selection import smallest
from tagmatch.plans.skew import Scale, semi_join, text_bytes
from tagmatch.sources import files
from tagmatch.sources.shared import stored

KEY_BYTES = 16

#: With fewer bits for a key, a Bloom filter lets about one in six other keys pass.
FEW_BITS = 4


class Subset(NamedTuple):
    interactions: DataFrame
    items: DataFrame
    item_tags: DataFrame


def active_users(users: DataFrame, min_reviews: int) -> DataFrame:
    return users.filter(F.col("user_id").isNotNull() & (F.col("reviews") >= min_reviews))


def pick_user(users: DataFrame, seed: int = 19) -> DataFrame:
    """One user by a seeded hash, the same one however the rows are laid out."""
    draw = F.struct(seeded_draw(["user_id"], seed).alias("draw"), "user_id")
    return (
        users.filter(F.col("user_id").isNotNull())
        .agg(F.min(draw).alias("least"))
        .filter(F.col("least").isNotNull())
        .select("least.user_id")
    )


def subset_users(
    users: DataFrame, min_reviews: int, max_users: int, target_user: int | None = None
) -> DataFrame:
    """(user_id) of at most ``max_users`` active users: the target, if active, and
    the others in id order. With a target, its place is kept even if it is not.

    The last id is found by counting, so that any number may be asked for: nothing is
    sorted, and the chosen rows stay in the tasks that read them. Ids are whole numbers.
    """
    active = stored(active_users(users, min_reviews).select("user_id").distinct(), "active")
    if target_user is None:
        return smallest(active, "user_id", max_users)
    target = active.filter(F.col("user_id") == F.lit(target_user))
    others = active.filter(F.col("user_id") != F.lit(target_user))
    return target.unionByName(smallest(others, "user_id", max_users - 1))


def subset_by_keys(rows: DataFrame, keys: DataFrame, key: str, scale: Scale = Scale()) -> DataFrame:
    """Rows whose key is among ``keys``, columns in their order.

    The distinct keys are stored and measured. Small ones are broadcast. Others make a Bloom
    filter of ``Scale.filter_bits`` at most, which leaves out most other rows before the two
    sides are shuffled; the join then leaves out what the filter let pass wrongly. The
    filter is skipped where so many keys would leave less than FEW_BITS for each.
    """
    wanted = stored(keys.select(key).filter(F.col(key).isNotNull()).distinct(), "keys")
    size = wanted.agg(text_bytes().alias("bytes"), F.count(F.lit(1)).alias("keys")).first()
    if max(size["bytes"], size["keys"] * KEY_BYTES) <= scale.broadcast_bytes:
        kept = rows.join(F.broadcast(wanted), key, "left_semi")
    else:
        kept = semi_join(_likely(rows, wanted, key, size["keys"], scale), wanted, key, scale)
    return kept.select(rows.columns)


def _likely(rows: DataFrame, wanted: DataFrame, key: str, number: int, scale: Scale) -> DataFrame:
    bits = filter_bits(number, scale.filter_bits)
    if bits < number * FEW_BITS:
        return rows
    return rows.filter(may_hold(F.col(key), bloom_filter(wanted, key, bits), bits))


def _of_keys(table: DataFrame, keys: DataFrame, key: str, scale: Scale) -> DataFrame:
    """Rows of a table with few rows per key, whose key is among distinct stored keys.
    The keys are broadcast if they are measured to be small."""
    if keys.count() * KEY_BYTES <= scale.broadcast_bytes:
        keys = F.broadcast(keys)
    return table.join(keys, key, "left_semi").select(table.columns)


def build_subset(
    interactions: DataFrame,
    items: DataFrame,
    item_tags: DataFrame,
    users: DataFrame,
    min_reviews: int,
    max_users: int,
    target_user: int | None = None,
    fraction: float = 0.35,
    seed: int = 19,
    sample_by: list[str] | None = None,
    scale: Scale = Scale(),
) -> Subset:
    """Liked rows, sampled, of chosen active users, and the items they touch.

    ``reviews`` counts all rows of a user and sampling comes after the choice, so
    a chosen user may be left without rows. A row is drawn by a hash of its columns, or
    of ``sample_by``; rows equal in them are drawn together. The rows are stored once,
    and items and tags are those of the stored rows.
    """
    liked = interactions.filter(F.col("is_recommended"))
    if fraction < 1.0:
        liked = sample_interactions(liked, fraction, seed, sample_by or liked.columns)
    chosen = stored(subset_users(users, min_reviews, max_users, target_user), "chosen")
    kept = stored(subset_by_keys(liked, chosen, "user_id", scale), "kept")
    app_ids = stored(distinct_items(kept), "app-ids")
    return Subset(
        kept,
        _of_keys(items, app_ids, "app_id", scale),
        _of_keys(item_tags, app_ids, "app_id", scale),
    )


def save_subset(subset: Subset, folder: str) -> Subset:
    """Write the three tables under ``folder`` and return them as read from there.
    Values come back as they were, line breaks, blanks and NULL included."""
    spark = subset.interactions.sparkSession
    read = []
    for name, format in (("interactions", "csv"), ("items", "csv"), ("item_tags", "json")):
        table, path = getattr(subset, name), f"{folder.rstrip('/')}/{name}"
        files.write_table(table, path, format)
        schema = ", ".join(f"`{column}` {kind}" for column, kind in table.dtypes)
        read.append(files.read_table(spark, path, schema, format, escaped=True))
    return Subset(*read)
