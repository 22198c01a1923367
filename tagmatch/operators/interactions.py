"""Filters, samples and groupings over interaction rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmatch.plans.skew import Scale


def positive_interactions(interactions: DataFrame) -> DataFrame:
    """(user_id, app_id) of each liked row. Repeated rows stay repeated; rows with
    a false or NULL flag or a NULL key are dropped."""
    return interactions.filter(
        F.col("is_recommended") & F.col("user_id").isNotNull() & F.col("app_id").isNotNull()
    ).select("user_id", "app_id")


def sample_interactions(
    interactions: DataFrame, fraction: float = 0.35, seed: int = 19, by: list[str] | None = None
) -> DataFrame:
    """Bernoulli sample without replacement.

    Without ``by`` the drawn rows depend on how the input is partitioned. With
    ``by`` a row is kept by a hash of those columns, so that the same rows are
    drawn from any layout of the data; give columns that identify a row.
    """
    if by is None:
        return interactions.sample(False, fraction, seed)
    if fraction >= 1.0:
        return interactions
    limit = f"{int(fraction * 16**8):08x}"
    return interactions.filter(seeded_draw(by, seed) < F.lit(limit))


def seeded_draw(by: list[str], seed: int) -> Column:
    """An evenly spread hexadecimal number, the same for the same values and seed."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in by], F.lit(str(seed))))


def user_item_lists(liked: DataFrame, scale: Scale = Scale()) -> DataFrame:
    """Items of each user in id order, in pages of ``scale.page_ids`` ids.

    A page holds each item once, and ``copies`` tells how often it occurs, so an
    array never outgrows its page however many rows a user has.
    """
    counted = liked.groupBy("user_id", "app_id").agg(F.count(F.lit(1)).alias("copies"))
    page = F.floor(F.col("app_id") / F.lit(scale.page_ids)).cast("bigint")
    held = F.sort_array(F.collect_list(F.struct("app_id", "copies")))
    return (
        counted.groupBy("user_id", page.alias("page"))
        .agg(held.alias("held"))
        .select(
            "user_id",
            "page",
            F.col("held.app_id").alias("app_ids"),
            F.col("held.copies").alias("copies"),
        )
    )


def distinct_items(interactions: DataFrame) -> DataFrame:
    return interactions.select("app_id").filter(F.col("app_id").isNotNull()).distinct()
