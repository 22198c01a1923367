"""The item side: one title and one list of tag words per item."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmatch.functions.tags import has_tags, normalize_tags, tag_words

SCOPES = ("titled", "tagged")

# Fixed value: size of the hashed feature space.
NUM_FEATURES = 20_000


def tagged_items(item_tags: DataFrame) -> DataFrame:
    """(app_id, tags) of items that have at least one tag."""
    return item_tags.filter(F.col("app_id").isNotNull() & has_tags(F.col("tags"))).select(
        "app_id", "tags"
    )


def normalized_items(item_tags: DataFrame) -> DataFrame:
    return tagged_items(item_tags).select(
        "app_id", normalize_tags(F.col("tags")).alias("tags")
    )


def item_title_lookup(items: DataFrame) -> DataFrame:
    """One title per item; of several, the greatest."""
    return (
        items.filter(F.col("app_id").isNotNull())
        .groupBy("app_id")
        .agg(F.max("title").alias("title"))
    )


def item_tag_lookup(item_tags: DataFrame) -> DataFrame:
    """One tag list per item; of several, the greatest."""
    return (
        item_tags.filter(F.col("app_id").isNotNull())
        .groupBy("app_id")
        .agg(F.max("tags").alias("tags"))
    )


def item_catalog(items: DataFrame, item_tags: DataFrame, scope: str = "titled") -> DataFrame:
    """(app_id, title, has_title, words), one row per item that counts.

    Scope "titled" needs an item to have a title row and tags. Scope "tagged"
    needs tags only; ``has_title`` then tells which items can be recommended.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    titles = item_title_lookup(items).withColumn("has_title", F.lit(True))
    words = item_tag_lookup(tagged_items(item_tags)).select(
        "app_id", tag_words(F.col("tags")).alias("words")
    )
    joined = words.join(titles, "app_id", "inner" if scope == "titled" else "left")
    return joined.select(
        "app_id", "title", F.coalesce("has_title", F.lit(False)).alias("has_title"), "words"
    )


def hash_catalog(catalog: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """The catalog with each word replaced by its bucket in the hashed feature space.

    Hashed counts add up over items, so hashing the catalog once gives the same
    user vectors as hashing every user's bag of words.
    """
    hashing = HashingTF(inputCol="words", outputCol="features", numFeatures=num_features)
    vector = F.unwrap_udt("features")
    buckets = F.flatten(
        F.zip_with(
            vector["indices"],
            vector["values"],
            lambda bucket, count: F.array_repeat(bucket, count.cast("int")),
        )
    )
    return hashing.transform(catalog).select(
        "app_id", "title", "has_title", buckets.alias("words")
    )
