"""End-to-end recommendation for one target user."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagmatch.operators.catalog import hash_catalog, item_catalog
from tagmatch.operators.interactions import positive_interactions
from tagmatch.operators.profiles import Profiles
from tagmatch.operators.recommend import recommend_items
from tagmatch.operators.similarity import cosine_similarity, most_similar
from tagmatch.plans.skew import Scale
from tagmatch.sources.schemas import Columns


def recommend(
    interactions: DataFrame,
    items: DataFrame,
    item_tags: DataFrame,
    target_user: int,
    k: int = 3,
    scope: str = "titled",
    terms: str = "exact",
    idf: str = "plain",
    zero: str = "keep",
    users: str = "list",
    scale: Scale = Scale(),
    columns: Columns = Columns(),
) -> DataFrame:
    """(app_id, title, similar_user_ids): items liked by the k users most similar
    to the target and not yet held by it.

    scope: "titled" or "tagged", which items count (``item_catalog``).
    terms: "exact" words or "hashed" buckets.
    idf: "plain" or "smoothed".
    zero: "keep" or "drop" users of similarity 0.
    users: "list", "set" or "counts", how neighbours are named.
    columns: names of the columns of the three tables, and of the result.
    """
    interactions, items, item_tags = (columns.standard(t) for t in (interactions, items, item_tags))
    catalog = item_catalog(items, item_tags, scope)
    if terms == "hashed":
        catalog = hash_catalog(catalog)
    elif terms != "exact":
        raise ValueError(f"terms must be 'exact' or 'hashed', not {terms!r}")
    profiles = Profiles(positive_interactions(interactions), catalog, scale)
    similarities = cosine_similarity(profiles, target_user, idf, zero)
    found = recommend_items(profiles, most_similar(similarities, k), target_user, users)
    return columns.restored(found)


def recommend_titled(interactions, items, item_tags, target_user: int, **options) -> DataFrame:
    """Exact words; items need a title and tags."""
    return recommend(interactions, items, item_tags, target_user, **options)


def recommend_hashed(interactions, items, item_tags, target_user: int, **options) -> DataFrame:
    """Hashed words with smoothed idf; items need a title and tags."""
    options = {"terms": "hashed", "idf": "smoothed", **options}
    return recommend(interactions, items, item_tags, target_user, **options)


def recommend_tagged(interactions, items, item_tags, target_user: int, **options) -> DataFrame:
    """Exact words; items need tags only to count, and a title to be recommended.
    Users of similarity 0 are no neighbours, and each is named once per item."""
    options = {"scope": "tagged", "zero": "drop", "users": "set", **options}
    return recommend(interactions, items, item_tags, target_user, **options)
