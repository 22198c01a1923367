"""Tag-based user similarity and recommendation on Spark DataFrames."""

from tagmatch.operators.catalog import hash_catalog, item_catalog
from tagmatch.operators.hashing import IdfModel, hashed_vectors
from tagmatch.operators.interactions import positive_interactions
from tagmatch.operators.neighbours import nearest_users
from tagmatch.operators.profiles import Profiles
from tagmatch.operators.recommend import recommend_items, recommend_many
from tagmatch.operators.similarity import cosine_similarity, most_similar
from tagmatch.operators.store import open_profiles, store_profiles, stored_similarity
from tagmatch.plans.recommendation import (
    recommend,
    recommend_hashed,
    recommend_tagged,
    recommend_titled,
)
from tagmatch.plans.skew import Scale
from tagmatch.sources.schemas import Columns

__all__ = [
    "Columns",
    "IdfModel",
    "Profiles",
    "Scale",
    "cosine_similarity",
    "hash_catalog",
    "hashed_vectors",
    "item_catalog",
    "most_similar",
    "nearest_users",
    "open_profiles",
    "positive_interactions",
    "recommend",
    "recommend_hashed",
    "recommend_items",
    "recommend_many",
    "recommend_tagged",
    "recommend_titled",
    "store_profiles",
    "stored_similarity",
]
