"""One query per operator over the test tables.

Each takes (spark, sf_dir) and returns a DataFrame whose keys are bigint, doubles
rounded to six places and arrays joined to strings, so that results of different
engines can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmatch.operators import catalog as cat
from tagmatch.operators import hashing
from tagmatch.operators import interactions as inter
from tagmatch.operators import neighbours as near
from tagmatch.operators import profiles as prof
from tagmatch.operators import recommend as rec
from tagmatch.operators import similarity as sim
from tagmatch.operators import store
from tagmatch.operators import subset as sub
from tagmatch.operators import weights as wgt
from tagmatch.plans.recommendation import recommend_hashed, recommend_tagged, recommend_titled
from tagmatch.sources import files, testdata
from tagmatch.sources.shared import shared_folder

TARGET_USER = 0
TARGET_VECTOR = 0
NEAREST_VECTORS = 10
MIN_REVIEWS = 40
MAX_USERS = 25
WIDE_KEY = 3_000_000_000
FEW_FEATURES = 64
TARGETS_BY = 50

Query = Callable[[SparkSession, str], DataFrame]


def _key(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def _real(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def _joined(name: str, separator: str = ",") -> Column:
    return F.array_join(F.col(name).cast("array<string>"), separator).alias(name)


def _catalog(spark: SparkSession, sf_dir: str, scope: str = "titled") -> DataFrame:
    return cat.item_catalog(
        testdata.items(spark, sf_dir), testdata.item_tags(spark, sf_dir), scope
    )


def _liked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inter.positive_interactions(testdata.interactions(spark, sf_dir))


def _profiles(spark: SparkSession, sf_dir: str, scope: str = "titled") -> prof.Profiles:
    return prof.Profiles(_liked(spark, sf_dir), _catalog(spark, sf_dir, scope))


def _hashed_profiles(
    spark: SparkSession, sf_dir: str, num_features: int = cat.NUM_FEATURES
) -> prof.Profiles:
    catalog = cat.hash_catalog(_catalog(spark, sf_dir), num_features)
    return prof.Profiles(_liked(spark, sf_dir), catalog)


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.active_users(testdata.users(spark, sf_dir), MIN_REVIEWS).select("user_id")


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        testdata.interactions(spark, sf_dir),
        testdata.items(spark, sf_dir),
        testdata.item_tags(spark, sf_dir),
    )


# Sources and sinks


def _interaction_columns(df: DataFrame) -> DataFrame:
    return df.select(
        _key("app_id"), _key("helpful"), _key("funny"), "date", _key("is_recommended"),
        _real("hours"), _key("user_id"), _key("review_id"),
    )


def _wide(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that don't fit in 32 bits."""
    return df.withColumns({key: F.col(key) + WIDE_KEY for key in keys})


def scan_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "interactions")
    rows = _wide(testdata.interactions(spark, sf_dir), "app_id", "user_id", "review_id")
    files.write_table(rows, path)
    return _interaction_columns(files.read_interactions(spark, path, escaped=True))


def scan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "items")
    odd = F.col("positive_ratio") % 9
    title = (
        F.when(odd == 0, F.concat("title", F.lit("\nsecond line\r")))
        .when(odd == 1, F.concat(F.lit('"'), "title", F.lit('", "')))
        .when(odd == 2, F.concat("title", F.lit("\\n\\")))
        .when(odd == 3, F.concat(F.lit("  "), "title", F.lit("\t ")))
        .when(odd == 4, F.lit(""))
        .when(odd == 5, F.lit(None).cast("string"))
        .when(odd == 6, F.concat(F.lit("\0"), "title", F.lit("\\0%00\0\\\0")))
        .when(odd == 7, F.concat("title", F.lit("%0A%25\\N%")))
        .otherwise(F.col("title"))
    )
    rows = _wide(testdata.items(spark, sf_dir), "app_id").withColumn("title", title)
    files.write_table(rows, path)
    return files.read_items(spark, path, escaped=True).select(
        _key("app_id"), "title", "date_release", _key("win"), _key("mac"), _key("linux"),
        "rating", _key("positive_ratio"), _key("user_reviews"), _real("price_final"),
        _real("price_original"), _real("discount"), _key("steam_deck"),
    )


def scan_item_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "item_tags")
    files.write_table(_wide(testdata.item_tags(spark, sf_dir), "app_id"), path, "json")
    return files.read_item_tags(spark, path).select(
        _key("app_id"), "description", _joined("tags", "|")
    )


def scan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "users")
    files.write_table(_wide(testdata.users(spark, sf_dir), "user_id"), path)
    return files.read_users(spark, path, escaped=True).select(
        _key("user_id"), _key("products"), _key("reviews")
    )


def _subset(spark: SparkSession, sf_dir: str) -> sub.Subset:
    return sub.build_subset(
        *_inputs(spark, sf_dir),
        testdata.users(spark, sf_dir),
        min_reviews=MIN_REVIEWS,
        max_users=MAX_USERS,
        target_user=TARGET_USER,
    )


def _saved(spark: SparkSession, sf_dir: str) -> sub.Subset:
    return sub.save_subset(_subset(spark, sf_dir), shared_folder(spark, "subset"))


def subset_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interaction_columns(_saved(spark, sf_dir).interactions)


def subset_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir).item_tags.select(_key("app_id"), _joined("tags", "|"))


def recommendation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = recommend_tagged(*_inputs(spark, sf_dir), TARGET_USER)
    return rec.recommendation_lines(sets, "set")


def recommendation_lines_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = recommend_titled(*_inputs(spark, sf_dir), TARGET_USER)
    return rec.recommendation_lines(lists, "list")


# Interactions and items


def positive_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _liked(spark, sf_dir).select(_key("user_id"), _key("app_id"))


def sample_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    liked = testdata.interactions(spark, sf_dir).filter("is_recommended")
    sampled = inter.sample_interactions(liked, by=["review_id", "app_id", "user_id"])
    return sampled.select(_key("user_id"), _key("app_id"), _key("review_id"))


def user_item_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inter.user_item_lists(_liked(spark, sf_dir)).select(
        _key("user_id"), _key("page"), _joined("app_ids"), _joined("copies")
    )


def distinct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inter.distinct_items(_liked(spark, sf_dir)).select(_key("app_id"))


def tagged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.tagged_items(testdata.item_tags(spark, sf_dir)).select(
        _key("app_id"), _joined("tags", "|")
    )


def normalize_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.normalized_items(testdata.item_tags(spark, sf_dir)).select(
        _key("app_id"), _joined("tags", "|")
    )


def item_title_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.item_title_lookup(testdata.items(spark, sf_dir)).select(_key("app_id"), "title")


def item_tag_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.item_tag_lookup(testdata.item_tags(spark, sf_dir)).select(
        _key("app_id"), _joined("tags", "|")
    )


# Profiles and weights


def user_item_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_item_details(_profiles(spark, sf_dir)).select(
        _key("user_id"), _key("app_id"), "title", _joined("words", "|")
    )


def tagged_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.tagged_interactions(_profiles(spark, sf_dir, "tagged")).select(
        _key("user_id"), _key("app_id"), _joined("words", "|")
    )


def user_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_terms(_profiles(spark, sf_dir)).select(_key("user_id"), "word")


def user_tag_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_tag_profile(_profiles(spark, sf_dir)).select(
        _key("user_id"), _key("page"), _joined("tag_words", "|"), _joined("word_counts")
    )


def user_term_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_term_totals(_profiles(spark, sf_dir)).select(
        _key("user_id"), _key("total_word_count")
    )


def user_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_term_counts(_profiles(spark, sf_dir)).select(
        _key("user_id"), "word", _key("word_count")
    )


def user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_count(_profiles(spark, sf_dir)).select(_key("user_count"))


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wgt.term_frequency(_profiles(spark, sf_dir)).select(
        _key("user_id"), "word", _key("word_count"), _key("total_word_count"), _real("tf")
    )


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wgt.document_frequency(_profiles(spark, sf_dir)).select("word", _key("user_count"))


def idf_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wgt.inverse_document_frequency(_profiles(spark, sf_dir), "plain").select(
        "word", _key("user_count"), _real("idf")
    )


def idf_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wgt.inverse_document_frequency(_profiles(spark, sf_dir), "smoothed").select(
        "word", _key("user_count"), _real("idf")
    )


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wgt.tfidf(_profiles(spark, sf_dir)).select(_key("user_id"), "word", _real("tfidf"))


def target_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wgt.target_profile(_profiles(spark, sf_dir), TARGET_USER).select("word", _real("tfidf"))


def hashed_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_term_counts(_hashed_profiles(spark, sf_dir)).select(
        _key("user_id"), F.col("word").cast("bigint").alias("bucket"), _key("word_count")
    )


def hashed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few features, so that words share buckets."""
    counts = prof.user_term_counts(_hashed_profiles(spark, sf_dir, FEW_FEATURES))
    vector = F.unwrap_udt("features")
    return hashing.hashed_vectors(counts, num_features=FEW_FEATURES).select(
        _key("user_id"),
        vector["size"].cast("bigint").alias("size"),
        F.array_join(vector["indices"].cast("array<string>"), ",").alias("indices"),
        F.array_join(vector["values"].cast("array<bigint>").cast("array<string>"), ",").alias("counts"),
    )


def _weighed(rows: DataFrame) -> DataFrame:
    return rows.select(_key("user_id"), F.col("word").cast("bigint").alias("bucket"), _real("tfidf"))


def hashed_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighed(wgt.count_idf(_hashed_profiles(spark, sf_dir)))


def hashed_tfidf_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users by a model of the active ones, which is kept in files and read again."""
    catalog, liked = cat.hash_catalog(_catalog(spark, sf_dir)), _liked(spark, sf_dir)
    known = sub.subset_by_keys(liked, _active(spark, sf_dir), "user_id")
    folder = shared_folder(spark, "idf-model")
    hashing.IdfModel.fit(prof.Profiles(known, catalog)).save(folder)
    model = hashing.IdfModel.load(spark, folder)
    return _weighed(model.weigh(prof.user_term_counts(prof.Profiles(liked, catalog))))


# Similarity


def user_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim.user_norms(_profiles(spark, sf_dir)).select(_key("user_id"), _real("norm"))


def dot_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim.dot_products(_profiles(spark, sf_dir), TARGET_USER).select(
        _key("user_id"), _real("dot_product")
    )


def cosine_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim.cosine_similarity(_profiles(spark, sf_dir), TARGET_USER).select(
        _key("user_id"), _real("cosine_similarity")
    )


def cosine_similarity_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _hashed_profiles(spark, sf_dir)
    return sim.cosine_similarity(profiles, TARGET_USER, "smoothed").select(
        _key("user_id"), _real("cosine_similarity")
    )


def similar_users_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    similarities = sim.cosine_similarity(_profiles(spark, sf_dir), TARGET_USER)
    return sim.most_similar(similarities).select(_key("user_id"), _real("cosine_similarity"))


def similar_users_positive_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _profiles(spark, sf_dir, "tagged")
    similarities = sim.cosine_similarity(profiles, TARGET_USER, zero="drop")
    return sim.most_similar(similarities).select(_key("user_id"), _real("cosine_similarity"))


def similar_users_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As similar_users_top3, from profiles that are stored once."""
    kept = store.store_profiles(_profiles(spark, sf_dir))
    similarities = store.stored_similarity(kept, TARGET_USER)
    return sim.most_similar(similarities).select(_key("user_id"), _real("cosine_similarity"))


def _many_neighbours(profiles: prof.Profiles) -> DataFrame:
    """The three nearest users, of all, of each user whose id is divisible by TARGETS_BY."""
    kept = store.store_profiles(profiles)
    targets = kept.by_user.select("user_id").filter(F.col("user_id") % TARGETS_BY == 0)
    return near.nearest_users(kept, targets)


def similar_users_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many_neighbours(_profiles(spark, sf_dir)).select(
        _key("target_user"), _key("rank"), _key("user_id"), _real("cosine_similarity")
    )


def vector_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    nearest = sim.vector_cosine_topk(
        testdata.embeddings(spark, sf_dir), TARGET_VECTOR, NEAREST_VECTORS
    )
    return nearest.select(_key("vec_id"), _real("cosine_similarity"))


# Recommendation


def unseen_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _profiles(spark, sf_dir)
    neighbours = sim.most_similar(sim.cosine_similarity(profiles, TARGET_USER))
    return rec.unseen_items(profiles, neighbours, TARGET_USER).select(
        _key("app_id"), _key("user_id"), _key("times")
    )


def _recommended(df: DataFrame) -> DataFrame:
    return df.select(_key("app_id"), "title", _joined("similar_user_ids"))


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommended(recommend_titled(*_inputs(spark, sf_dir), TARGET_USER))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommended(recommend_tagged(*_inputs(spark, sf_dir), TARGET_USER))


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommended(recommend_hashed(*_inputs(spark, sf_dir), TARGET_USER))


def recommend_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _profiles(spark, sf_dir)
    found = rec.recommend_many(profiles, _many_neighbours(profiles), "set")
    return found.select(_key("target_user"), _key("app_id"), "title", _joined("similar_user_ids"))


# Subsets


def active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.active_users(testdata.users(spark, sf_dir), MIN_REVIEWS).select(
        _key("user_id"), _key("products"), _key("reviews")
    )


def pick_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = sub.active_users(testdata.users(spark, sf_dir), MIN_REVIEWS)
    return sub.pick_user(active).select(_key("user_id"))


def subset_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.subset_users(
        testdata.users(spark, sf_dir), MIN_REVIEWS, MAX_USERS, TARGET_USER
    ).select(_key("user_id"))


def subset_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = sub.active_users(testdata.users(spark, sf_dir), MIN_REVIEWS)
    kept = sub.subset_by_keys(testdata.interactions(spark, sf_dir), keys, "user_id")
    return _interaction_columns(kept)


def build_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    subset = _subset(spark, sf_dir)
    return (
        subset.interactions.select(F.lit("interactions").alias("part"), "app_id", "user_id")
        .unionByName(
            subset.items.select(F.lit("items").alias("part"), "app_id", F.lit(-1).alias("user_id"))
        )
        .unionByName(
            subset.item_tags.select(
                F.lit("item_tags").alias("part"), "app_id", F.lit(-1).alias("user_id")
            )
        )
        .select("part", _key("app_id"), _key("user_id"))
    )


QUERIES: dict[str, Query] = {
    "scan_interactions": scan_interactions,
    "scan_items": scan_items,
    "scan_item_tags": scan_item_tags,
    "scan_users": scan_users,
    "subset_roundtrip_csv": subset_roundtrip_csv,
    "subset_roundtrip_json": subset_roundtrip_json,
    "recommendation_lines": recommendation_lines,
    "recommendation_lines_list": recommendation_lines_list,
    "positive_interactions": positive_interactions,
    "sample_interactions": sample_interactions,
    "user_item_lists": user_item_lists,
    "distinct_items": distinct_items,
    "tagged_items": tagged_items,
    "normalize_tags": normalize_tags,
    "item_title_lookup": item_title_lookup,
    "item_tag_lookup": item_tag_lookup,
    "user_item_details": user_item_details,
    "tagged_interactions": tagged_interactions,
    "user_terms": user_terms,
    "user_tag_profile": user_tag_profile,
    "user_term_totals": user_term_totals,
    "user_term_counts": user_term_counts,
    "user_count": user_count,
    "term_frequency": term_frequency,
    "document_frequency": document_frequency,
    "idf_plain": idf_plain,
    "idf_smoothed": idf_smoothed,
    "tfidf": tfidf,
    "target_profile": target_profile,
    "hashed_tf": hashed_tf,
    "hashed_vectors": hashed_vectors,
    "hashed_tfidf": hashed_tfidf,
    "hashed_tfidf_kept": hashed_tfidf_kept,
    "user_norms": user_norms,
    "dot_products": dot_products,
    "cosine_similarity": cosine_similarity,
    "cosine_similarity_hashed": cosine_similarity_hashed,
    "similar_users_top3": similar_users_top3,
    "similar_users_positive_top3": similar_users_positive_top3,
    "similar_users_stored": similar_users_stored,
    "similar_users_many": similar_users_many,
    "vector_cosine_topk": vector_cosine_topk,
    "unseen_items": unseen_items,
    "recommend_titled": titled,
    "recommend_tagged": tagged,
    "recommend_hashed": hashed,
    "recommend_many": recommend_many,
    "active_users": active_users,
    "pick_user": pick_user,
    "subset_users": subset_users,
    "subset_by_keys": subset_by_keys,
    "build_subset": build_subset,
}
