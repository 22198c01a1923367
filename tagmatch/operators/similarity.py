"""Cosine similarity of one target user with every other user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmatch.functions.weighting import (
    cosine,
    dense_norm,
    dense_sums,
    most_similar_first,
    norm,
)
from tagmatch.operators.profiles import Profiles, user_term_counts
from tagmatch.operators.weights import inverse_document_frequency, join_words, with_idf

ZERO_RULES = ("keep", "drop")

#: Neighbours that may be asked for.
MAX_NEIGHBOURS = 100_000


def _words_with_target(profiles: Profiles, target_user: int, kind: str) -> DataFrame:
    """(word, user_count, target_count, idf). One grouping by word gives both the
    document frequency and the target's counts, which are NULL where it has none."""
    is_target = F.col("user_id") == F.lit(target_user)
    words = (
        user_term_counts(profiles)
        .groupBy("word")
        .agg(
            F.count_if(F.col("word_count") > 0).alias("user_count"),
            F.max(F.when(is_target, F.col("word_count"))).alias("target_count"),
        )
    )
    return with_idf(words, profiles, kind)


def _user_sums(profiles: Profiles, target_user: int, kind: str) -> DataFrame:
    """(user_id, is_target, total, dot, norm, target_total, target_norm) over raw
    counts times idf. No rows if the target has no words."""
    words = _words_with_target(profiles, target_user, kind)
    target_weight = F.col("target_count") * F.col("idf")
    target = words.agg(
        F.struct(
            norm(F.sum(target_weight * target_weight)).alias("norm"),
            F.sum("target_count").alias("total"),
        )
    ).scalar()

    words = words.select(
        "word",
        "user_count",
        "idf",
        F.coalesce(target_weight, F.lit(0.0)).alias("target_weight"),
        target["norm"].alias("target_norm"),
        target["total"].alias("target_total"),
    )
    weight = F.col("word_count") * F.col("idf")
    sums = (
        join_words(user_term_counts(profiles), words, profiles)
        .groupBy("user_id")
        .agg(
            # Tests on aggregates stay above the grouping. Pushed below it, they
            # would give this branch a scan and a shuffle of its own.
            F.max(F.col("user_id") == F.lit(target_user)).alias("is_target"),
            F.sum("word_count").alias("total"),
            F.sum(weight * F.col("target_weight")).alias("dot"),
            norm(F.sum(weight * weight)).alias("norm"),
            F.max("target_norm").alias("target_norm"),
            F.max("target_total").alias("target_total"),
        )
    )
    return sums.filter(F.col("target_norm").isNotNull())


def user_norms(profiles: Profiles, kind: str = "plain") -> DataFrame:
    """(user_id, norm) of the tf-idf vector of each user."""
    idf = inverse_document_frequency(profiles, kind)
    weight = F.col("word_count") * F.col("idf")
    return (
        join_words(user_term_counts(profiles), idf, profiles)
        .groupBy("user_id")
        .agg((norm(F.sum(weight * weight)) / F.sum("word_count")).alias("norm"))
    )


def dot_products(profiles: Profiles, target_user: int, kind: str = "plain") -> DataFrame:
    """(user_id, dot_product) of the target's tf-idf vector with each other user's."""
    sums = _user_sums(profiles, target_user, kind).filter(~F.col("is_target"))
    dot = F.col("dot") / F.col("total") / F.col("target_total")
    return sums.select("user_id", dot.alias("dot_product"))


def cosine_similarity(
    profiles: Profiles, target_user: int, kind: str = "plain", zero: str = "keep"
) -> DataFrame:
    """(user_id, cosine_similarity) of each user but the target.

    Dividing a user's counts by their total leaves its cosines unchanged, so raw
    counts are used and no totals are joined. Users without a common word have
    similarity 0.0, and so has everyone if all words of the target have idf 0.
    ``zero="drop"`` leaves them out. An unknown target gives no rows.
    """
    if zero not in ZERO_RULES:
        raise ValueError(f"zero must be one of {ZERO_RULES}, not {zero!r}")
    similarity = cosine(F.col("dot"), F.col("norm"), F.col("target_norm"))
    similarities = (
        _user_sums(profiles, target_user, kind)
        .filter(~F.col("is_target"))
        .select("user_id", similarity.alias("cosine_similarity"))
    )
    if zero == "drop":
        return similarities.filter(F.col("cosine_similarity") > 0)
    return similarities


def most_similar(similarities: DataFrame, k: int = 3) -> DataFrame:
    """The k users of highest similarity; of equals, the lower ids. They are broadcast
    later on, so k is bounded."""
    if k > MAX_NEIGHBOURS:
        raise ValueError(f"k must be {MAX_NEIGHBOURS} at most, not {k}")
    return similarities.orderBy(*most_similar_first("cosine_similarity", "user_id")).limit(k)


def vector_cosine_topk(
    vectors: DataFrame, target_id: int, k: int = 3, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k dense vectors of highest cosine with one target vector."""
    chosen = vectors.filter(F.col(key) == F.lit(target_id)).agg(F.max(vector).alias("target"))
    target = chosen.select(F.struct("target", dense_norm(F.col("target")).alias("norm"))).scalar()
    scored = (
        vectors.filter(F.col(key) != F.lit(target_id))
        .select(key, vector, target.alias("t"))
        .filter(F.col("t.target").isNotNull())
        .select(key, dense_sums(F.col(vector), F.col("t.target")).alias("sums"), F.col("t.norm").alias("target_norm"))
        .select(key, F.col("sums.dot").alias("dot"), norm(F.col("sums.square")).alias("norm"), "target_norm")
        .select(key, cosine(F.col("dot"), F.col("norm"), F.col("target_norm")).alias("cosine_similarity"))
    )
    return scored.orderBy(*most_similar_first("cosine_similarity", key)).limit(k)
