"""Term frequency, inverse document frequency and their product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.functions.weighting import idf as idf_of
from tagmatch.operators.profiles import (
    Profiles,
    user_count,
    user_term_counts,
    user_term_totals,
)
from tagmatch.plans.skew import join_salted


def term_frequency(profiles: Profiles) -> DataFrame:
    """(user_id, word, word_count, total_word_count, tf), tf relative to all words
    of the user."""
    if profiles.words_fit:
        counts = _counts_with_totals(profiles)
    else:
        counts = join_salted(
            profiles.counts,
            user_term_totals(profiles),
            "user_id",
            profiles.hot_users,
            ["word"],
            profiles.scale,
        )
    tf = F.col("word_count") / F.col("total_word_count")
    return counts.select("user_id", "word", "word_count", "total_word_count", tf.alias("tf"))


def _counts_with_totals(profiles: Profiles) -> DataFrame:
    """An ordinary user's counts already share a partition, so the window adds no
    shuffle. Hot users are few, so their totals are broadcast."""
    total = F.sum("word_count")
    counts = profiles.count_words(profiles.ordinary).withColumn(
        "total_word_count", total.over(Window.partitionBy("user_id"))
    )
    if profiles.hot is None:
        return counts
    hot = profiles.count_words(profiles.hot)
    hot_totals = hot.groupBy("user_id").agg(total.alias("total_word_count"))
    return counts.unionByName(hot.join(F.broadcast(hot_totals), "user_id"))


def document_frequency(profiles: Profiles) -> DataFrame:
    """(word, user_count): how many users have the word."""
    # Counts are at least 1. Testing them keeps the column in the plan, so that
    # this reads the same shuffle as the other uses of user_term_counts.
    users = F.count_if(F.col("word_count") > 0)
    return user_term_counts(profiles).groupBy("word").agg(users.alias("user_count"))


def inverse_document_frequency(profiles: Profiles, kind: str = "plain") -> DataFrame:
    """(word, user_count, idf)."""
    return with_idf(document_frequency(profiles), profiles, kind)


def with_idf(words: DataFrame, profiles: Profiles, kind: str) -> DataFrame:
    users = user_count(profiles).scalar()
    return words.withColumn("idf", idf_of(users, F.col("user_count"), kind))


def join_words(counts: DataFrame, words: DataFrame, profiles: Profiles) -> DataFrame:
    """Join (user_id, word, ...) rows with one row per word."""
    if profiles.words_fit:
        return counts.join(F.broadcast(words), "word")
    return join_salted(counts, words, "word", profiles.hot_words, ["user_id"], profiles.scale)


def tfidf(profiles: Profiles, kind: str = "plain") -> DataFrame:
    """(user_id, word, tfidf) with relative term frequency."""
    idf = inverse_document_frequency(profiles, kind)
    weight = F.col("tf") * F.col("idf")
    return join_words(term_frequency(profiles), idf, profiles).select(
        "user_id", "word", weight.alias("tfidf")
    )


def count_idf(profiles: Profiles, kind: str = "smoothed") -> DataFrame:
    """(user_id, word, tfidf) with the raw count as term frequency."""
    idf = inverse_document_frequency(profiles, kind)
    weight = F.col("word_count") * F.col("idf")
    return join_words(user_term_counts(profiles), idf, profiles).select(
        "user_id", "word", weight.alias("tfidf")
    )


def target_profile(profiles: Profiles, target_user: int, kind: str = "plain") -> DataFrame:
    """(word, tfidf) of one user."""
    return (
        tfidf(profiles, kind)
        .filter(F.col("user_id") == F.lit(target_user))
        .select("word", "tfidf")
    )
