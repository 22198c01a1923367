"""Liked rows with the words of their items, laid out by user.

Shuffling one narrow (user_id, app_id) row per interaction by user costs a small
part of shuffling its exploded words. Once a user's rows share a partition, all
that is counted per user or per (user, word) needs no further shuffle. Hot users
are kept out of that layout: their words are counted where the rows lie and only
the counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tagmatch.plans.skew import Scale, hot_keys, join_salted, text_bytes
from tagmatch.sources.shared import shuffles_deleted, stored

# Copies of one (user, item) row that stay together in a large join.
CHUNK = 100_000

# Bytes of the numbers that go with a word when words are broadcast.
WORD_ROW_BYTES = 48


class Profiles:
    """Liked rows and the catalog, in the layouts that the operators need.

    Making one stores the catalog, since it is read many times, and measures it. A
    small catalog is broadcast to rows that lie by user already. A large one is
    joined by salted item, after equal (user, item) rows are counted together and
    stored, and the result is laid out by user. Each layout is planned when first asked
    for; the search for hot keys is then a job of its own.

    catalog: one row per item, marked for broadcast if it is small.
    words_fit: one row per distinct word fits in a broadcast.
    counted: counts are stored, so that totals had better be summed from them.
    """

    def __init__(self, liked: DataFrame, catalog: DataFrame, scale: Scale = Scale()) -> None:
        self.scale = scale
        self._liked = liked
        catalog = stored(catalog, "catalog")
        self.small, self.words_fit = _measure(catalog, scale)
        self.counted = not self.words_fit
        self.catalog = F.broadcast(catalog) if self.small else catalog
        self._item_words = catalog.select("app_id", "words")

    def with_counts(self, counts: DataFrame) -> Profiles:
        """The same profiles, their ``counts`` read from a table that has them."""
        other = copy(self)
        other.counts, other.counted = counts, True
        return other

    @cached_property
    def _rows(self) -> DataFrame:
        """Liked rows and how often each is there. With a large catalog, every use would
        shuffle the rows, and their source, again; so they are written once."""
        if self.small:
            return self._liked.withColumn("times", F.lit(1).cast("bigint"))
        with shuffles_deleted(self._liked.sparkSession):
            return stored(_count_pairs(self._liked), "rows")

    @cached_property
    def details(self) -> DataFrame:
        """(user_id, app_id, times, title, words), in no particular layout."""
        joined = self._with_items(self._rows, self.catalog)
        return joined.select("user_id", "app_id", "times", "title", "words")

    @cached_property
    def hot_users(self) -> DataFrame | None:
        """(user_id) of hot users; None if there are none."""
        return self._hot("user_id")

    @cached_property
    def _kept_rows(self) -> DataFrame:
        """The rows, written once if ordinary and hot users are read apart: the two
        parts are read several times, and narrow rows are cheaper than their source."""
        return self._rows if self.hot_users is None or not self.small else stored(self._rows, "rows")

    @cached_property
    def held(self) -> DataFrame:
        """(user_id, app_id, times), items not yet checked against the catalog. Of a
        small catalog, these are the shuffled rows that words are counted from."""
        if not self.small:
            return self._kept_rows.select("user_id", "app_id", "times")
        by_user = _by_user(self._ordinary_of(self._kept_rows))
        hot = self._hot_of(self._kept_rows)
        return by_user if hot is None else by_user.unionByName(hot)

    @cached_property
    def ordinary(self) -> DataFrame:
        """(user_id, times, words) of ordinary users, hash-partitioned by user. The
        words are numbers if there is a table of ``word_numbers``."""
        if self.small:
            return self._with_words(_by_user(self._ordinary_of(self._kept_rows)))
        return _by_user(self._ordinary_of(self._with_words(self._kept_rows)))

    @cached_property
    def hot(self) -> DataFrame | None:
        """The same columns of hot users, in no layout; None if there are none."""
        if self.hot_users is None:
            return None
        if self.small:
            return self._with_words(self._hot_of(self._kept_rows))
        return self._hot_of(self._with_words(self._kept_rows))

    @cached_property
    def counts(self) -> DataFrame:
        """(user_id, word, word_count). Counted anew wherever it is used, from one
        shuffle, unless there are too many words to broadcast; then it is stored."""
        counts = self.per_part(self.count_words)
        return counts if self.words_fit else stored(counts, "counts")

    @cached_property
    def hot_words(self) -> DataFrame | None:
        """(word) of very many users if words do not fit; None if there are none."""
        return None if self.words_fit else hot_keys(self.counts, "word", self.scale)

    @cached_property
    def word_numbers(self) -> DataFrame | None:
        """(word, number), where a large catalog has few distinct words, else None.

        Rows with the words of a large catalog are shuffled by user. Numbers make
        them several times smaller than words would.
        """
        is_text = self._item_words.selectExpr("words[0]").dtypes[0][1] == "string"
        if self.small or not self.words_fit or not is_text:
            return None
        words = self._item_words.select(F.explode("words").alias("word")).distinct()
        # The words are known to fit in a broadcast, so one task can number them.
        number = F.monotonically_increasing_id().cast("int").alias("number")
        return stored(words.repartition(1).select("word", number), "words")

    @cached_property
    def _counted_words(self) -> DataFrame:
        """(app_id, words) as they are counted, numbers if there are any."""
        if self.word_numbers is None:
            return F.broadcast(self._item_words) if self.small else self._item_words
        words = self._item_words.select("app_id", F.explode("words").alias("word"))
        numbered = words.join(F.broadcast(self.word_numbers), "word").groupBy("app_id")
        return stored(numbered.agg(F.collect_list("number").alias("words")), "item-words")

    @cached_property
    def _hot_items(self) -> DataFrame | None:
        return self._hot("app_id")

    def _hot(self, key: str) -> DataFrame | None:
        if self.small:
            return hot_keys(self._liked, key, self.scale)
        return hot_keys(self._rows, key, self.scale, "times")

    def count_words(self, rows: DataFrame) -> DataFrame:
        """(user_id, word, word_count) of one part."""
        words = rows.select("user_id", "times", F.explode("words").alias("word"))
        counts = words.groupBy("user_id", "word").agg(F.sum("times").alias("word_count"))
        if self.word_numbers is None:
            return counts
        named = counts.withColumnRenamed("word", "number").join(
            F.broadcast(self.word_numbers), "number"
        )
        return named.select("user_id", "word", "word_count")

    def per_part(self, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Apply a step to the ordinary and the hot rows, put the results together."""
        if self.hot is None:
            return step(self.ordinary)
        return step(self.ordinary).unionByName(step(self.hot))

    def _ordinary_of(self, rows: DataFrame) -> DataFrame:
        if self.hot_users is None:
            return rows
        return rows.join(F.broadcast(self.hot_users), "user_id", "left_anti")

    def _hot_of(self, rows: DataFrame) -> DataFrame | None:
        if self.hot_users is None:
            return None
        return rows.join(F.broadcast(self.hot_users), "user_id", "left_semi")

    def _with_items(self, rows: DataFrame, items: DataFrame) -> DataFrame:
        if self.small:
            return rows.join(items, "app_id")
        spread_on = ["user_id", "chunk"]
        return join_salted(rows, items, "app_id", self._hot_items, spread_on, self.scale)

    def _with_words(self, rows: DataFrame) -> DataFrame:
        return self._with_items(rows, self._counted_words).select("user_id", "times", "words")


def _measure(catalog: DataFrame, scale: Scale) -> tuple[bool, bool]:
    """Whether the catalog fits in a broadcast, and whether its distinct words do. Of a
    small catalog, all words are taken for distinct."""
    words = F.coalesce(F.sum(F.size("words")), F.lit(0))
    size = catalog.agg(text_bytes().alias("bytes"), words.alias("words")).first()
    small = size["bytes"] <= scale.broadcast_bytes
    if not _words_fit(size, scale):
        distinct = catalog.select(F.explode("words").alias("word")).distinct()
        size = distinct.agg(text_bytes().alias("bytes"), F.count("word").alias("words")).first()
    return small, _words_fit(size, scale)


def _words_fit(size: Row, scale: Scale) -> bool:
    return size["bytes"] + size["words"] * WORD_ROW_BYTES <= scale.broadcast_bytes


def _by_user(rows: DataFrame) -> DataFrame:
    """One shuffle by user. The number of partitions is given, so that they are not
    merged at run time by the size of these rows: they grow many times over when
    their words are exploded."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "user_id")


def _count_pairs(liked: DataFrame) -> DataFrame:
    """(user_id, app_id, chunk, times): equal rows counted, at most CHUNK to a row,
    so that not even the copies of one row have to stay together."""
    counted = liked.groupBy("user_id", "app_id").agg(F.count(F.lit(1)).alias("copies"))
    last_chunk = F.expr(f"(copies - 1) div {CHUNK}")
    return counted.select(
        "user_id", "app_id", "copies", F.explode(F.sequence(F.lit(0), last_chunk)).alias("chunk")
    ).select(
        "user_id",
        "app_id",
        "chunk",
        F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK).alias("times"),
    )


def _repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``times`` says."""
    copies = F.explode(F.sequence(F.lit(1), F.col("times")))
    return rows.withColumn("copy", copies).drop("copy", "times")


def user_item_details(profiles: Profiles) -> DataFrame:
    """(user_id, app_id, title, words), one row per liked row whose item counts."""
    return _repeated(profiles.details)


def tagged_interactions(profiles: Profiles) -> DataFrame:
    """(user_id, app_id, words) of liked rows whose item has tags, titled or not.
    For profiles built on a catalog of scope "tagged"."""
    return _repeated(profiles.details.select("user_id", "app_id", "times", "words"))


def user_terms(profiles: Profiles) -> DataFrame:
    """(user_id, word), one row per word of each liked row."""
    words = profiles.details.select("user_id", "times", F.explode("words").alias("word"))
    return _repeated(words)


def user_term_counts(profiles: Profiles) -> DataFrame:
    return profiles.counts


def user_term_totals(profiles: Profiles) -> DataFrame:
    """(user_id, total_word_count)."""
    if profiles.counted:
        total = F.sum("word_count").alias("total_word_count")
        return profiles.counts.groupBy("user_id").agg(total)
    words = F.sum(F.col("times") * F.size("words"))
    return profiles.per_part(
        lambda rows: rows.groupBy("user_id").agg(words.alias("total_word_count"))
    )


def user_count(profiles: Profiles) -> DataFrame:
    """One row: the number of users with at least one word."""
    # Every user here has words. Testing the total keeps the same columns in the
    # plan as counting words does, so that both read one shuffle.
    users = F.count_if(F.col("total_word_count") > 0)
    return user_term_totals(profiles).agg(users.alias("user_count"))


def user_tag_profile(profiles: Profiles) -> DataFrame:
    """Words of each user in order, in pages.

    A page holds each word once, and ``word_counts`` tells how often the user has it.
    Words are dealt to ``Scale.word_pages`` pages by hash, so a word is on the same page
    for every user and any data; a page without words has no row.
    """
    digits = F.substring(F.md5(F.col("word").cast("binary")), 1, 6)
    page = F.conv(digits, 16, 10).cast("bigint") % profiles.scale.word_pages
    held = F.sort_array(F.collect_list(F.struct("word", "word_count")))

    def fold(rows: DataFrame) -> DataFrame:
        return (
            profiles.count_words(rows)
            .groupBy("user_id", page.alias("page"))
            .agg(held.alias("held"))
            .select(
                "user_id",
                "page",
                F.col("held.word").alias("tag_words"),
                F.col("held.word_count").alias("word_counts"),
            )
        )

    return profiles.per_part(fold)
