"""Hashed term vectors as ML vectors, and an idf model that outlives its corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tagmatch.functions.weighting import IDF_KINDS
from tagmatch.functions.weighting import idf as idf_of
from tagmatch.operators.catalog import NUM_FEATURES
from tagmatch.operators.profiles import Profiles, user_count
from tagmatch.operators.weights import document_frequency
from tagmatch.plans.skew import Scale, hot_keys, join_salted, text_bytes
from tagmatch.sources.shared import stored


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """ML vector from ascending indices and their values, both arrays.

    Spark has no cast to its vector type, but reads it from JSON, in the JVM.
    """
    parts = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")
    )
    schema = StructType([StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("vector"))), schema)["vector"]


def hashed_vectors(
    rows: DataFrame, value: str = "word_count", num_features: int = NUM_FEATURES
) -> DataFrame:
    """(user_id, features): one sparse vector per user from (user_id, word, value) rows
    whose words are buckets. A vector has at most ``num_features`` entries."""
    held = F.sort_array(F.collect_list(F.struct(F.col("word").cast("int").alias("i"), F.col(value).cast("double").alias("v"))))
    vectors = rows.groupBy("user_id").agg(held.alias("held"))
    return vectors.select("user_id", sparse_vector(num_features, F.col("held.i"), F.col("held.v")).alias("features"))


@dataclass(frozen=True)
class IdfModel:
    """How many of ``users`` users have each word: (word, user_count) rows.

    Words may be text or buckets. A model is kept in a folder and read again, so that
    users who come later are weighted as the first ones were.
    """

    words: DataFrame
    users: int
    kind: str
    scale: Scale

    @staticmethod
    def fit(profiles: Profiles, kind: str = "smoothed") -> IdfModel:
        """The model of all users of the profiles."""
        _check_kind(kind)
        users = user_count(profiles).first()["user_count"]
        return IdfModel(stored(document_frequency(profiles), "idf"), users, kind, profiles.scale)

    def save(self, folder: str) -> None:
        folder = folder.rstrip("/")
        self.words.write.mode("overwrite").parquet(f"{folder}/words")
        facts = self.words.sparkSession.range(1).select(
            F.lit(self.users).cast("bigint").alias("users"), F.lit(self.kind).alias("kind")
        )
        facts.write.mode("overwrite").parquet(f"{folder}/facts")

    @staticmethod
    def load(spark: SparkSession, folder: str, scale: Scale = Scale()) -> IdfModel:
        folder = folder.rstrip("/")
        facts = spark.read.parquet(f"{folder}/facts").first()
        return IdfModel(spark.read.parquet(f"{folder}/words"), facts["users"], facts["kind"], scale)

    def idf(self) -> DataFrame:
        """(word, user_count, idf)."""
        return self.words.withColumn("idf", self._idf(F.col("user_count")))

    def _idf(self, user_count: Column) -> Column:
        return idf_of(F.lit(float(self.users)), user_count, self.kind)

    def weigh(self, counts: DataFrame) -> DataFrame:
        """(user_id, word, word_count, tfidf) of any (user_id, word, word_count) rows.

        Words that the model has not seen have user_count 0: with smoothed idf they weigh
        most, ln(users + 1), and with plain idf, which has no value for them, nothing.
        """
        words = self.words.select("word", F.col("user_count").alias("seen"))
        if words.agg(text_bytes().alias("bytes")).first()["bytes"] <= self.scale.broadcast_bytes:
            joined = counts.join(F.broadcast(words), "word", "left")
        else:
            hot = hot_keys(counts, "word", self.scale)
            known = join_salted(counts, words, "word", hot, ["user_id"], self.scale)
            new = counts.join(words, "word", "left_anti").withColumn("seen", F.lit(None).cast("bigint"))
            joined = known.unionByName(new)
        unseen = self._idf(F.lit(0)) if self.kind == "smoothed" else F.lit(0.0)
        idf = F.when(F.col("seen").isNull(), unseen).otherwise(self._idf(F.col("seen")))
        return joined.select("user_id", "word", "word_count", (F.col("word_count") * idf).alias("tfidf"))


def _check_kind(kind: str) -> None:
    if kind not in IDF_KINDS:
        raise ValueError(f"idf must be one of {IDF_KINDS}, not {kind!r}")
