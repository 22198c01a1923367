"""The engine's input tables as views of the test tables.

An order's customer is the user, a line's part the item, and a returned line
(flag A) a liked row. Part names, brands, types and sizes are the tags.

Some cases that the test tables lack are made from line numbers and part sizes: rows
without a flag or a user, items without a title row, without tags or with an empty
list, items with two title rows or two tag lists, tags with commas and odd blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_partkey").alias("app_id"),
        F.col("l_linenumber").alias("helpful"),
        F.col("l_suppkey").alias("funny"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        ((F.col("l_returnflag") == "A") & F.when(F.col("l_linenumber") != 6, F.lit(True))).alias("is_recommended"),
        F.col("l_quantity").alias("hours"),
        F.when(F.col("l_linenumber") != 7, F.col("o_custkey")).alias("user_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
    )


def _case() -> Column:
    return F.col("p_size") % 10


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("p_size") % 2 == 0
    twice = F.when(_case() == 8, F.array(F.col("p_name"), F.concat("p_name", F.lit(" II"))))
    parts = table(spark, sf_dir, "part").filter(_case() != 7)
    return parts.withColumn("title", F.explode(F.coalesce(twice, F.array("p_name")))).select(
        F.col("p_partkey").alias("app_id"),
        "title",
        F.concat(F.lit("2000-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0")).alias(
            "date_release"
        ),
        F.lit(True).alias("win"),
        even.alias("mac"),
        (~even).alias("linux"),
        F.col("p_type").alias("rating"),
        F.col("p_size").alias("positive_ratio"),
        F.col("p_size").alias("user_reviews"),
        F.col("p_retailprice").alias("price_final"),
        F.col("p_retailprice").alias("price_original"),
        F.lit(0.0).alias("discount"),
        even.alias("steam_deck"),
    )


def item_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.concat(F.lit("size "), F.col("p_size").cast("string"))
    plain = F.concat(F.split("p_name", r"\s+"), F.array("p_brand", "p_type", size))
    tags = (
        F.when(_case() == 3, F.lit(None))
        .when(_case() == 4, F.array().cast("array<string>"))
        .when(_case() == 5, F.concat(plain, F.array(F.lit("New, Used"))))
        .when(_case() == 6, F.concat(plain, F.array(F.lit("  Wide \t Tag "))))
        .otherwise(plain)
    )
    twice = F.when(_case() == 9, F.array(plain, F.concat(plain, F.array(F.lit("zz")))))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        F.col("p_type").alias("description"),
        F.explode(F.coalesce(twice, F.array(tags))).alias("tags"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(spark, sf_dir).groupBy("user_id").agg(
        F.countDistinct("app_id").alias("products"), F.count(F.lit(1)).alias("reviews")
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")
