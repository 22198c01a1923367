"""Column expressions for term weights and cosine similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDF_KINDS = ("plain", "smoothed")

SIMILARITY_DIGITS = 12


def idf(users: Column, users_with_word: Column, kind: str = "plain") -> Column:
    """Inverse document frequency: ln(N / df), or smoothed ln((N + 1) / (df + 1))."""
    if kind == "plain":
        return F.log(users / users_with_word)
    if kind == "smoothed":
        return F.log((users + 1) / (users_with_word + 1))
    raise ValueError(f"idf must be one of {IDF_KINDS}, not {kind!r}")


def norm(squares: Column) -> Column:
    return F.sqrt(squares)


def cosine(dot: Column, left_norm: Column, right_norm: Column) -> Column:
    """Cosine of two vectors; 0.0 where either has norm zero."""
    scale = left_norm * right_norm
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot / scale)


def dense_dot(left: Column, right: Column) -> Column:
    """Dot product of two array columns of equal length."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def dense_sums(row: Column, target: Column) -> Column:
    """Struct (dot, square) of two array columns, in one pass over their elements."""
    pairs = F.arrays_zip(row.alias("a"), target.alias("b"))
    zero = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("square"))

    def add(total: Column, pair: Column) -> Column:
        a, b = pair["a"].cast("double"), pair["b"].cast("double")
        return F.struct((total["dot"] + a * b).alias("dot"), (total["square"] + a * a).alias("square"))

    return F.aggregate(pairs, zero, add)


def dense_norm(vector: Column) -> Column:
    return norm(dense_dot(vector, vector))


def most_similar_first(similarity: str, user: str) -> list[Column]:
    """Ranking order. Rounding makes equal vectors tie whatever order their sums
    were added in; ties go to the lower id."""
    return [F.round(F.col(similarity), SIMILARITY_DIGITS).desc(), F.col(user).asc()]
