"""Joining facts on documents back to the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "_tagmatch_text_hash"


def with_document_facts(docs: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` joined with facts (doc_id_, hash_, ...) on doc_id and the text's hash.

    The hash is a column before the join. So where facts are too many to be broadcast, the
    text is exchanged only if it is asked for afterwards.
    """
    hashed = docs.withColumn(_HASH, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col(_HASH) == F.col("hash_"))
    return hashed.join(facts, same, how).drop(_HASH)
