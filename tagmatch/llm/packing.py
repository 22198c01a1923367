"""Harmonic packing: token sequences filled class by class.

A piece of a document belongs to class k if k of it, and not k + 1, fit in a
sequence. Sequences of class k take exactly k pieces, whatever their documents, so
every worker fills its classes for itself; only what is left over when it ends, less
than one sequence per class, is numbered again over all workers.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship
from tagmatch.sources.shared import small_batches, stored

CAPACITY = 2048
END_ID = 1
#: A piece stays whole if it fills this share of its class's slot.
FULL_ENOUGH = 0.97
#: Rows of pieces that a worker hands over at once.
ROWS_AT_ONCE = 20_000

# Fixed value: how a byte-level BPE cuts a text before it merges bytes.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
)

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "per int, worker int, number long"
)
RESULT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "per")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it
    is printable, else the next letter from code 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts, the same as ``tokenizers`` gives for a byte-level BPE file.

    The file's own vocabulary and special tokens are put into ``tiktoken``, which is
    six times as fast.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in spec["model"]["vocab"].items()
            if token not in special
        }
        self._encoding = tiktoken.Encoding(
            "file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def encode(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, made at its first use."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut_lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then what remains.

    A remainder that would leave its slot of capacity / k visibly empty gives up one
    slot of capacity / (k + 1), and the rest of it, smaller, is looked at again.
    """
    pieces = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        if rest >= FULL_ENOUGH * (capacity // k):
            pieces.append(rest)
            break
        pieces.append(capacity // (k + 1))
        rest -= pieces[-1]
    return pieces


def _cut(path: str, capacity: int):
    columns = [c.split()[0] for c in PIECES.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, worker = encoder(path).encode, TaskContext.get().partitionId()
        end = np.array([END_ID], dtype="<u4").tobytes()
        numbers: dict[int, int] = {}
        rows: list[tuple] = []
        for batch in batches:
            docs = batch["doc_id"].astype("Int64").to_list()
            for doc, text in zip(docs, batch["text"]):
                code = encode(text or "").tobytes() + end
                total, start = len(code) // 4, 0
                for length in cut_lengths(total, capacity):
                    per = capacity // length
                    number = numbers.get(per, 0)
                    numbers[per] = number + 1
                    crc = zlib.crc32(memoryview(code)[4 * start : 4 * (start + length)])
                    rows.append((doc, start, length, crc, total, per, worker, number))
                    start += length
                if len(rows) >= ROWS_AT_ONCE:
                    yield frame(rows)
                    rows = []
        yield frame(rows)

    return cut


def _fit(capacity: int):
    """First fit by falling length, of the few pieces that fill no sequence of their class."""

    def fit(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "per", "index"], ascending=[False, True, True], ignore_index=True)
        filled: list[int] = []
        places = []
        for length in rest["length"]:
            bin_ = next((b for b, f in enumerate(filled) if f + length <= capacity), len(filled))
            if bin_ == len(filled):
                filled.append(0)
            places.append((bin_, filled[bin_]))
            filled[bin_] += length
        rest["bin"] = [b for b, _ in places]
        rest["offset"] = [o for _, o in places]
        return rest[["per", "index", "bin", "offset"]]

    return fit


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their sequence and place in it.

    Each document is its ids and a final ``END_ID``; a null text is empty, a null
    doc_id stays null, repeated rows are packed again. Sequences are numbered from 0
    without gaps in the order of classes; an empty table gives no rows. Other
    columns of ``docs`` are not used.

    A class is numbered over all workers by a table of counts per worker and class.
    What fills no sequence of its class is less than one sequence per class, of which
    there are at most 2 * sqrt(capacity): these pieces are fitted together in one task.
    """
    ship(docs.sparkSession)
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        _cut(tokenizer_path, capacity), PIECES
    )
    with small_batches(docs.sparkSession):
        pieces = stored(cut, "pieces")
    counts = pieces.groupBy("per", "worker").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("per").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "per", "worker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    totals = counts.groupBy("per").agg(F.floor(F.sum("n") / F.col("per")).alias("full"))
    lower = Window.orderBy("per").rowsBetween(Window.unboundedPreceding, -1)
    classes = totals.select(
        "per", "full", F.coalesce(F.sum("full").over(lower), F.lit(0)).alias("first")
    )
    indexed = (
        pieces.join(starts, ["per", "worker"])
        .join(F.broadcast(classes), "per")
        .withColumn("index", F.col("before") + F.col("number"))
        .withColumn("bin", F.floor(F.col("index") / F.col("per")))
    )
    own = Window.partitionBy("sequence_id").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    whole = (
        indexed.filter("bin < full")
        .withColumn("sequence_id", F.col("first") + F.col("bin"))
        .withColumn("offset", F.coalesce(F.sum("length").over(own), F.lit(0)))
    )
    rest = indexed.filter("bin >= full")
    fitted = (
        rest.select(F.lit(0).alias("all"), "per", "index", "length")
        .groupBy("all")
        .applyInPandas(_fit(capacity), "per int, index long, bin long, offset long")
    )
    last = classes.agg(F.sum("full").alias("last"))
    tail = (
        rest.drop("bin")
        .join(fitted, ["per", "index"])
        .crossJoin(F.broadcast(last))
        .withColumn("sequence_id", F.col("last") + F.col("bin"))
    )
    return whole.select(*RESULT).unionByName(tail.select(*RESULT))
