"""Line dedup: a suffix array over line numbers, made by distributed prefix doubling.

Lines get numbers; a suffix is a document's lines from one of them on. Round by round
every suffix learns its rank by its first 1, 2, 4, ... lines: the ranks of two halves
make the rank of the whole. Suffixes of equal rank share that many lines: they are one
interval of the array, whose longest common prefixes are at least that long. A run of
lines that is long enough and shared by an interval is a repeated run; all its copies
but the first, by document and place, are deleted.

A suffix whose first lines are found nowhere else is alone in its interval and leaves
the array: no longer run can start there. Lines are compared by their MD5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.sources.shared import stored

#: A run counts if its lines, each with its line end, have this many characters.
MIN_CHARS = 100
#: Lists of lines to delete are broadcast up to this many documents and lines in all.
BROADCAST_LINES = 2_000_000
#: Cells of the running sums by which ranks are given.
CELLS = 4096

DOC = ["doc_id", "text_hash"]
ADDED = ("n_lines", "n_removed", "n_runs")


def _before(counts: DataFrame, group: list[str], key: str, cell: Column) -> DataFrame:
    """``counts`` (group, key, n) with ``before``, the sum of n over the group's smaller
    keys. It is summed within cells and over cells, so no task gets all keys of a
    large group."""
    earlier = (Window.unboundedPreceding, -1)
    celled = counts.withColumn("cell", cell)
    outer = Window.partitionBy(*group).orderBy("cell").rowsBetween(*earlier)
    inner = Window.partitionBy(*group, "cell").orderBy(key).rowsBetween(*earlier)
    cells = (
        celled.groupBy(*group, "cell")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("cells_before", F.coalesce(F.sum("cell_n").over(outer), F.lit(0)))
        .drop("cell_n")
    )
    return (
        celled.withColumn("cell_before", F.coalesce(F.sum("n").over(inner), F.lit(0)))
        .join(cells, [*group, "cell"])
        .withColumn("before", F.col("cells_before") + F.col("cell_before"))
        .drop("cell", "cell_before", "cells_before")
    )


def repeated_lines(docs: DataFrame) -> tuple[DataFrame, int]:
    """(document, pos, chars, rank) of every line that occurs twice or more, ranked by
    its number among them, and how many there are."""
    line = F.col("line")
    lines = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        .filter(F.col("text").isNotNull())
        .select(*DOC, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select(*DOC, "pos", (F.length(line) + 1).alias("chars"), F.unhex(F.md5(line.cast("binary"))).alias("line_hash"))
    )
    lines = stored(lines, "lines")
    counts = lines.groupBy("line_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    first_byte = F.conv(F.substring(F.hex("line_hash"), 1, 3), 16, 10).cast("int") % CELLS
    numbered = stored(
        _before(counts, [], "line_hash", first_byte).select("line_hash", F.col("before").alias("rank")),
        "line-numbers",
    )
    repeated = stored(
        lines.join(numbered, "line_hash").select(*DOC, "pos", "chars", "rank").distinct(), "suffixes"
    )
    return repeated, repeated.count()


def _with_need(repeated: DataFrame, min_chars: int) -> DataFrame:
    """Adds ``need``: how many lines from here on make up a run of ``min_chars``.

    It is null where the repeated lines that follow each other here are too few."""
    in_doc = Window.partitionBy(*DOC).orderBy("pos")
    island = Window.partitionBy(*DOC, "island")
    start = F.coalesce(
        F.sum("chars").over(island.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    behind = island.orderBy("start").rangeBetween(min_chars, Window.unboundedFollowing)
    return (
        repeated.withColumn("island", F.col("pos") - F.row_number().over(in_doc))
        .withColumn("start", start)
        .withColumn("next", F.min("pos").over(behind))
        .withColumn("island_end", F.max("pos").over(island) + 1)
        .withColumn("island_chars", F.sum("chars").over(island))
        .withColumn(
            "need",
            F.coalesce(
                F.col("next"),
                F.when(F.col("island_chars") - F.col("start") >= min_chars, F.col("island_end")),
            )
            - F.col("pos"),
        )
        .select(*DOC, "pos", "rank", "need")
    )


def _at(suffixes: DataFrame, column: str, place: Column) -> DataFrame:
    """``suffixes`` with the rank of the suffix that stands at ``place``, if it has one."""
    there = suffixes.select(*[F.col(c).alias(f"{c}_") for c in DOC], F.col("pos").alias("pos_"), F.col("rank").alias(column))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in DOC]
    joined = suffixes.withColumn("place", place).join(there, [*same, F.col("place") == F.col("pos_")])
    return joined.drop("place", "pos_", *[f"{c}_" for c in DOC])


def _later_copies(suffixes: DataFrame, width: int) -> DataFrame:
    """(document, pos, need) of runs of ``width`` to 2 * width - 1 lines that are not
    the first of their interval."""
    due = suffixes.filter(F.col("need").between(width, 2 * width - 1))
    there = suffixes.select(
        *[F.col(c).alias(f"{c}_") for c in DOC], F.col("pos").alias("pos_"), F.col("rank").alias("end_rank")
    )
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in DOC]
    runs = stored(
        due.join(there, [*same, F.col("pos") + F.col("need") - width == F.col("pos_")]).select(
            *DOC, "pos", "need", "rank", "end_rank"
        ),
        "runs",
    )
    where = F.struct(*DOC, "pos")
    key = ["need", "rank", "end_rank"]
    first = stored(
        runs.groupBy(*key).agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "intervals",
    )
    return runs.join(first, key).filter(~where.eqNullSafe(F.col("first"))).select(*DOC, "pos", "need")


def _doubled(suffixes: DataFrame, width: int, cell_width: int) -> DataFrame:
    """The suffixes ranked by twice as many lines; those alone in their rank leave."""
    pairs = stored(_at(suffixes, "partner", F.col("pos") + width), "pairs")
    counts = pairs.groupBy("rank", "partner").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = stored(
        _before(counts, ["rank"], "partner", F.floor(F.col("partner") / cell_width)).select(
            "rank", "partner", (F.col("rank") + F.col("before")).alias("new_rank")
        ),
        "ranks",
    )
    joined = pairs.join(ranked, ["rank", "partner"])
    return joined.select(*DOC, "pos", F.col("new_rank").alias("rank"), "need")


def repeated_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, pos, need): later copies of repeated runs, by first line and
    number of lines. Runs that overlap add up to the longest ones."""
    if min_chars < 1:
        raise ValueError("min_chars must be 1 or more")
    repeated, count = repeated_lines(docs)
    cell_width = max(1, int(count**0.5))
    suffixes = stored(_with_need(repeated, min_chars), "suffixes")
    width, found = 1, None
    while True:
        longest = suffixes.agg(F.max("need")).first()[0]
        if longest is None or longest < width:
            break
        later = _later_copies(suffixes, width)
        found = later if found is None else found.unionByName(later)
        if longest < 2 * width:
            break
        suffixes = stored(_doubled(suffixes, width, cell_width), "suffixes")
        width *= 2
    if found is None:
        return suffixes.filter(F.lit(False)).select(*DOC, "pos", "need")
    return found


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` (doc_id, text, ...) without later copies of repeated line runs, and
    ``n_lines``, ``n_removed`` and ``n_runs`` (of the maximal runs removed).

    A run is one line or more with ``min_chars`` characters in all; the first copy, by
    doc_id (null first), text hash and place, stays, and copies may overlap. Lines are
    cut at line feeds and joined again by them; a text all of whose lines go becomes
    empty. A null text stays null, with no lines. Rows equal in doc_id and text are one
    document and get the same result. Same-named columns are replaced.
    """
    rest = [c for c in docs.columns if c not in ADDED]
    last = F.col("pos") + F.col("need") - 1
    line_numbers = (
        repeated_runs(docs, min_chars)
        .select(*DOC, F.explode(F.sequence("pos", last)).alias("line"))
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_set("line")).alias("_gone"))
        .select(F.col("doc_id").alias("doc_id_"), F.col("text_hash").alias("hash_"), "_gone")
    )
    removed = stored(line_numbers, "removed")
    total = removed.agg(F.coalesce(F.sum(F.size("_gone") + 1), F.lit(0))).first()[0]
    if total <= BROADCAST_LINES:
        removed = F.broadcast(removed)
    gone, lines = F.col("_gone"), F.split("text", "\n", -1)
    starts = F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) != x - 1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone)
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.xxhash64("text") == F.col("hash_"))
    joined = docs.select(*rest).join(removed, same, "left").withColumn("_lines", lines)
    return joined.select(
        *[F.col(c) if c != "text" else F.when(gone.isNull(), F.col("text")).otherwise(kept).alias("text") for c in rest],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed"),
        F.when(gone.isNull(), 0).otherwise(F.size(starts)).cast("long").alias("n_runs"),
    )
