"""Hard negatives by the threshold algorithm over sorted lists per dimension.

Vectors are scaled to integers, and a row's score is its integer product with an anchor.
Rows are dealt to bands and anchors to blocks; a task meets one block with one band and
reads the band as a stream of lists: per dimension, the rows in order of their component.
For an anchor, each list is read from its best end, the top where the anchor's component
is positive and the bottom where it is negative. A row met in any list is scored in full
by random access. The threshold is the score that a row would have with the component at
the cursor of every list: no row not yet met scores more. Reading stops when it is
strictly below the kth score of every window, so rows that tie with the kth are met too.

A first pass finds the positives of each anchor, a second one the negatives in the window
that each positive's score opens. Both keep a few rows per anchor and band.

Defined results: rows without vec_id, label, vector or with a null or non-finite component
take no part. Shorter vectors count as if filled up with zeros. Wholly repeated rows count
once; rows that share a vec_id and differ are rows of their own, but no positives or
negatives of each other. Scaled components are held within the bounds in which a score
fits a long, 3.8e8 at 64 dimensions. Other columns are ignored; an empty table, or one
without anchors, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship
from tagmatch.sources.shared import stored

#: Anchors that meet a band at once, and rows of a band; there are MIN_BANDS at least.
BLOCK_ANCHORS, BAND_ROWS, MIN_BANDS = 8192, 1 << 20, 24
#: Cells of blocks and bands are dealt to so many tasks at most.
MAX_TASKS = 20_000
#: Depth to which lists are read at first; from there it grows by STEP times.
FIRST_DEPTH, STEP = 16, 4

_LONG_MAX = 2**63 - 1
_FOUND = "anchor_key long, anchor_id long, base long, other_id long, score long"
_FOUND_SCHEMA = pa.schema([(n.split()[0], pa.int64()) for n in _FOUND.split(", ")])


def scaled(vector: Column, factor: int, bound: int) -> Column:
    """Components times ``factor``, rounded down, within +-``bound``."""

    def whole(x: Column) -> Column:
        value = F.floor(F.greatest(F.least(x.cast("double") * factor, F.lit(float(bound))), F.lit(-float(bound))))
        return value.cast("int")

    return F.transform(vector, whole)


def _taking_part(vectors: DataFrame) -> DataFrame:
    def finite(x: Column) -> Column:
        value = x.cast("double")
        return x.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(math.inf))

    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return vectors.select("vec_id", "label", "embedding").filter(named & F.forall("embedding", finite))


class _Block:
    """Rows of one band with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        self.ids, self.labels, self.matrix = ids, labels, matrix
        self.order = np.argsort(matrix, axis=0, kind="stable")
        self.sorted = np.take_along_axis(matrix, self.order, axis=0)
        n = len(ids)
        depths, depth = [0], FIRST_DEPTH
        while depth < n:
            depths.append(depth)
            depth *= STEP
        self.depths = depths

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """Per depth and anchor, the most that a row not met so far can score."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        n = len(self.ids)
        return np.stack([up @ self.sorted[n - 1 - d] + down @ self.sorted[d] for d in self.depths])

    def search(self, anchor: np.ndarray, thresholds: np.ndarray, search: _Search) -> None:
        """Sorted access by growing depth until no row not yet met can matter."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(n, bool)
        for step, depth in enumerate(self.depths):
            if thresholds[step] < search.least():
                return
            end = self.depths[step + 1] if step + 1 < len(self.depths) else n
            if end == n or len(up) + len(down) == 0:
                fresh = np.flatnonzero(~seen)  # the lists are read to their ends
            else:
                met = np.zeros(n, bool)
                met[self.order[n - end : n - depth, up]] = True
                met[self.order[depth:end, down]] = True
                fresh = np.flatnonzero(met & ~seen)
            seen[fresh] = True
            if len(fresh):
                search.offer(self.ids[fresh], self.labels[fresh], self.matrix[fresh] @ anchor)
            if seen.all():
                return


class _Search:
    """What one anchor looks for in one band: the best rows of each window."""

    def __init__(self, key: int, vec_id: int, label: int, windows: list[tuple[int, int, int]], same: bool, k: int) -> None:
        self.key, self.vec_id, self.label, self.same, self.k = key, vec_id, label, same, k
        self.windows = windows  # (base, low, high)
        empty = np.zeros(0, np.int64)
        self.best = [(empty, empty) for _ in windows]
        self._least = min((low for _, low, _ in windows), default=_LONG_MAX)

    def least(self) -> int:
        """A score below which nothing is wanted: the lowest of the windows' kth scores, or
        the low bound of a window that is not full."""
        return self._least

    def offer(self, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        wanted = (labels == self.label) == self.same
        wanted &= (ids != self.vec_id) & (scores >= self._least)
        if not wanted.any():
            return
        ids, scores = ids[wanted], scores[wanted].astype(np.int64)
        least = []
        for w, (_, low, high) in enumerate(self.windows):
            inside = (scores >= low) & (scores <= high)
            if inside.any():
                all_scores = np.concatenate([self.best[w][0], scores[inside]])
                all_ids = np.concatenate([self.best[w][1], ids[inside]])
                first = np.lexsort((all_ids, -all_scores))[: self.k]
                self.best[w] = all_scores[first], all_ids[first]
            held = self.best[w][0]
            least.append(int(held[-1]) if len(held) == self.k else low)
        self._least = min(least)

    def found(self) -> Iterator[tuple[int, int, int, int, int]]:
        for (base, _, _), (scores, ids) in zip(self.windows, self.best):
            for score, other in zip(scores.tolist(), ids.tolist()):
                yield self.key, self.vec_id, base, other, score


def _matrix(column: pa.Array, width: int, kind: np.dtype) -> np.ndarray:
    """Rows of lists, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    start = column.offsets[0].as_py()
    flat = column.values.to_numpy(zero_copy_only=False)[start : start + int(lengths.sum())]
    matrix = np.zeros((len(column), width), kind)
    matrix[np.repeat(np.arange(len(column)), lengths), _ranges(lengths)] = flat
    return matrix


def _ranges(lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.arange(int(lengths.sum())) - np.repeat(ends - lengths, lengths)


def _number_kind(width: int, most: int) -> np.dtype:
    """Doubles where every sum of products is exact in them, else longs."""
    return np.dtype("float64") if width * most * most < 2**53 else np.dtype("int64")


def _not_repeated(cell: np.ndarray, batch: dict[str, np.ndarray], matrix: np.ndarray, before: list) -> np.ndarray:
    """Rows that differ from the one before them; ``before`` holds the last row of all."""
    same = np.zeros(len(cell), bool)
    columns = [cell, batch["kind"], batch["label"], batch["vec_id"]]
    same[1:] = np.all([c[1:] == c[:-1] for c in columns], axis=0) & (matrix[1:] == matrix[:-1]).all(axis=1)
    first = [int(c[0]) for c in columns]
    if before and before[0] == first and (before[1] == matrix[0]).all():
        same[0] = True
    before[:] = [[int(c[-1]) for c in columns], matrix[-1].copy()]
    return ~same


def _miner(width: int, most: int, k: int, same: bool, low: int, high: int):
    """Function that searches cells: of each, the anchors come first, then the rows."""
    kind = _number_kind(width, most)

    def windows(bases: list[int] | None) -> list[tuple[int, int, int]]:
        if same:
            return [(0, -_LONG_MAX - 1, _LONG_MAX)]
        bounds = ((base, -(-low * base // 100), high * base // 100) for base in sorted(set(bases or [])))
        return [(base, least, most) for base, least, most in bounds if least <= most]

    def mine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, searches, vectors = None, [], np.zeros((0, width), kind)
        before: list = []

        def found() -> Iterator[pa.RecordBatch]:
            rows = [row for search in searches for row in search.found()]
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.record_batch(columns, schema=_FOUND_SCHEMA)

        for batch in batches:
            if not len(batch):
                continue
            numbers = {n: batch.column(n).to_numpy() for n in ("cell", "kind", "label", "vec_id", "anchor_key")}
            matrix = _matrix(batch.column("q"), width, kind)
            bases = batch.column("bases")
            kept = _not_repeated(numbers["cell"], numbers, matrix, before)
            cuts = np.flatnonzero(np.diff(numbers["cell"]) | np.diff(numbers["kind"])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)]):
                if numbers["cell"][start] != cell:
                    yield from found()
                    cell, searches, vectors = numbers["cell"][start], [], np.zeros((0, width), kind)
                part = np.arange(start, end)[kept[start:end]]
                if not len(part):
                    continue
                if numbers["kind"][start] == 0:
                    vectors = np.concatenate([vectors, matrix[part]])
                    keys = zip(*(numbers[n][part].tolist() for n in ("anchor_key", "vec_id", "label")))
                    searches += [
                        _Search(*key, windows(bases[i].as_py()), same, k) for key, i in zip(keys, part.tolist())
                    ]
                elif searches:
                    block = _Block(numbers["vec_id"][part], numbers["label"][part], matrix[part])
                    thresholds = block.thresholds(vectors)
                    held = set(np.unique(block.labels).tolist())
                    for n, search in enumerate(searches):
                        if search.windows and not (same and search.label not in held):
                            block.search(vectors[n], thresholds[:, n], search)
        yield from found()

    return mine


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    factor: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, positive_score, rank, negative_id,
    negative_score): the best negatives of each anchor and positive.

    ``vectors`` holds vec_id, label and embedding; ``is_anchor`` is a condition on vec_id.
    The positives are the best rows of the anchor's label. The negatives of a positive are
    the best rows of other labels that score from ``low`` to ``high`` hundredths of it. Of
    equal scores the lower vec_id comes first.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = _taking_part(vectors)
    anchor = F.coalesce(is_anchor, F.lit(False))
    size = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(anchor).alias("anchors"), F.max(F.size("embedding")).alias("width")
    ).first()
    width = max(size["width"] or 1, 1)
    bound = min(math.isqrt(_LONG_MAX // width), 2**31 - 1)
    q = scaled(F.col("embedding"), factor, bound)
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), q.alias("q"))
    most = rows.agg(F.max(F.greatest(F.array_max("q"), -F.array_min("q"))).alias("most")).first()["most"] or 0

    blocks = max(1, math.ceil(size["anchors"] / BLOCK_ANCHORS))
    bands = max(MIN_BANDS, math.ceil(size["rows"] / BAND_ROWS))
    cell = (F.col("block") * bands + F.col("band")).cast("long")
    tasks = min(blocks * bands, MAX_TASKS)
    anchors = rows.filter(anchor).withColumn("anchor_key", F.xxhash64("vec_id", "label", "q"))

    def upto(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def place(n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")

    def mined(anchors: DataFrame, k: int, same: bool) -> DataFrame:
        left = anchors.select("*", place(blocks, 1).alias("block"), upto(bands).alias("band"), F.lit(0).alias("kind"))
        right = rows.select(
            "*",
            F.lit(0).cast("long").alias("anchor_key"),
            F.lit(None).cast("array<long>").alias("bases"),
            place(bands, 2).alias("band"),
            upto(blocks).alias("block"),
            F.lit(1).alias("kind"),
        )
        columns = [cell.alias("cell"), "kind", "label", "vec_id", "anchor_key", "bases", "q"]
        cells = left.select(*columns).unionByName(right.select(*columns))
        dealt = cells.repartitionById(tasks, (F.col("cell") % tasks).cast("int"))
        ordered = dealt.sortWithinPartitions("cell", "kind", "label", "vec_id", "q")
        return ordered.mapInArrow(_miner(width, most, k, same, low, high), _FOUND)

    found = mined(anchors.withColumn("bases", F.lit(None).cast("array<long>")), positives, True)
    best = stored(_best(found, ["anchor_key", "anchor_id"], positives), "positives").select(
        "anchor_key",
        "anchor_id",
        F.col("other_id").alias("positive_id"),
        F.col("rank").alias("positive_rank"),
        F.col("score").alias("positive_score"),
    )
    bases = best.groupBy("anchor_key").agg(F.collect_set("positive_score").alias("bases"))
    found = mined(anchors.join(bases, "anchor_key"), negatives, False)
    kept = _best(found, ["anchor_key", "base"], negatives).select(
        "anchor_key",
        F.col("base").alias("positive_score"),
        "rank",
        F.col("other_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return best.join(kept, ["anchor_key", "positive_score"]).select(
        "anchor_id", "positive_id", "positive_rank", "positive_score", "rank", "negative_id", "negative_score"
    )
