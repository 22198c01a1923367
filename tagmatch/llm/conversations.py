"""Conversations repaired at the least cost: Knuth's lightest derivation over their rows.

A repaired conversation has role initials ``(s?(ua)+)?``. Deductions tell how far a
conversation is repaired: item (i, q) says that the first i rows have been edited so that
the initials of what is left lead the pattern to state q. A row is an axiom; together with
item (i, q) it deduces (i + 1, q') by keeping, reroling or deleting the row, and an
insertion deduces (i, q') from (i, q). Each deduction adds to a (cost, audit) pair, audit
being the initials of the edits. That function is superior and keeps order, so the agenda
pops items in order of (cost, audit), the first pop of an item is its lightest derivation,
and the work ends when the goal item is popped.

Very long conversations are cut into chunks by turn, 1,024 rows at most in one. A chunk
is solved on its own, from each state to each state, and the chunks of a conversation are
joined by the same agenda with the chunks' answers as axioms. One task thus sees a byte
per row of a conversation (the audit itself is as long), and its texts only as a stream.

Rows are in order of turn, nulls first, then role and text. A row's first fault counts:
blank (nothing but white space), duplicate (role and text occurred earlier in the
conversation), truncated (the last character but white space ends no sentence).

Defined results: a null role or text is one space; rows of null conv_id are a conversation;
rows without turn come first; repeated rows are duplicates, but for the first; roles count
by their first character, as it is written. Other columns are ignored, and an empty table
gives no rows. Turns are longs.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship
from tagmatch.sources.shared import stored

#: Turns of a segment, and rows of a chunk within it.
SEGMENT_TURNS, CHUNK_ROWS = 1024, 1024
#: Answers for chunks of at most this many rows are remembered by a task.
REMEMBERED = 16

# Costs of the edits, and the states of the pattern of initials.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
CHUNK = (
    "conv_id {id}, segment long, chunk int, facts string, ways array<struct<q: int, to: int, cost: long, audit: string>>, "
    "blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "first_turn long, last_turn long, turns long"
)

#: Initial of a row and whether it is truncated; None if it can only be deleted.
Row = tuple[str, bool] | None


def lightest(start: int, goals: frozenset, edges) -> dict[tuple[int, int], tuple[int, str, tuple]]:
    """Lightest derivations of the goal items, from (0, start), by an agenda.

    ``edges(i, q)`` yields (i', q', cost, audit) for each deduction from item (i, q). Ends
    when all goals are final, or nothing is left. Of each goal, the cost, the audit and
    its trail: the audit's length before the last deduction, and the trail up to there.
    """
    final: dict[tuple[int, int], tuple[int, str, tuple]] = {}
    pushed = count()
    agenda = [(0, "", next(pushed), 0, start, ())]
    missing = set(goals)
    while agenda and missing:
        cost, audit, _, i, q, trail = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final[i, q] = cost, audit, trail
        missing.discard((i, q))
        trail = len(audit), trail
        for j, to, more, edits in edges(i, q):
            if (j, to) not in final:
                heapq.heappush(agenda, (cost + more, audit + edits, next(pushed), j, to, trail))
    return {goal: final[goal] for goal in goals if goal in final}


def _row_edges(rows: tuple[Row, ...]):
    def edges(i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
        for initial in "ua":
            if initial in NEXT[q]:
                yield i, NEXT[q][initial], INSERT, "I"
        if i == len(rows):
            return
        yield i + 1, q, DELETE, "D"
        if rows[i] is None:
            return
        initial, cut = rows[i]
        extra = TRUNCATED if cut else 0
        if initial in NEXT[q]:
            yield i + 1, NEXT[q][initial], extra, "K"
        for other in "ua":
            if other in NEXT[q] and other != initial:
                yield i + 1, NEXT[q][other], REROLE + extra, "R"

    return edges


def _chunk_ways(rows: tuple[Row, ...]) -> tuple[tuple[int, int, int, str], ...]:
    ways = []
    for q in range(len(NEXT)):
        goals = frozenset((len(rows), to) for to in range(len(NEXT)))
        for (_, to), (cost, audit, _) in lightest(q, goals, _row_edges(rows)).items():
            ways.append((q, to, cost, audit))
    return tuple(ways)


_short_ways = lru_cache(maxsize=50_000)(_chunk_ways)


def chunk_ways(rows: tuple[Row, ...]) -> tuple[tuple[int, int, int, str], ...]:
    """(q, to, cost, audit): the lightest way through a chunk between any two states. Those
    of short chunks, which are much alike, are remembered."""
    return _short_ways(rows) if len(rows) <= REMEMBERED else _chunk_ways(rows)


def joined_ways(chunks: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[str]]:
    """Cost, and the audit of each chunk, of the lightest way through all of them."""
    end = len(chunks) + 1

    def edges(i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
        if i < len(chunks):
            for start, to, cost, audit in chunks[i]:
                if start == q:
                    yield i + 1, to, cost, audit
        elif i < end and q in FINAL:
            yield end, 0, 0, ""

    cost, audit, trail = lightest(0, frozenset({(end, 0)}), edges)[end, 0]
    starts: list[int] = []
    while trail:
        at, trail = trail
        starts.append(at)
    starts.reverse()  # where each chunk's audit begins, and the end
    return cost, [audit[a:b] for a, b in zip(starts, starts[1:])]


def edited_roles(audit: str, facts: str, q: int) -> tuple[list[tuple[int | None, str, str | None]], int]:
    """Edits of one chunk as (row or None, edit, new role or None), and the state after it."""
    edits, row = [], 0
    for edit in audit:
        role = None
        if edit == "K":
            q = NEXT[q][facts[row].lower()]
        elif edit in "RI":
            # Only one of u and a can follow, wherever an edit sets the role.
            initial = next(c for c in "ua" if c in NEXT[q])
            q, role = NEXT[q][initial], ROLES[initial]
        edits.append((None if edit == "I" else row, edit, role))
        row += edit != "I"
    return edits, q


class _Sorted(NamedTuple):
    conv_id: object
    segment: int
    earlier: bool
    turn: int | None
    initial: str
    blank: bool
    cut: bool
    key: bytes


def _fact(row: Row) -> str:
    """One letter per row: its initial, in capitals if truncated; - or = for any other
    initial, # for a row that can only be deleted."""
    if row is None:
        return "#"
    if row[0] not in ("s", "u", "a"):
        return "=" if row[1] else "-"
    return row[0].upper() if row[1] else row[0]


def fact_rows(facts: str) -> tuple[Row, ...]:
    return tuple(None if f == "#" else ("-", f == "=") if f in "-=" else (f.lower(), f.isupper()) for f in facts)


class _Chunk:
    """Facts of one chunk of one conversation, from its rows in order."""

    def __init__(self, conv_id: object, segment: int, number: int) -> None:
        self.place = (conv_id, segment, number)
        self.facts: list[str] = []
        self.initials: list[str] = []
        self.turns: list[int | None] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, row: _Sorted, duplicate: bool) -> None:
        fault = "blank" if row.blank else "duplicate" if duplicate else "truncated" if row.cut else None
        if fault:
            self.faults[fault] += 1
        dropped = fault in ("blank", "duplicate")
        self.facts.append(_fact(None if dropped else (row.initial, row.cut)))
        self.initials.append(row.initial)
        self.turns.append(row.turn)

    def values(self) -> tuple:
        facts = "".join(self.facts)
        turns = [t for t in self.turns if t is not None]
        ways = [dict(zip(("q", "to", "cost", "audit"), way)) for way in chunk_ways(fact_rows(facts))]
        return (
            *self.place,
            facts,
            ways,
            *self.faults.values(),
            sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:])),
            self.initials[0],
            self.initials[-1],
            min(turns, default=None),
            max(turns, default=None),
            len(set(turns)),
        )


# Fixed value: initials that may follow each other.
LEGAL = ("su", "ua", "au")


def _chunks(rows: Iterable[_Sorted]) -> Iterator[_Chunk]:
    """Chunks of rows that come by conversation and segment, earlier keys first."""
    chunk, place, seen = None, None, set()
    for row in rows:
        if (row.conv_id, row.segment) != place:
            if chunk:
                yield chunk
            chunk, place, seen = None, (row.conv_id, row.segment), set()
        if row.earlier:
            seen.add(row.key)
            continue
        if chunk and len(chunk.facts) == CHUNK_ROWS:
            yield chunk
            chunk = _Chunk(*place, chunk.place[2] + 1)
        chunk = chunk or _Chunk(*place, 0)
        chunk.add(row, row.key in seen)
        seen.add(row.key)
    if chunk:
        yield chunk


def _rows(batches: Iterable[pa.RecordBatch], kind: type) -> Iterator:
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            yield kind(*row)


def _packer(schema: pa.Schema, limit: int = 4 << 20):
    """Collects rows into batches of some size."""

    def pack(rows: Iterable[tuple[tuple, int]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row, weight in rows:
            held.append(row)
            size += weight + 100
            if size > limit:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return pack


def _chunk_maker(schema: pa.Schema):
    pack = _packer(schema)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pack((c.values(), 17 * len(c.facts)) for c in _chunks(_rows(batches, _Sorted))):
            yield batch

    return make


class _Solved(NamedTuple):
    conv_id: object
    segment: int
    chunk: int
    facts: str
    ways: list
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str
    first_turn: int | None
    last_turn: int | None
    turns: int


def _summary(chunks: list[_Solved]) -> tuple[tuple, list[str]]:
    """(gaps, blank, duplicate, truncated, illegal, cost) of a conversation, audit per chunk."""
    borders = list(zip(chunks, chunks[1:]))
    illegal = sum(c.illegal for c in chunks) + sum(a.last + b.first not in LEGAL for a, b in borders)
    with_turns = [c for c in chunks if c.first_turn is not None]
    gaps = 0
    if with_turns:
        shared = sum(a.last_turn == b.first_turn for a, b in zip(with_turns, with_turns[1:]))
        turns = sum(c.turns for c in with_turns) - shared
        gaps = min(with_turns[-1].last_turn - with_turns[0].first_turn + 1 - turns, 2**63 - 1)
    faults = [sum(getattr(c, name) for c in chunks) for name in ("blank", "duplicate", "truncated")]
    ways = [[(w["q"], w["to"], w["cost"], w["audit"]) for w in c.ways] for c in chunks]
    cost, audits = joined_ways(ways)
    return (gaps, *faults, illegal, cost), audits


def _joiner(schema: pa.Schema):
    """Function that solves conversations from their chunks, which come in order."""
    pack = _packer(schema)

    def solved(rows: Iterable[_Solved]) -> Iterator[tuple[tuple, int]]:
        for conv_id, chunks in _by_conversation(rows):
            counts, audits = _summary(chunks)
            q = 0
            for chunk, audit in zip(chunks, audits):
                yield (conv_id, chunk.segment, chunk.chunk, chunk.facts, audit, q, *counts), 2 * len(audit)
                q = edited_roles(audit, chunk.facts, q)[1]

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack(solved(_rows(batches, _Solved)))

    return join


def _by_conversation(rows: Iterable) -> Iterator[tuple[object, list]]:
    held: list = []
    for row in rows:
        if held and held[-1].conv_id != row.conv_id:
            yield held[0].conv_id, held
            held = []
        held.append(row)
    if held:
        yield held[0].conv_id, held


class _Text(NamedTuple):
    conv_id: object
    segment: int
    kind: int
    chunk: int | None
    facts: str | None
    audit: str | None
    q: int | None
    role: str | None
    text: str | None


def _repairer(schema: pa.Schema):
    """Function that edits rows; the edits of each segment come before its rows."""
    pack = _packer(schema)

    def repaired(rows: Iterable[_Text]) -> Iterator[tuple[tuple, int]]:
        place, edits, at, position, conversation = None, [], 0, 0, object()
        for row in rows:
            if (row.conv_id, row.segment) != place:
                place, edits, at = (row.conv_id, row.segment), [], 0
                if row.conv_id != conversation:
                    conversation, position = row.conv_id, 0
            if row.kind == 0:
                edits += edited_roles(row.audit, row.facts, row.q)[0]
            else:
                _, edit, role = edits[at]
                at += 1
                if edit != "D":
                    yield (row.conv_id, position, edit, role or row.role, row.text), len(row.text)
                    position += 1
            while at < len(edits) and edits[at][0] is None:
                yield (row.conv_id, position, "I", edits[at][2], ""), 20
                at, position = at + 1, position + 1

    def repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack(repaired(_rows(batches, _Text)))

    return repair


def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


class Repaired(NamedTuple):
    """conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    rows: conv_id, position, edit (K, R or I), role, text; whole conversations lie in one
    partition in order of position."""

    conversations: DataFrame
    rows: DataFrame


def _facts(rows: DataFrame) -> DataFrame:
    """The columns of ``_Sorted`` and the text; segments are numbered by turn."""
    visible = F.rtrim(F.col("text"), F.lit(WHITE))
    least = F.lit(-(2**62))
    end = F.right(visible, F.lit(1))
    return rows.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / F.lit(SEGMENT_TURNS)).cast("long"), least).alias("segment"),
        F.lit(False).alias("earlier"),
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        (visible == "").alias("blank"),
        (~end.isin(".", "!", "?")).alias("cut"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("key"),
        "role",
        "text",
    )


def _seen_in_earlier_segments(facts: DataFrame) -> DataFrame:
    """(conv_id, segment, key) of texts that an earlier segment of the conversation holds.

    Short conversations lie in one segment and give nothing here.
    """
    places = facts.select("conv_id", "segment", "key").distinct()
    first = places.groupBy("conv_id", "key").agg(F.min("segment").alias("first"), F.max("segment").alias("latest"))
    repeated = first.filter("first < latest").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    met = places.join(repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")))
    return met.filter("segment > first").select("conv_id", "segment", "key")


def repair(conversations: DataFrame) -> Repaired:
    """Repair every conversation of (conv_id, turn, role, text) at the least cost."""
    spark = conversations.sparkSession
    ship(spark)
    id_type = conversations.schema["conv_id"].dataType
    kind = id_type.simpleString()
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"), _or_space("text").alias("text")
    )
    facts = _facts(rows)
    earlier = _seen_in_earlier_segments(facts).select(
        "conv_id",
        "segment",
        F.lit(True).alias("earlier"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("initial"),
        F.lit(False).alias("blank"),
        F.lit(False).alias("cut"),
        "key",
        F.lit("").alias("role"),
        F.lit("").alias("text"),
    )
    order = ["conv_id", "segment", F.desc("earlier"), "turn", "role", "text"]
    dealt = facts.unionByName(earlier).repartition("conv_id", "segment").sortWithinPartitions(*order)
    chunk_schema = CHUNK.format(id=kind)
    arrow = _arrow_schema(spark, chunk_schema)
    chunks = dealt.select(*_Sorted._fields).mapInArrow(_chunk_maker(arrow), chunk_schema)

    solved_schema = (
        f"conv_id {kind}, segment long, chunk int, facts string, audit string, q int, "
        + ", ".join(f"{name} long" for name in (*COUNTS, "cost"))
    )
    by_conversation = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "chunk")
    solved = stored(
        by_conversation.mapInArrow(_joiner(_arrow_schema(spark, solved_schema)), solved_schema), "conversations"
    )
    parts = F.array_sort(F.collect_list(F.struct("segment", "chunk", "audit")))
    summary = solved.groupBy("conv_id", *COUNTS, "cost").agg(F.array_join(parts["audit"], "").alias("audit"))

    edits = solved.select(
        "conv_id", "segment", F.lit(0).alias("kind"), "chunk", "facts", "audit", "q",
        F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
    )
    texts = facts.select(
        "conv_id", "segment", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("chunk"),
        *[F.lit(None).cast("string").alias(name) for name in ("facts", "audit")],
        F.lit(None).cast("int").alias("q"), "turn", "role", "text",
    )
    ordered = (
        edits.unionByName(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment", "kind", "chunk", "turn", "role", "text")
    )
    row_schema = f"conv_id {kind}, position long, edit string, role string, text string"
    repaired = ordered.select(*_Text._fields).mapInArrow(_repairer(_arrow_schema(spark, row_schema)), row_schema)
    return Repaired(summary, repaired)


def _arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _digester(schema: pa.Schema):
    pack = _packer(schema)

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        conv_id, digest = None, None
        for batch in batches:
            names = (batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))
            for found, role, text in zip(*names):
                if digest is None or found != conv_id:
                    if digest is not None:
                        yield (conv_id, digest.hexdigest()), 64
                    conv_id, digest = found, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if digest is not None:
            yield (conv_id, digest.hexdigest()), 64

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack(digests(batches))

    return make


def with_digests(repaired: Repaired) -> DataFrame:
    """The conversations with ``repaired_sha256``, the hash of their repaired ``role:text``
    lines; those without rows have the hash of an empty text."""
    spark = repaired.rows.sparkSession
    schema = f"d_conv_id {repaired.rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    digests = repaired.rows.mapInArrow(_digester(_arrow_schema(spark, schema)), schema)
    joined = repaired.conversations.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv_id")), "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(
        *repaired.conversations.columns, F.coalesce("repaired_sha256", empty).alias("repaired_sha256")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by a hash of conversation and turn: a
    row in twenty is dropped, emptied, left without sentence ends, repeated or given the
    role of the user. Nulls in role and text become one space."""
    case = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    text = _or_space("text")
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(case == 4, F.lit("user")).otherwise(_or_space("role")).alias("role"),
        F.when(case == 1, F.lit("")).when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("copies"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return rows.withColumn("copy", copies).drop("copy", "copies")
