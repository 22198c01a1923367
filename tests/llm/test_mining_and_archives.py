"""Hard negatives, conversation repair and WARC archives against plain Python."""

import base64
import gzip
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tagmatch.llm import conversations, hard_negatives, queries, warc
from tests.conftest import TESTDATA
from tests.llm import brute_repair


def write(spark, tmp_path, name, rows, schema):
    frame = spark.createDataFrame(rows, schema).withColumn("cell", F.lit("mine")).withColumn("score", F.lit(1))
    frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# Hard negatives


def negatives_by_brute_force(rows):
    """Rows of the query, from (vec_id, embedding, label)."""
    bound, taking = None, []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taking.append((vec_id, tuple(vector), (label + 1) % 10 if vec_id % 7 == 0 else label))
    taking = sorted(set(taking))
    width = max((len(v) for _, v, _ in taking), default=0)
    bound = math.isqrt((2**63 - 1) // max(width, 1))
    items = [
        (i, [max(-bound, min(bound, math.floor(max(min(256 * x, 1e30), -1e30)))) for x in v], label)
        for i, v, label in taking
    ]
    out = []
    for a, vector, label in items:
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, w)), i, own) for i, w, own in items if i != a]
        for score, p, _ in sorted(s for s in scored if s[2] == label)[:5]:
            base = -score
            wanted = sorted(s for s in scored if s[2] != label and 30 * base <= -100 * s[0] <= 90 * base)
            out += [(a, p, rank, n, base, -s) for rank, (s, n, _) in enumerate(wanted[:10], 1)]
    return sorted(out)


def mined(spark, sf_dir):
    frame = queries.op11_hard_negatives(spark, sf_dir)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(row[n] for n in names) for row in frame.collect())


VECTORS = "vec_id long, embedding array<float>, label int"


def test_hard_negatives_of_random_and_awkward_vectors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "MIN_BANDS", 5)
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0.3, 1) for _ in range(6)], draw.randrange(3)) for i in range(0, 1000, 4)]
    rows += [(10_000 + i, [0.5, 0.25, 0.5, 0.0, 0.0, 0.0], i % 2) for i in range(120)]  # ties
    rows += rows[:30]  # repeated rows
    rows += [(20_000, [0.0] * 6, 1), (20_100, [], 1), (20_200, [1.0, 2.0], 2), (-700, [1.0] * 6, 9), (0, [2.0], 1)]
    rows += [(None, [1.0] * 6, 1), (30_000, None, 1), (30_100, [1.0] * 6, None), (30_200, [1.0, None], 1)]
    rows += [(30_300, [math.nan] * 6, 1), (30_400, [math.inf] * 6, 1)]
    sf_dir = write(spark, tmp_path, "embeddings", rows, VECTORS)
    got = [row for row in mined(spark, sf_dir) if row[0] != 0]
    assert got == [row for row in negatives_by_brute_force(rows) if row[0] != 0]
    assert len(got) > 100


def test_hard_negatives_with_very_large_components(spark, tmp_path):
    rows = [(i, [3e38 if i % 3 else -1e6, float(i), 1e5], i % 2) for i in range(0, 600, 50)]
    sf_dir = write(spark, tmp_path, "embeddings", rows, VECTORS)
    assert mined(spark, sf_dir) == negatives_by_brute_force(rows)


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)]])
def test_hard_negatives_without_rows_partners_or_anchors(spark, tmp_path, rows):
    assert mined(spark, write(spark, tmp_path, "embeddings", rows, VECTORS)) == []


def test_reading_of_lists_stops_before_their_ends():
    """Where few rows stand out, most are never scored."""
    import numpy as np

    matrix = np.ones((5000, 4)) + np.arange(5000)[:, None]
    matrix[:20] += 100_000
    block = hard_negatives._Block(np.arange(5000), np.zeros(5000, int), matrix)
    scored = []

    class Counting(hard_negatives._Search):
        def offer(self, ids, labels, scores):
            scored.extend(ids)
            super().offer(ids, labels, scores)

    search = Counting(1, -1, 0, [(0, -(2**62), 2**62)], True, 5)
    anchor = np.array([1.0, 2.0, 1.0, 3.0])
    block.search(anchor, block.thresholds(anchor[None, :])[:, 0], search)
    assert [r[3] for r in search.found()] == [19, 18, 17, 16, 15]
    assert len(scored) < 200


# Conversations


def repaired(spark, sf_dir):
    frame = queries.op12_conversations(spark, sf_dir)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


TALK = "conv_id long, turn long, role string, text string"
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", "util", None]
TEXTS = ["One.", "Two!", "Three? ", "cut", " \t\n", "", None, "x ", "é.\x0b", "A" * 300 + "."]


def conversation(conv_id, length, seed, turns=None):
    draw = random.Random(seed)
    return [_row(draw, conv_id, draw.choice(turns) if turns else i) for i in range(length)]


def _row(draw, conv_id, turn):
    text = draw.choice(TEXTS)
    if text is not None and draw.random() < 0.5:
        text = f"{draw.randrange(1000)} {text}"
    return conv_id, turn, draw.choice(ROLES), text


def test_conversations_are_repaired_at_the_least_cost(spark, tmp_path):
    rows = [r for i in range(150) for r in conversation(i, i % 4, i)]
    want = {}
    for i in range(150):
        want |= brute_repair.repaired([r for r in rows if r[0] == i], brute_repair.best_by_trying) if i < 60 else {}
    by_table = brute_repair.repaired(rows)
    assert all(by_table[i] == want[i] for i in want)  # the two ways of the test agree
    rows += [r for i in range(200, 400) for r in conversation(i, i % 13, i, turns=[None, 1, 2, 2, 5, 9, -3])]
    rows += conversation(None, 9, 3) + conversation(-5, 7, 4) + rows[:10]
    sf_dir = write(spark, tmp_path, "conversations", rows, TALK)
    assert repaired(spark, sf_dir) == brute_repair.repaired(rows)


def test_long_conversations_are_solved_by_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT_TURNS", 8)
    rows = [r for i in range(30) for r in conversation(i, 60, i)]
    rows += conversation(77, 40, 9, turns=[None, 3, 8, 9, 20, -8, 2**40]) + [(78, 1, "user", "x")] * 500
    rows += conversation(79, 2500, 10, turns=[5])
    sf_dir = write(spark, tmp_path, "conversations", rows, TALK)
    assert repaired(spark, sf_dir) == brute_repair.repaired(rows)


def test_cutting_into_chunks_does_not_change_the_answer():
    draw = random.Random(1)
    for _ in range(300):
        facts = "".join(draw.choice("suaSUA-=#") for _ in range(draw.randrange(1, 14)))
        rows = conversations.fact_rows(facts)
        cost, audits = conversations.joined_ways([list(conversations.chunk_ways(rows))])
        cuts = sorted(draw.sample(range(1, len(rows)), min(len(rows) - 1, draw.randrange(4))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        split_cost, split = conversations.joined_ways([list(conversations.chunk_ways(p)) for p in parts])
        assert (split_cost, "".join(split)) == (cost, audits[0]), (facts, cuts)


def test_conversations_of_an_empty_table(spark, tmp_path):
    assert repaired(spark, write(spark, tmp_path, "conversations", [], TALK)) == {}


def test_conversations_of_the_test_table(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert repaired(spark, sf_dir) == brute_repair.repaired(rows)


def test_repaired_rows_tell_their_edits(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "assistant", "B."), (2, 0, "user", "cut")]
    found = conversations.repair(spark.createDataFrame(rows, TALK))
    got = sorted((r.conv_id, r.position, r.edit, r.role, r.text) for r in found.rows.collect())
    assert got == [(1, 0, "R", "user", "A."), (1, 1, "K", "assistant", "B.")]
    assert {r.conv_id: (r.cost, r.audit) for r in found.conversations.collect()} == {1: (1, "RK"), 2: (2, "D")}


# Archives


def archived_by_brute_force(rows):
    out, groups = [], {}
    for page_id, url, html in rows:
        groups.setdefault(html or "", []).append((page_id, url))
    for html, pages in groups.items():
        payload = html.encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        pages.sort(key=lambda p: (p[0] is not None, p[0] or 0), reverse=True)
        for n, (page_id, _) in enumerate(pages):
            kind = ("revisit", pages[0][0]) if n else ("response", None)
            out.append((page_id, len(payload), digest, *kind))
    return sorted(out, key=repr)


def archived(spark, sf_dir):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in queries.op13_warc(spark, sf_dir).collect()), key=repr)


PAGES = "page_id long, url string, html string"
AWKWARD_PAGES = [
    (1, "http://a/", "x"), (2, "http://b/", "x"), (2, "http://b/", "x"), (3, None, None), (4, "", ""),
    (None, "http://n/", "x"), (None, None, "alone"), (5, "http://ü/ \r\nX-Page-ID: 9", "é😀\r\n\r\nWARC/1.1\r\n"),
    (6, "u", "\x00" * 10), (7, "u", "long " * 400_000), (-8, "u", "long " * 400_000),
]


@pytest.mark.parametrize("hot_copies", [1000, 1])
def test_archives_give_every_page_back(spark, tmp_path, monkeypatch, hot_copies):
    monkeypatch.setattr(warc, "HOT_COPIES", hot_copies)
    rows = AWKWARD_PAGES + [(100 + i, f"http://h/{i}", "same" if i % 3 == 0 else f"page {i % 200}") for i in range(600)]
    sf_dir = write(spark, tmp_path, "pages", rows, PAGES)
    assert archived(spark, sf_dir) == archived_by_brute_force(rows)


def test_archives_of_an_empty_table(spark, tmp_path):
    assert archived(spark, write(spark, tmp_path, "pages", [], PAGES)) == []


def test_selected_records_are_read_by_their_ranges(spark):
    rows = [(i, f"http://h/{i}", f"page {i}" * (i % 50)) for i in range(400)]
    index = warc.write_archives(spark.createDataFrame(rows, PAGES), archive_bytes=3000)
    entries = index.collect()
    assert len({e.archive for e in entries}) > 5
    for entry in entries[:20]:  # the index alone finds a record
        with open(entry.archive.removeprefix("file://").removeprefix("file:"), "rb") as file:
            file.seek(entry.offset)
            record = gzip.decompress(file.read(entry.length))
        assert record.startswith(b"WARC/1.1\r\n") and f"X-Page-ID: {entry.page_id}\r\n".encode() in record
    got = warc.read_records(index.filter("page_id % 7 = 3 AND record_type = 'response'")).collect()
    want = {e.page_id for e in entries if e.page_id % 7 == 3 and e.record_type == "response"}
    assert {r.page_id for r in got} == want
    assert all(bytes(r.payload).decode() == rows[r.page_id][2] and r.url == rows[r.page_id][1] for r in got)


def test_whole_archives_unpack_as_records_in_a_row(spark):
    index = warc.write_archives(spark.createDataFrame(AWKWARD_PAGES, PAGES))
    for archive in {e.archive for e in index.collect()}:
        with open(archive.removeprefix("file://").removeprefix("file:"), "rb") as file:
            data, records = file.read(), 0
        while data:
            unpacker = zlib.decompressobj(31)
            head, _, rest = unpacker.decompress(data).partition(b"\r\n\r\n")
            size = int(head.split(b"Content-Length: ")[-1])
            assert rest[size:] == b"\r\n\r\n"
            data, records = unpacker.unused_data, records + 1
        assert records > 1  # one of them describes the archive


def test_a_changed_archive_is_noticed(spark):
    index = warc.write_archives(spark.createDataFrame([(1, "u", "page")], PAGES))
    wrong = index.withColumn("digest", F.lit("A" * 32))
    with pytest.raises(Exception, match="not that of the index"):
        warc.read_records(wrong).collect()


def test_runs_join_near_ranges_only():
    entry = warc._Entry
    places = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.MAX_GAP, 5), ("a", 26 + 2 * warc.MAX_GAP, 5), ("b", 0, 5)]
    runs = list(warc._runs(entry(a, o, n, None, "") for a, o, n in places))
    assert [len(run) for run in runs] == [3, 1, 1]
    long = [entry("a", i * warc.MAX_READ // 2, warc.MAX_READ // 2, None, "") for i in range(5)]
    assert [len(run) for run in warc._runs(long)] == [2, 2, 1]
