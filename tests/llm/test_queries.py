"""The registered queries against their contracts, on awkward tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagmatch.llm import queries
from tests.llm import brute
from tests.llm.test_operators import AWKWARD, TOKENIZER, noise
from tests.oracle_check import duckdb_rows, spark_rows

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short ITEM here"), (3, "lonely"), (4, None), (5, "..."), (None, "an item that has no id of its own"),
    (6, "one two three four five six seven eight nine ten other words"), (10, "short item HERE"),
    (11, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
]


def documents():
    rng = random.Random(11)
    vocabulary = [noise(i, "abcdefghijklm", 3 + i % 6) for i in range(300)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, rows = ITEMS[0][1].split(), []
    for i in range(20, 50):
        text = words(rng.randrange(5, 120))
        rows.append((i, " ".join(text)))
        text[len(text) // 2] = "changed"
        rows.append((100 + i, " ".join(text)))
    long_line = " ".join(words(60))
    rows += [
        (200, " ".join(words(9) + passage + words(9))), (201, " ".join(words(4) + passage[:5] + ["new"] + passage[5:])),
        (202, "a Short, item\nHERE lonely"), (203, " ".join(passage[:4] + words(12) + passage[4:])),
        (204, ITEMS[-1][1]), (205, "alpha beta so beta gamma"), (206, " and ".join([ITEMS[-1][1][11:]] * 3)),
        (210, "Mail a.b+c@x-y.example.org, 1.2.3.4 or 300.1.1.1; card 4111 1111 1111 1111, +1 (555) 555-0199. é a@b.co"),
        (211, "\n".join([long_line, "x", long_line, "", "", "x"])), (212, f"é{long_line} 😀 {long_line}"),
        (213, "again and again we say this " * 30), (214, "# * $ % & | < >" * 4), (215, long_line),
    ]
    return rows + AWKWARD


DOCUMENTS = documents()


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("awkward")
    labels = [(i, int(i % 3 == 0)) for i in range(20, 50)] + [(None, 1), (21, None)]
    for name, rows, schema in (
        ("documents", DOCUMENTS, "doc_id long, text string"),
        ("benchmark", ITEMS, "item_id long, text string"),
        ("labels", labels, "doc_id long, toxic int"),
    ):
        spark.createDataFrame(rows, schema).withColumns(
            {"lang": F.lit(None).cast("string"), "extra": F.lit(1), "size": F.lit("mine")}
        ).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def by_document(rows, columns):
    """The rows' values, sorted, under their doc_id."""
    out = defaultdict(list)
    for r in rows:
        out[r.doc_id].append(tuple(r[c] for c in columns))
    return {doc: sorted(values) for doc, values in out.items()}


def expected(facts):
    out = defaultdict(list)
    for doc, text in DOCUMENTS:
        out[doc].append(facts(doc, text))
    return {doc: sorted(values) for doc, values in out.items()}


def test_pii(spark, sf_dir):
    kinds = list(brute.FORMS)

    def facts(_, text):
        spans = brute.base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (kinds.index(s[0]), s[1])))
        # On these texts nothing is learned, so all spans are base spans.
        return (*[sum(k == kind for k, _, _ in spans) for kind in kinds], hashlib.sha256(joined.encode()).hexdigest(), joined)

    got = queries.op1_pii(spark, sf_dir).collect()
    assert by_document(got, [*[f"n_{k}" for k in kinds], "base_sha256", "spans"]) == expected(facts)


def test_quality(spark, sf_dir):
    def facts(_, text):
        n, chars, symbols, lines, repeated = brute.quality_base(text)
        return n, chars, symbols, lines, repeated, n < 10 or 100 * repeated > 20 * n

    got = queries.op3_quality(spark, sf_dir).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert by_document(got, columns) == expected(facts)
    assert not any(r.kept for r in got if r.base_failed) and any(r.kept for r in got)


@pytest.mark.parametrize("name", ["op4_near_dup", "op5_decontaminate"])
def test_sql_on_awkward_tables(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        where = "WHERE doc_id IS NOT NULL" if table == "documents" and name == "op4_near_dup" else ""
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet/*.parquet') {where}")
    columns, got = spark_rows(queries.QUERIES[name](spark, sf_dir))
    want_columns, want = duckdb_rows(connection, queries.ORACLE_SQL[name])
    assert columns == want_columns
    if name == "op4_near_dup":
        got = [row for row in got if row[columns.index("doc_id")] is not None]
    else:
        assert any(row[columns.index("n_near_items")] for row in got)
    assert got == want


def test_toxicity(spark, sf_dir):
    got = queries.op6_toxicity(spark, sf_dir).collect()
    assert len(got) == len(DOCUMENTS)
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_shards(spark, sf_dir):
    got = queries.op8_shards(spark, sf_dir).collect()
    want = expected(lambda _, text: (len((text or "").encode()) + 1, zlib.crc32((text or "").encode())))
    assert by_document(got, ["size", "text_crc32"]) == want
    assert {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)
    slots, sizes = defaultdict(list), [0] * 8
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert max(sizes) <= sum(sizes) / 8 + max(r.size for r in got)


def test_repeats(spark, sf_dir):
    got = queries.op9_repeats(spark, sf_dir).collect()
    out = defaultdict(list)
    for doc, *facts in brute.repeats(DOCUMENTS):
        out[doc].append(tuple(facts))
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert by_document(got, columns) == {doc: sorted(values) for doc, values in out.items()}
    assert any(r.n_removed for r in got)


def test_packing(spark, sf_dir):
    tokenizer, texts = Tokenizer.from_file(TOKENIZER), defaultdict(list)
    for doc, text in DOCUMENTS:
        texts[doc].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    got = queries.op10_packing(spark, sf_dir).collect()
    places, covered = defaultdict(list), defaultdict(int)
    for r in got:
        sizes = [ids for ids in texts[r.doc_id] if len(ids) == r.doc_tokens]
        crcs = {
            zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[r.start : r.start + r.length])) for ids in sizes
        }
        assert r.length > 0 and r.ids_crc32 in crcs
        covered[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    assert covered == {doc: sum(map(len, ids)) for doc, ids in texts.items()}
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
