"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmatch.llm import (
    conversations,
    decontaminate,
    hard_negatives,
    html_text,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality,
    repeats,
    sharding,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in pii.KINDS],
        F.sha2(pii.joined_spans("base_spans"), 256).alias("base_sha256"),
        pii.joined_spans("spans").alias("spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", *line_dedup.ADDED, "text")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.ADDED)


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", *near_dup.ADDED)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near_items",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A row without an id has no fold: nothing is learned from it.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.with_toxicity(docs, lexicon)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = repeats.with_repeats_removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", noisy)
    mined = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.with_digests(conversations.repair(conversations.damaged(rows)))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    joined = every.join(repaired, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in (*conversations.COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_records(warc.write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_near_dup": op4_near_dup,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_html_text": op7_html_text,
    "op8_shards": op8_shards,
    "op9_repeats": op9_repeats,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversations": op12_conversations,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op4_near_dup": """
        WITH RECURSIVE w AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        s AS MATERIALIZED (
            SELECT doc_id, list_sort(CASE WHEN len(words) = 0 THEN []
                WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(len(words) - 3),
                    lambda i: array_to_string(words[i + 1 : i + 4], ' '))) END) AS shingles
            FROM w),
        sets AS MATERIALIZED (
            SELECT shingles, len(shingles) AS n, min(doc_id) AS one FROM s WHERE len(shingles) > 0 GROUP BY shingles),
        held AS MATERIALIZED (SELECT one, n, unnest(shingles) AS shingle FROM sets),
        links AS MATERIALIZED (
            SELECT a.one AS a, b.one AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.one <> b.one
            GROUP BY a.one, b.one, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach AS (
            SELECT one, one AS other FROM sets UNION SELECT one, b FROM reach JOIN links ON other = a),
        least AS (SELECT one, min(other) AS component_id FROM reach GROUP BY one)
        SELECT doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
            doc_id = coalesce(component_id, doc_id) AS kept
        FROM s LEFT JOIN sets ON s.shingles = sets.shingles LEFT JOIN least USING (one)""",
    "op5_decontaminate": """
        WITH b AS MATERIALIZED (
            SELECT DISTINCT item_id::VARCHAR AS item_id, text, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM benchmark),
        item_windows AS MATERIALIZED (
            SELECT item_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 10 THEN [words]
                ELSE list_transform(range(len(words) - 9), lambda i: words[i + 1 : i + 10]) END) AS words
            FROM b),
        windows AS MATERIALIZED (
            SELECT words, len(words) AS size, row_number() OVER () AS win FROM (SELECT DISTINCT words FROM item_windows)),
        terms AS MATERIALIZED (
            SELECT win, size, slot, CASE WHEN size = 1 THEN words[1] ELSE words[slot + 1] || ' ' || words[slot + 2] END AS term
            FROM (SELECT win, size, words, unnest(range(greatest(1, size - 1))) AS slot FROM windows)),
        d AS MATERIALIZED (
            SELECT doc_id, text, row_number() OVER () AS doc, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM (SELECT DISTINCT doc_id, text FROM documents)),
        places AS (SELECT doc, words, unnest(range(len(words))) AS pos FROM d),
        postings AS MATERIALIZED (
            SELECT doc, pos, term FROM (
                SELECT doc, pos, words[pos + 1] || ' ' || words[pos + 2] AS term FROM places WHERE pos + 2 <= len(words)
                UNION ALL SELECT doc, pos, words[pos + 1] FROM places)
            WHERE term IN (SELECT term FROM terms)),
        ranked AS MATERIALIZED (
            SELECT terms.*, row_number() OVER (PARTITION BY win ORDER BY n, slot) AS place,
                count(n) OVER (PARTITION BY win) = count(*) OVER (PARTITION BY win) AS all_known
            FROM terms LEFT JOIN (SELECT term, count(*) AS n FROM postings GROUP BY term) USING (term)),
        found AS MATERIALIZED (
            SELECT doc, win, pos - slot AS start, any_value(size) AS size
            FROM postings JOIN terms USING (term) GROUP BY doc, win, pos - slot
            HAVING count(DISTINCT slot) = greatest(1, any_value(size) - 1)),
        near AS (
            SELECT DISTINCT p.doc, r.win
            FROM postings p JOIN ranked r ON p.term = r.term AND r.place = 1 AND r.all_known AND p.pos >= r.slot
            JOIN ranked s ON s.win = r.win AND s.place = 2
            JOIN postings q ON q.doc = p.doc AND q.term = s.term AND abs(q.pos - (p.pos - r.slot) - s.slot) <= 20),
        hits AS (
            SELECT doc, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc, unnest(range(start, start + size)) AS pos FROM found) GROUP BY doc),
        named AS (
            SELECT doc, list_sort(list(DISTINCT item_id)) AS ids
            FROM found JOIN windows USING (win) JOIN item_windows i ON i.words = windows.words
            WHERE item_id IS NOT NULL GROUP BY doc),
        close AS (
            SELECT doc, list(DISTINCT item_id) AS ids
            FROM near JOIN windows USING (win) JOIN item_windows i ON i.words = windows.words
            WHERE item_id IS NOT NULL GROUP BY doc)
        SELECT documents.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            len(coalesce(named.ids, []))::BIGINT AS n_items,
            sha256(array_to_string(coalesce(named.ids, []), ',')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated,
            len(list_filter(coalesce(close.ids, []),
                lambda x: NOT list_contains(coalesce(named.ids, []), x)))::BIGINT AS n_near_items
        FROM documents
        JOIN d ON documents.doc_id IS NOT DISTINCT FROM d.doc_id AND documents.text IS NOT DISTINCT FROM d.text
        LEFT JOIN hits USING (doc) LEFT JOIN named USING (doc) LEFT JOIN close USING (doc)""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id,
                CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op13_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex,
                row_number() OVER (
                    PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
                max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages)
        SELECT page_id, payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (1 + (('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) % 32)::INT,
                1)), '') AS payload_digest,
            CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN place > 1 THEN first_id END AS refers_to
        FROM p""",
}
