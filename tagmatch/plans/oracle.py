"""The queries of ``queries.py`` again, as SQL on the test tables."""

from __future__ import annotations

from tagmatch.operators.catalog import NUM_FEATURES
from tagmatch.plans.queries import (
    FEW_FEATURES,
    MAX_USERS,
    MIN_REVIEWS,
    NEAREST_VECTORS,
    TARGETS_BY,
    TARGET_USER,
    TARGET_VECTOR,
    WIDE_KEY,
)
from tagmatch.plans.skew import Scale

# Common tables, each with the tables it reads.
_TABLES: dict[str, str] = {
    "interactions": """
        SELECT l_partkey AS app_id, l_linenumber AS helpful, l_suppkey AS funny,
               strftime(l_shipdate, '%Y-%m-%d') AS date,
               (l_returnflag = 'A' AND CASE WHEN l_linenumber <> 6 THEN true END) AS is_recommended,
               l_quantity AS hours, CASE WHEN l_linenumber <> 7 THEN o_custkey END AS user_id,
               l_orderkey * 8 + l_linenumber AS review_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT p_partkey AS app_id, p_name AS title, p_type, p_size, p_retailprice
        FROM part WHERE p_size % 10 <> 7
        UNION ALL
        SELECT p_partkey, p_name || ' II', p_type, p_size, p_retailprice
        FROM part WHERE p_size % 10 = 8""",
    "titles": "SELECT app_id, max(title) AS title FROM items GROUP BY app_id",
    "plain_lists": """
        SELECT p_partkey AS app_id, p_type AS description, p_size % 10 AS c,
               list_concat(string_split_regex(p_name, '\\s+'),
                           [p_brand, p_type, 'size ' || CAST(p_size AS VARCHAR)]) AS parts
        FROM part""",
    "tag_rows": """
        SELECT app_id, description, 0 AS copy,
               CASE c WHEN 3 THEN NULL WHEN 4 THEN CAST([] AS VARCHAR[])
                      WHEN 5 THEN list_append(parts, 'New, Used')
                      WHEN 6 THEN list_append(parts, '  Wide ' || chr(9) || ' Tag ') ELSE parts END AS tags
        FROM plain_lists
        UNION ALL
        SELECT app_id, description, 1, list_append(parts, 'zz') FROM plain_lists WHERE c = 9""",
    "tag_lists": "SELECT * FROM tag_rows WHERE len(tags) > 0",
    "normal_lists": """
        SELECT app_id, copy, list_transform(tags,
               lambda t: lower(trim(regexp_replace(t, '\\s+', ' ', 'g')))) AS tags
        FROM tag_lists""",
    "word_lists": """
        SELECT app_id, arg_max(string_split(array_to_string(tags, ','), ','), copy) AS words
        FROM normal_lists GROUP BY app_id""",
    "item_words": "SELECT app_id, unnest(words) AS word FROM word_lists",
    "users": """
        SELECT user_id, count(DISTINCT app_id) AS products, count(*) AS reviews
        FROM interactions GROUP BY user_id""",
    "liked": """
        SELECT user_id, app_id FROM interactions
        WHERE is_recommended AND user_id IS NOT NULL AND app_id IS NOT NULL""",
    "chosen": f"""
        SELECT user_id FROM users WHERE reviews >= {MIN_REVIEWS} AND user_id = {TARGET_USER}
        UNION ALL
        SELECT user_id FROM (
            SELECT user_id FROM users WHERE reviews >= {MIN_REVIEWS} AND user_id <> {TARGET_USER}
            ORDER BY user_id LIMIT {MAX_USERS - 1})""",
    "kept": """
        SELECT * FROM interactions
        WHERE is_recommended AND user_id IN (SELECT user_id FROM chosen)
        AND md5(concat_ws('|', app_id, helpful, funny, date, is_recommended, hours, user_id,
                          review_id, '19')) < '59999999'""",
}


def _scope(end: str, titled: bool) -> dict[str, str]:
    """The tables of profiles and similarities, of titled items or of all tagged ones."""
    join = "JOIN" if titled else "LEFT JOIN"
    return {
        f"details{end}": f"""
            SELECT user_id, app_id, title, words
            FROM liked {join} titles USING (app_id) JOIN word_lists USING (app_id)""",
        f"terms{end}": f"SELECT user_id, unnest(words) AS word FROM details{end}",
        f"counts{end}": f"SELECT user_id, word, count(*) AS word_count FROM terms{end} GROUP BY user_id, word",
        f"totals{end}": f"""
            SELECT user_id, CAST(count(*) AS BIGINT) AS total_word_count FROM terms{end} GROUP BY user_id""",
        f"tf{end}": f"""
            SELECT user_id, word, word_count, total_word_count,
                   CAST(word_count AS DOUBLE) / total_word_count AS tf
            FROM counts{end} JOIN totals{end} USING (user_id)""",
        f"n{end}": f"SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS users FROM terms{end}",
        f"df{end}": f"SELECT word, count(DISTINCT user_id) AS user_count FROM terms{end} GROUP BY word",
        f"idf{end}": f"""
            SELECT word, user_count, ln(users / user_count) AS plain,
                   ln((users + 1) / (user_count + 1)) AS smoothed
            FROM df{end} CROSS JOIN n{end}""",
        f"weights{end}": f"""
            SELECT user_id, word, tf * plain AS w, word_count * smoothed AS smoothed_w
            FROM tf{end} JOIN idf{end} USING (word)""",
        f"norms{end}": f"""
            SELECT user_id, sqrt(sum(w * w)) AS norm, sqrt(sum(smoothed_w * smoothed_w)) AS smoothed_norm
            FROM weights{end} GROUP BY user_id""",
        f"dots{end}": f"""
            SELECT o.user_id, coalesce(sum(o.w * t.w), 0) AS dot,
                   coalesce(sum(o.smoothed_w * t.smoothed_w), 0) AS smoothed_dot
            FROM weights{end} o
            LEFT JOIN (SELECT * FROM weights{end} WHERE user_id = {TARGET_USER}) t ON o.word = t.word
            WHERE o.user_id <> {TARGET_USER} AND EXISTS (
                SELECT 1 FROM weights{end} WHERE user_id = {TARGET_USER})
            GROUP BY o.user_id""",
        f"sims{end}": f"""
            SELECT dots{end}.user_id,
                   CASE WHEN o.norm * t.norm = 0 THEN 0 ELSE dot / (o.norm * t.norm) END AS sim,
                   CASE WHEN o.smoothed_norm * t.smoothed_norm = 0 THEN 0
                        ELSE smoothed_dot / (o.smoothed_norm * t.smoothed_norm) END AS smoothed_sim
            FROM dots{end} JOIN norms{end} o USING (user_id)
            JOIN norms{end} t ON t.user_id = {TARGET_USER}""",
    }


_TABLES |= _scope("", True) | _scope("_tagged", False)
_TABLES |= {
    "near": "SELECT user_id, sim FROM sims ORDER BY round(sim, 12) DESC, user_id LIMIT 3",
    "near_positive": """
        SELECT user_id, sim FROM sims_tagged WHERE sim > 0 ORDER BY round(sim, 12) DESC, user_id LIMIT 3""",
    "near_hashed": """
        SELECT user_id, smoothed_sim FROM sims
        ORDER BY round(smoothed_sim, 12) DESC, user_id LIMIT 3""",
}

# Murmur3 of 32 bits, seed 42, over the UTF-8 bytes of each word.
_LOW = 2**32


def _mixed(block: str) -> str:
    """SQL for the mixing of four bytes, or of the rest, before they enter the hash."""
    times = f"((({block})::HUGEINT * 3432918353) % {_LOW})::BIGINT"
    turned = f"list_transform([{times}], lambda x: (x * 32768) % {_LOW} + (x >> 17))[1]"
    return f"((({turned})::HUGEINT * 461845907) % {_LOW})::BIGINT"


def _little_endian(start: str, count: int) -> str:
    """SQL for some bytes as a number, from the 1-based place of their hex digits."""
    return "('0x' || " + " || ".join(f"substr(hx, {start} + {2 * i}, 2)" for i in reversed(range(count))) + ")::BIGINT"


_TABLES |= {
    "word_bytes": """
        SELECT word, hex(encode(word)) AS hx, octet_length(encode(word)) AS n
        FROM (SELECT DISTINCT word FROM item_words)""",
    "word_blocks": f"""
        SELECT word, n, list_transform(range(n // 4), lambda i: {_mixed(_little_endian("(8 * i + 1)::INT", 4))}) AS blocks,
               CASE n % 4 WHEN 0 THEN 0
                   {" ".join(f"WHEN {t} THEN {_mixed(_little_endian('(8 * (n // 4) + 1)::INT', t))}" for t in (1, 2, 3))}
               END AS rest
        FROM word_bytes""",
    "word_hash_1": f"""
        SELECT word, xor(xor(list_reduce(blocks, lambda h, k:
                   (((xor(h, k) * 8192) % {_LOW} + (xor(h, k) >> 19)) * 5 + 3864292196) % {_LOW}, 42::BIGINT), rest), n) AS h
        FROM word_blocks""",
    "word_hash_2": f"SELECT word, ((xor(h, h >> 16)::HUGEINT * 2246822507) % {_LOW})::BIGINT AS h FROM word_hash_1",
    "word_hash_3": f"SELECT word, ((xor(h, h >> 13)::HUGEINT * 3266489909) % {_LOW})::BIGINT AS h FROM word_hash_2",
    "word_hash": f"""
        SELECT word, xor(h, h >> 16) - CASE WHEN xor(h, h >> 16) >= {_LOW // 2} THEN {_LOW} ELSE 0 END AS h
        FROM word_hash_3""",
    "buckets": f"""
        SELECT word, (h % {NUM_FEATURES} + {NUM_FEATURES}) % {NUM_FEATURES} AS bucket,
               (h % {FEW_FEATURES} + {FEW_FEATURES}) % {FEW_FEATURES} AS few_bucket
        FROM word_hash""",
    "hashed_counts": """
        SELECT user_id, bucket, sum(word_count)::BIGINT AS word_count
        FROM counts JOIN buckets USING (word) GROUP BY user_id, bucket""",
    "few_counts": """
        SELECT user_id, few_bucket, sum(word_count)::BIGINT AS word_count
        FROM counts JOIN buckets USING (word) GROUP BY user_id, few_bucket""",
    "active": f"SELECT user_id FROM users WHERE reviews >= {MIN_REVIEWS} AND user_id IS NOT NULL",
    "many_dots": f"""
        SELECT t.user_id AS target_user, o.user_id, sum(t.w * o.w) AS dot
        FROM weights t JOIN weights o USING (word)
        WHERE t.user_id <> o.user_id AND t.user_id % {TARGETS_BY} = 0 GROUP BY ALL""",
    "many_sims": f"""
        SELECT t.user_id AS target_user, o.user_id,
               CASE WHEN t.norm * o.norm = 0 OR dot IS NULL THEN 0 ELSE dot / (t.norm * o.norm) END AS sim
        FROM norms t JOIN norms o ON t.user_id <> o.user_id
        LEFT JOIN many_dots d ON d.target_user = t.user_id AND d.user_id = o.user_id
        WHERE t.user_id % {TARGETS_BY} = 0""",
    "near_many": """
        SELECT target_user, user_id, sim,
               row_number() OVER (PARTITION BY target_user ORDER BY round(sim, 12) DESC, user_id) AS rank
        FROM many_sims QUALIFY rank <= 3""",
}

_INTERACTION_COLUMNS = """
    app_id, CAST(helpful AS BIGINT) AS helpful, funny, date,
    CAST(is_recommended AS BIGINT) AS is_recommended, round(hours, 6) AS hours, user_id, review_id"""

_TAG_LISTS = "SELECT app_id, array_to_string(tags, '|') AS tags FROM {table}"


def _with(select: str) -> str:
    """The select after the common tables."""
    tables = ",\n".join(f"{name} AS ({body})" for name, body in _TABLES.items())
    return f"WITH {tables}\n{select}"


def _unseen(near: str, end: str = "") -> str:
    return f"""
        FROM details{end} WHERE user_id IN (SELECT user_id FROM {near})
        AND app_id NOT IN (SELECT app_id FROM details{end} WHERE user_id = {TARGET_USER})"""


_LISTED = """
    SELECT app_id, title, array_to_string(list_sort(list(user_id)), ',') AS similar_user_ids
    {unseen} GROUP BY app_id, title"""

_SETS = """
    SELECT app_id, title, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS similar_user_ids
    {unseen} GROUP BY app_id, title"""

_SELECTS: dict[str, str] = {
    "scan_interactions": f"""
        SELECT {_INTERACTION_COLUMNS} FROM (
            SELECT * REPLACE (app_id + {WIDE_KEY} AS app_id, user_id + {WIDE_KEY} AS user_id,
                              review_id + {WIDE_KEY} AS review_id) FROM interactions)""",
    "scan_items": f"""
        SELECT app_id + {WIDE_KEY} AS app_id,
               CASE p_size % 9 WHEN 0 THEN title || chr(10) || 'second line' || chr(13)
                    WHEN 1 THEN '"' || title || '", "' WHEN 2 THEN title || '\\n\\'
                    WHEN 3 THEN '  ' || title || chr(9) || ' ' WHEN 4 THEN '' WHEN 5 THEN NULL
                    WHEN 6 THEN chr(0) || title || '\\0%00' || chr(0) || '\\' || chr(0)
                    WHEN 7 THEN title || '%0A%25\\N%'
                    ELSE title END AS title,
               '2000-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS date_release,
               CAST(1 AS BIGINT) AS win, CAST(p_size % 2 = 0 AS BIGINT) AS mac,
               CAST(p_size % 2 <> 0 AS BIGINT) AS linux, p_type AS rating,
               CAST(p_size AS BIGINT) AS positive_ratio, CAST(p_size AS BIGINT) AS user_reviews,
               round(p_retailprice, 6) AS price_final, round(p_retailprice, 6) AS price_original,
               CAST(0 AS DOUBLE) AS discount, CAST(p_size % 2 = 0 AS BIGINT) AS steam_deck
        FROM items""",
    "scan_item_tags": f"""
        SELECT app_id + {WIDE_KEY} AS app_id, description, array_to_string(tags, '|') AS tags FROM tag_rows""",
    "scan_users": f"SELECT user_id + {WIDE_KEY} AS user_id, products, reviews FROM users",
    "subset_roundtrip_csv": f"SELECT {_INTERACTION_COLUMNS} FROM kept",
    "subset_roundtrip_json": """
        SELECT app_id, array_to_string(tags, '|') AS tags FROM tag_rows
        WHERE app_id IN (SELECT app_id FROM kept)""",
    "recommendation_lines": f"""
        SELECT 'Game ID: ' || app_id || ', userId: ' || similar_user_ids || ', title: ' || title AS line
        FROM ({_SETS.format(unseen=_unseen("near_positive", "_tagged") + " AND title IS NOT NULL")})""",
    "recommendation_lines_list": f"""
        SELECT 'Game ID: ' || app_id || ', Title: ' || title || ', Users: '
               || replace(similar_user_ids, ',', ', ') AS line
        FROM ({_LISTED.format(unseen=_unseen("near"))})""",
    "positive_interactions": "SELECT user_id, app_id FROM liked",
    "sample_interactions": """
        SELECT user_id, app_id, review_id FROM interactions
        WHERE is_recommended
        AND md5(concat_ws('|', review_id, app_id, user_id, '19')) < '59999999'""",
    "user_item_lists": """
        SELECT user_id, app_id // 1000000 AS page,
               string_agg(CAST(app_id AS VARCHAR), ',' ORDER BY app_id) AS app_ids,
               string_agg(CAST(copies AS VARCHAR), ',' ORDER BY app_id) AS copies
        FROM (SELECT user_id, app_id, count(*) AS copies FROM liked GROUP BY user_id, app_id)
        GROUP BY user_id, app_id // 1000000""",
    "distinct_items": "SELECT DISTINCT app_id FROM liked",
    "tagged_items": _TAG_LISTS.format(table="tag_lists"),
    "normalize_tags": _TAG_LISTS.format(table="normal_lists"),
    "item_title_lookup": "SELECT app_id, max(title) AS title FROM items GROUP BY app_id",
    "item_tag_lookup": """
        SELECT app_id, array_to_string(arg_max(tags, copy), '|') AS tags FROM (
            SELECT app_id, copy, tags FROM tag_rows WHERE tags IS NOT NULL
            UNION ALL SELECT app_id, -1, NULL FROM tag_rows)
        GROUP BY app_id""",
    "user_item_details": """
        SELECT user_id, app_id, title, array_to_string(words, '|') AS words FROM details""",
    "tagged_interactions": """
        SELECT user_id, app_id, array_to_string(words, '|') AS words FROM details_tagged""",
    "user_terms": "SELECT user_id, word FROM terms",
    "user_tag_profile": f"""
        SELECT user_id, page, string_agg(word, '|' ORDER BY word) AS tag_words,
               string_agg(CAST(word_count AS VARCHAR), ',' ORDER BY word) AS word_counts
        FROM (SELECT *, CAST('0x' || md5(word)[:6] AS BIGINT) % {Scale().word_pages} AS page FROM counts)
        GROUP BY user_id, page""",
    "user_term_totals": "SELECT user_id, total_word_count FROM totals",
    "user_term_counts": "SELECT user_id, word, word_count FROM counts",
    "user_count": "SELECT CAST(users AS BIGINT) AS user_count FROM n",
    "term_frequency": """
        SELECT user_id, word, word_count, total_word_count, round(tf, 6) AS tf FROM tf""",
    "document_frequency": "SELECT word, user_count FROM df",
    "idf_plain": "SELECT word, user_count, round(plain, 6) AS idf FROM idf",
    "idf_smoothed": "SELECT word, user_count, round(smoothed, 6) AS idf FROM idf",
    "tfidf": "SELECT user_id, word, round(w, 6) AS tfidf FROM weights",
    "target_profile": f"""
        SELECT word, round(w, 6) AS tfidf FROM weights WHERE user_id = {TARGET_USER}""",
    "hashed_tf": "SELECT user_id, bucket, word_count FROM hashed_counts",
    "hashed_vectors": f"""
        SELECT user_id, {FEW_FEATURES}::BIGINT AS size, string_agg(few_bucket, ',' ORDER BY few_bucket) AS indices,
               string_agg(word_count, ',' ORDER BY few_bucket) AS counts
        FROM few_counts GROUP BY user_id""",
    "hashed_tfidf": """
        SELECT user_id, bucket, round(word_count * ln((users + 1) / (df + 1)), 6) AS tfidf
        FROM hashed_counts CROSS JOIN n
        JOIN (SELECT bucket, count(*) AS df FROM hashed_counts GROUP BY bucket) USING (bucket)""",
    "hashed_tfidf_kept": """
        SELECT user_id, bucket, round(word_count * ln((known + 1) / (coalesce(df, 0) + 1)), 6) AS tfidf
        FROM hashed_counts
        CROSS JOIN (SELECT count(DISTINCT user_id) AS known FROM counts WHERE user_id IN (SELECT user_id FROM active))
        LEFT JOIN (SELECT bucket, count(*) AS df FROM hashed_counts
                   WHERE user_id IN (SELECT user_id FROM active) GROUP BY bucket) USING (bucket)""",
    "user_norms": "SELECT user_id, round(norm, 6) AS norm FROM norms",
    "dot_products": "SELECT user_id, round(dot, 6) AS dot_product FROM dots",
    "cosine_similarity": "SELECT user_id, round(sim, 6) AS cosine_similarity FROM sims",
    "cosine_similarity_hashed": """
        SELECT user_id, round(smoothed_sim, 6) AS cosine_similarity FROM sims""",
    "similar_users_top3": "SELECT user_id, round(sim, 6) AS cosine_similarity FROM near",
    "similar_users_positive_top3": """
        SELECT user_id, round(sim, 6) AS cosine_similarity FROM near_positive""",
    "similar_users_stored": "SELECT user_id, round(sim, 6) AS cosine_similarity FROM near",
    "similar_users_many": "SELECT target_user, rank, user_id, round(sim, 6) AS cosine_similarity FROM near_many",
    "vector_cosine_topk": f"""
        SELECT vec_id, round(sim, 6) AS cosine_similarity FROM (
            SELECT o.vec_id, CASE WHEN o.norm * t.norm = 0 THEN 0
                   ELSE list_dot_product(o.v, t.v) / (o.norm * t.norm) END AS sim
            FROM (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm
                  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)) o,
                 (SELECT v, sqrt(list_dot_product(v, v)) AS norm
                  FROM (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                        WHERE vec_id = {TARGET_VECTOR})) t
            WHERE o.vec_id <> {TARGET_VECTOR})
        ORDER BY round(sim, 12) DESC, vec_id LIMIT {NEAREST_VECTORS}""",
    "unseen_items": f"""
        SELECT app_id, user_id, count(*) AS times {_unseen("near")} GROUP BY app_id, user_id""",
    "recommend_titled": _LISTED.format(unseen=_unseen("near")),
    "recommend_tagged": _SETS.format(unseen=_unseen("near_positive", "_tagged") + " AND title IS NOT NULL"),
    "recommend_many": """
        SELECT target_user, app_id, title, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS similar_user_ids
        FROM near_many JOIN details d USING (user_id)
        WHERE NOT EXISTS (SELECT 1 FROM details o WHERE o.user_id = target_user AND o.app_id = d.app_id)
        GROUP BY target_user, app_id, title""",
    "recommend_hashed": _LISTED.format(unseen=_unseen("near_hashed")),
    "active_users": f"""
        SELECT user_id, products, reviews FROM users
        WHERE reviews >= {MIN_REVIEWS} AND user_id IS NOT NULL""",
    "pick_user": f"""
        SELECT user_id FROM users WHERE reviews >= {MIN_REVIEWS} AND user_id IS NOT NULL
        ORDER BY md5(user_id || '|19'), user_id LIMIT 1""",
    "subset_users": "SELECT user_id FROM chosen",
    "subset_by_keys": f"""
        SELECT {_INTERACTION_COLUMNS} FROM interactions
        WHERE user_id IN (SELECT user_id FROM users WHERE reviews >= {MIN_REVIEWS})""",
    "build_subset": """
        SELECT 'interactions' AS part, app_id, user_id FROM kept
        UNION ALL
        SELECT 'items', app_id, CAST(-1 AS BIGINT) FROM items
        WHERE app_id IN (SELECT app_id FROM kept)
        UNION ALL
        SELECT 'item_tags', app_id, CAST(-1 AS BIGINT) FROM tag_rows
        WHERE app_id IN (SELECT app_id FROM kept)""",
}

ORACLE_SQL: dict[str, str] = {name: _with(select) for name, select in _SELECTS.items()}
