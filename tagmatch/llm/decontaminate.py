"""Benchmark decontamination with a distributed positional inverted index.

The index stores, for training tokens, where they stand: one posting (term, document,
position) for each token that is followed by the same token somewhere in the
benchmark, the term being the token with its follower. Tokens without such a
neighbour cannot be part of a benchmark passage and have no posting.

A window of n benchmark words is a list of n - 1 terms. Its postings are intersected
from the rarest term on: positions less the term's offset give the places where the
window may start, and each further term must stand at its offset from there. The two
rarest terms close to each other, but not at their offsets, are a proximity match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.llm.joins import with_document_facts
from tagmatch.sources.shared import stored

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: The two rarest terms this many words off their places make a proximity match.
SLACK = 20
#: Benchmark terms and windows are broadcast up to this many rows.
BROADCAST_ROWS = 500_000

DOC = ["doc_id", "text_hash"]
ADDED = ("n_words", "n_hit", "n_items", "n_near_items", "item_ids", "contaminated")

# Fixed value: what separates words, in the alphabet before A-Z is put in lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words in their order, letters as they are; of null, none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def _lowered(word: Column) -> Column:
    """A-Z in lower case and no other letter."""
    return F.when(word == F.lower(word), word).otherwise(F.translate(word, _UPPER, _LOWER))


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _item_terms(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, size, offset, term) of every term of every item with words. Rows
    that share an item_id are one item with the windows of all; a repeated row counts once."""
    tokens = benchmark.select("item_id", "text").distinct().select(
        F.xxhash64("item_id", "text").alias("item"),
        F.col("item_id").cast("string").alias("item_id"),
        words(F.col("text")).alias("w"),
    ).filter(F.size("w") > 0)
    size = F.size("w")
    pairs = F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), size).alias("b"))
    term = _lowered(F.concat_ws(" ", F.col("p.a"), F.col("p.b")))
    return (
        tokens.select("item", "item_id", size.alias("size"), F.posexplode(pairs).alias("offset", "p"))
        .select("item", "item_id", "size", "offset", term.alias("term"))
        .filter((F.col("offset") < F.col("size") - 1) | (F.col("size") == 1))
    )


def _postings(docs: DataFrame, terms: DataFrame, single: bool) -> DataFrame:
    """(document, n_words, pos, term) of benchmark terms, and a row with pos -1 and no
    term for each document; each once, however often a document's row is repeated.
    Terms of one word are looked up only if there are any."""
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    marked = F.concat(F.array(F.lit("")), F.col("w"))
    pairs = F.arrays_zip(marked.alias("a"), F.col("w").alias("b"))
    exploded = tokens.select(*DOC, F.size("w").alias("n_words"), F.posexplode(pairs).alias("i", "p"))
    known = _maybe_broadcast(terms)

    def found(term: Column) -> DataFrame:
        looked = exploded.select(*DOC, "n_words", (F.col("i") - 1).alias("pos"), term.alias("spelled"))
        joined = looked.join(known, F.col("spelled") == F.col("term"), "left")
        return joined.select(*DOC, "n_words", "pos", "term_id")

    both = found(_lowered(F.concat_ws(" ", "p.a", "p.b"))).filter("pos = -1 OR term_id IS NOT NULL")
    if single:
        both = both.unionByName(found(_lowered(F.col("p.a"))).filter("pos >= 0 AND term_id IS NOT NULL"))
    return both.distinct()


def _windows(item_terms: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, length, terms: rarest first, with offsets), and the
    items of each. Windows with a term that no document has are left out."""
    known = item_terms.join(counts, "term", "left")
    start = F.explode(
        F.sequence(
            F.greatest(F.lit(0), F.col("offset") - WINDOW + 2),
            F.least(F.col("offset"), F.greatest(F.lit(0), F.col("size") - WINDOW)),
        )
    )
    placed = known.select("item", "item_id", "size", "offset", "term_id", "n", start.alias("start"))
    length = F.least("size", F.lit(WINDOW))
    grouped = placed.groupBy("item", "item_id", "size", "start").agg(
        F.array_sort(F.collect_list(F.struct("n", (F.col("offset") - F.col("start")).alias("offset"), "term_id"))).alias("terms"),
        F.min(F.col("n").isNotNull()).alias("all_known"),
    )
    grouped = grouped.filter("all_known").select("item_id", length.alias("length"), "terms")
    keyed = grouped.withColumn("window", F.xxhash64("length", "terms.offset", "terms.term_id"))
    keyed = stored(keyed, "item-windows")
    windows = keyed.select("window", "length", "terms").dropDuplicates(["window"])
    return stored(windows, "windows"), keyed.select("window", "item_id").distinct()


def _matches(postings: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact matches (document, start, window, length), and (document, window) of
    windows whose two rarest terms are near each other."""
    there = postings.filter("pos >= 0").select(*DOC, "pos", "term_id")
    rarest = windows.select(
        "window",
        "length",
        F.col("terms")[0]["term_id"].alias("term_id"),
        F.col("terms")[0]["offset"].alias("offset"),
        F.get("terms", F.lit(1))["term_id"].alias("second"),
        F.get("terms", F.lit(1))["offset"].alias("second_offset"),
        F.slice("terms", F.lit(3), F.size("terms")).alias("others"),
    )
    first = stored(
        there.join(_maybe_broadcast(rarest), "term_id")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .filter("start >= 0")
        .drop("pos", "offset", "term_id"),
        "first-terms",
    )
    pos2 = there.select(
        *[F.col(c).alias(f"{c}_") for c in DOC], F.col("pos").alias("pos2"), F.col("term_id").alias("second_")
    )
    same_doc = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in DOC]
    off = F.abs(F.col("pos2") - F.col("start") - F.col("second_offset"))
    second = stored(
        first.filter("second IS NOT NULL")
        .join(pos2, [*same_doc, F.col("second") == F.col("second_")])
        .filter(off <= SLACK)
        .select(*DOC, "window", "length", "start", "others", off.alias("off")),
        "second-terms",
    )
    exact = second.filter("off = 0").select(*DOC, "window", "length", "start", "others")
    rest = stored(exact.filter(F.size("others") > 0), "exact-so-far")
    checks = rest.select(*DOC, "window", "length", "start", F.size("others").alias("need"), F.explode("others").alias("o"))
    checks = checks.select(
        *DOC, "window", "length", "start", "need", F.col("o.term_id").alias("second"), (F.col("start") + F.col("o.offset")).alias("at")
    )
    agreed = (
        checks.join(pos2, [*same_doc, F.col("second") == F.col("second_"), F.col("at") == F.col("pos2")])
        .groupBy(*DOC, "window", "length", "start", "need")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n = need")
    )
    columns = [*DOC, "window", "length", "start"]
    matches = (
        first.filter("second IS NULL").select(*columns)
        .unionByName(exact.filter(F.size("others") == 0).select(*columns))
        .unionByName(agreed.select(*columns))
    )
    return stored(matches.distinct(), "matches"), second.select(*DOC, "window").distinct()


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, item_ids, near_ids), one row per document.

    A word is hit if it lies in an occurrence of a window. ``item_ids`` are the items
    with an occurring window, sorted as strings; ``near_ids`` those with only a
    proximity match."""
    item_terms = stored(_item_terms(benchmark), "item-terms")
    terms = item_terms.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id())
    terms = stored(terms, "terms")
    single = not item_terms.filter("size = 1").isEmpty()
    postings = stored(_postings(docs, terms, single), "postings")
    counts = postings.filter("pos >= 0").groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    windows, items = _windows(item_terms, stored(counts.join(terms, "term_id"), "term-counts"))
    matches, near = _matches(postings, windows)

    end = F.col("start") + F.col("length")
    earlier = Window.partitionBy(*DOC).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("start"), F.coalesce(F.max(end).over(earlier), F.lit(0)))
    spans = matches.select(*DOC, "start", "length").distinct()
    hits = spans.withColumn("new", F.greatest(end - reached, F.lit(0))).groupBy(*DOC).agg(F.sum("new").alias("n_hit"))

    def named(found: DataFrame, name: str) -> DataFrame:
        own = found.select(*DOC, "window").distinct().join(items, "window").select(*DOC, "item_id")
        return own.groupBy(*DOC).agg(F.sort_array(F.collect_set("item_id")).alias(name))

    facts = (
        postings.filter("pos = -1").select(*DOC, "n_words").distinct()
        .unionByName(hits, allowMissingColumns=True)
        .unionByName(named(matches, "item_ids"), allowMissingColumns=True)
        .unionByName(named(near, "near_ids"), allowMissingColumns=True)
    )
    none = F.array().cast("array<string>")
    merged = facts.groupBy(*DOC).agg(
        F.max("n_words").alias("n_words"),
        F.coalesce(F.max("n_hit"), F.lit(0)).alias("n_hit"),
        F.coalesce(F.max("item_ids"), none).alias("item_ids"),
        F.coalesce(F.max("near_ids"), none).alias("near_ids"),
    )
    return stored(merged.withColumn("near_ids", F.array_except("near_ids", "item_ids")), "passages")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the columns ``ADDED``.

    Words are compared with A-Z in lower case. A null or wordless text has no words and
    is clean, as is any text if the benchmark has no words. Rows equal in doc_id and
    text get equal results. An item without an id hits words but is not named.
    Same-named columns are replaced.
    """
    rest = [c for c in docs.columns if c not in ADDED]
    facts = find_passages(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).select(
        F.col("doc_id").alias("doc_id_"),
        F.col("text_hash").alias("hash_"),
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.size("near_ids").cast("long").alias("n_near_items"),
        "item_ids",
        (F.col("n_hit") > 0).alias("contaminated"),
    )
    return with_document_facts(docs.select(*rest), _maybe_broadcast(facts)).select(*rest, *ADDED)
