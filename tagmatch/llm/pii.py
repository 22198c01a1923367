"""Personal data by bootstrapped contextual extraction.

Identifiers of a known form are the seeds. The words around them are patterns. A graph
of patterns and instances (tokens that look like identifiers) is scored round by
round: a pattern is as good as the share of its instances that are known, an instance
as good as its patterns together. Patterns of high confidence then name tokens of no
known form as identifiers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmatch.llm.joins import with_document_facts
from tagmatch.sources.shared import stored

# Kinds in their order, and the form of each. Quantifiers give nothing
# back, and a match starts where a run of its characters starts or the last match ended,
# so that the search is linear in the text.
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TOKEN = r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S++"
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: What a token of no known form must hold to become an identifier of a kind. Quantifiers
#: of groups give nothing back, as others recurse once per repetition.
_LOOKS = {
    "email": r"\A[^@]++@[^@]++\z",
    "ip": r"\A[0-9A-Fa-f]++(?:[.:]++[0-9A-Fa-f]++){3,}+\z",
    "card": r"\A(?:[^0-9]*+[0-9]){8,}+[^0-9]*+\z",
    "phone": r"\A(?:[^0-9A-Za-z]*+[0-9]){6,}+[^0-9A-Za-z]*+\z",
}
#: Marks at the ends of a token or a word. The second ones are looked for only where a run
#: of marks starts, so that the search is linear.
_LEADING, _TRAILING = r"\A[^A-Za-z0-9+]++", r"(?<![^A-Za-z0-9])[^A-Za-z0-9]++\z"
_WORD_ENDS = r"\A[^\p{L}0=:]++|(?<![^\p{L}0=:])[^\p{L}0=:]++\z"

DOC = ["doc_id", "text_hash"]
ADDED = (*(f"n_{k}" for k in KINDS), "base_spans", "spans")

#: Characters of a block by which spans and tokens are matched.
BLOCK = 64
#: Documents with identifiers are broadcast up to this many rows and spans in all.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, and what a pattern needs to name new identifiers.

    An instance counts for the support of a pattern from ``min_score`` on.
    """

    rounds: int = 3
    min_seeds: int = 3
    min_score: float = 0.5
    min_confidence: float = 0.8
    damping: float = 0.9


def _found(kind: int, form: str, context: bool) -> Column:
    """(kind, i, gap, found, before, after) of each match: the characters since the last
    one, the match, and for tokens the two words before it and the one after it."""
    text = F.col("text")
    pieces, matches = F.split(text, form, -1), F.regexp_extract_all(text, F.lit(form), F.lit(0))
    none = F.lit(None).cast("string")
    zipped = F.arrays_zip(
        matches.alias("found"),
        pieces.alias("piece"),
        F.slice(pieces, F.lit(2), F.size(matches) + 1).alias("next"),
        F.concat(F.array(none), matches).alias("last"),
    )

    def row(z: Column, i: Column) -> Column:
        # Words between two tokens may be one or none; then the token before is a word.
        words = F.split(F.concat(F.coalesce(z["last"], F.lit("")), z["piece"]), r"\s++")
        words = F.filter(words, lambda word: word != "")
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(z["piece"]).cast("long").alias("gap"),
            z["found"].alias("found"),
            (F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)) if context else none).alias("before"),
            (F.regexp_extract(z["next"], r"\A\s*+(\S++)", 1) if context else none).alias("after"),
        )

    if not context:
        empty = F.lit(None).cast("array<string>")

        def bare(z: Column, i: Column) -> Column:
            return row(z, i).withField("before", empty)

        return F.transform(zipped, bare)
    return F.transform(zipped, row)


def _matches(docs: DataFrame) -> DataFrame:
    """(document, kind, start, end, found, before, after) of all matches of known forms
    (kind 0 to 3) and of all tokens that could be identifiers (kind 4). Offsets are code
    points, ends exclusive."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).filter(F.col("text").rlike("[0-9@]"))
    arrays = [_found(n, FORMS[k], False) for n, k in enumerate(KINDS)] + [_found(len(KINDS), _TOKEN, True)]
    rows = keyed.select(*DOC, F.explode(F.concat(*arrays)).alias("m")).select(*DOC, "m.*")
    rows = rows.filter("found IS NOT NULL")  # behind the last match stands only text
    rows = stored(rows.dropDuplicates([*DOC, "kind", "i"]), "matches")
    size = F.length("found").cast("long")
    upto = F.sum(F.col("gap") + size).over(
        Window.partitionBy(*DOC, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    )
    return rows.select(*DOC, "kind", (upto - size).alias("start"), upto.alias("end"), "found", "before", "after")


def _luhn(digits: Column) -> Column:
    """True if the digits pass the Luhn check."""

    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("found", "[^0-9]", "")
    kind = F.col("kind")
    return (
        F.when(kind == KINDS.index("ip"), F.col("found").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(kind == KINDS.index("card"), F.length(digits).between(13, 19) & _luhn(digits))
        .when(kind == KINDS.index("phone"), F.length(digits).between(9, 15))
        .otherwise(F.lit(True))
    )


def _word(word: Column) -> Column:
    """A context word: lower case, digits as 0, without marks at its ends."""
    plain = F.regexp_replace(F.lower(word), "[0-9]", "0")
    return F.regexp_replace(plain, _WORD_ENDS, "")


def _patterns() -> Column:
    """The patterns of a token: the two words before it, and the words on both sides."""
    size = F.size("before")
    l1, l2 = _word(F.get("before", size - 1)), _word(F.get("before", size - 2))
    r1 = _word(F.col("after"))
    left = F.when(F.length(l2) * F.length(l1) > 0, F.concat(F.lit("2 "), l2, F.lit(" "), l1))
    both = F.when(F.length(l1) * F.length(r1) > 0, F.concat(F.lit("1 "), l1, F.lit(" _ "), r1))
    return F.array_compact(F.array(left, both))


def _looks() -> Column:
    """Whether ``token`` looks like an identifier of ``kind``."""
    looks = F.lit(False)
    for n, k in enumerate(KINDS):
        looks = F.when(F.col("kind") == n, F.col("token").rlike(_LOOKS[k])).otherwise(looks)
    return looks


def _discovered(matches: DataFrame, base: DataFrame, settings: Bootstrap) -> DataFrame:
    """(document, kind, start, end) of tokens that confident patterns name, outside all
    base spans."""
    led = F.regexp_replace("found", _LEADING, "")
    core = F.regexp_replace(led, _TRAILING, "")
    lead = F.length("found") - F.length(led)
    tokens = stored(
        matches.filter(F.col("kind") == len(KINDS))
        .select(*DOC, (F.col("start") + lead).alias("start"), core.alias("token"), "end", _patterns().alias("patterns"))
        .filter("token <> ''")
        .withColumn("end", F.col("start") + F.length("token")),
        "tokens",
    )
    # Spans and tokens that overlap share a block of the text.
    blocks = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK)))
    spans = base.select(
        *[F.col(c).alias(f"{c}_") for c in DOC],
        "kind",
        "found",
        F.col("start").alias("s"),
        F.col("end").alias("e"),
        blocks.alias("block_"),
    )
    same = [*[F.col(c).eqNullSafe(F.col(f"{c}_")) for c in DOC], F.col("block") == F.col("block_")]
    overlap = (F.col("s") < F.col("end")) & (F.col("start") < F.col("e"))
    placed = tokens.select(*DOC, "start", "end", "token", blocks.alias("block"))
    seen = stored(
        placed.join(spans, same).filter(overlap).groupBy(*DOC, "start").agg(
            F.min("kind").alias("kind"), F.min("found").alias("found")
        ),
        "seen",
    )
    # A token of a seed stands for the whole seed.
    seeds = stored(seen.select(F.col("found").alias("token"), "kind").distinct(), "seeds")
    known_spans = seen.select(*[F.col(c).alias(f"{c}_") for c in DOC], F.col("start").alias("s"), "found")
    old = [*[F.col(c).eqNullSafe(F.col(f"{c}_")) for c in DOC], F.col("start") == F.col("s")]
    instances = tokens.join(known_spans, old, "left").select(F.coalesce("found", "token").alias("token"), "patterns")
    edges = stored(
        instances.select("token", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "token").agg(F.count(F.lit(1)).alias("n")),
        "edges",
    )
    totals = stored(edges.groupBy("pattern").agg(F.sum("n").alias("total")), "pattern-totals")
    seeds = seeds.withColumn("score", F.lit(1.0))
    known, sure = seeds, None
    for _ in range(settings.rounds):
        # Patterns are supported anew by all instances known by now, learned ones included.
        weighed = (
            edges.join(known.filter(F.col("score") >= settings.min_score), "token")
            .groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("instances"), F.sum(F.col("n") * F.col("score")).alias("weight"))
            .filter(F.col("instances") >= settings.min_seeds)
        )
        confidence = (F.col("weight") / F.col("total")).alias("confidence")
        confident = stored(weighed.join(totals, "pattern").select("pattern", "kind", confidence), "confidence")
        sure = confident.filter(F.col("confidence") >= settings.min_confidence).select("pattern", "kind")
        doubt = F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(1.0)) * settings.damping)))
        learned = (
            edges.join(confident, "pattern").filter(_looks()).groupBy("token", "kind").agg((1 - doubt).alias("score"))
        )
        known = stored(
            seeds.unionByName(learned).groupBy("token", "kind").agg(F.max("score").alias("score")), "known"
        )
    named = (
        tokens.select(*DOC, "start", "end", "token", F.explode("patterns").alias("pattern"))
        .join(sure, "pattern").filter(_looks())
        .groupBy(*DOC, "start", "end").agg(F.min("kind").alias("kind"))
    )
    return named.join(known_spans, old, "left_anti").select(*DOC, "kind", "start", "end")


def find_pii(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """(doc_id, text_hash, base, all) of documents with identifiers: arrays of (kind
    number, start, end), sorted."""
    matches = _matches(docs)
    base = stored(matches.filter(F.col("kind") < len(KINDS)).filter(_valid()).select(*DOC, "kind", "start", "end", "found"), "base")
    spans = base.drop("found").withColumn("base", F.lit(True)).unionByName(
        _discovered(matches, base, settings).withColumn("base", F.lit(False))
    )
    span = F.struct("kind", "start", "end")
    return stored(
        spans.groupBy(*DOC).agg(
            F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
            F.sort_array(F.collect_list(span)).alias("all"),
        ),
        "identifiers",
    )


def with_pii(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the number of base spans of each kind, and
    ``base_spans`` and ``spans``, arrays of (kind, start, end) in order of kind and start.

    A null or empty text has none. Rows equal in doc_id and text get equal results.
    Same-named columns are replaced; an empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in ADDED]
    found = find_pii(docs.select("doc_id", "text"), settings)
    size = found.agg(F.coalesce(F.sum(F.size("all") + 1), F.lit(0))).first()[0]
    facts = found.select(F.col("doc_id").alias("doc_id_"), F.col("text_hash").alias("hash_"), F.col("base").alias("_base"), F.col("all").alias("_all"))
    if size <= BROADCAST_ROWS:
        facts = F.broadcast(facts)
    names = F.array(*map(F.lit, KINDS))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")

    def named(column: str) -> Column:
        spans = F.transform(
            column, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        )
        return F.coalesce(spans, empty)

    joined = with_document_facts(docs.select(*rest), facts, "left")

    def number(n: int) -> Column:
        own = F.filter("_base", lambda s: s["kind"] == n)
        return F.when(F.col("_base").isNull(), 0).otherwise(F.size(own)).cast("long")

    counts = [number(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return joined.select(*rest, *counts, named("_base").alias("base_spans"), named("_all").alias("spans"))


def joined_spans(spans: str) -> Column:
    """The spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
