"""Quality rules: distribution divergence from language references.

A document's character-class histogram and common-word histogram are compared with
the histograms of each language of the corpus by Jensen-Shannon distance. The
references are summed over all documents of a language. Those of common languages
are there for every document, that of a rare language for its own documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship
from tagmatch.sources.shared import TEXTS_AT_ONCE, small_batches

# Common words of the languages that references are made for.
COMMON_WORDS = (
    "the of and to in a is that for it with as was on are by this be from at or an not "
    "der die und das in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus "
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il "
    "el los del las y se que con por un una para es al lo como más su no o"
).split()
VOCABULARY = tuple(dict.fromkeys(COMMON_WORDS))

# The characters of each class, by code in UTF-8; the rest are controls.
_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_STOPS = b".,;:!?'\"()-"
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, OTHER_MARK, WIDE, CONTROL = range(9)
CLASSES = 9
_FOLLOW = CLASSES  # later bytes of a character, not counted


def _byte_classes() -> np.ndarray:
    classes = np.full(256, CONTROL, dtype=np.uint8)
    classes[33:127] = OTHER_MARK
    classes[ord("a") : ord("z") + 1] = LOWER
    classes[ord("A") : ord("Z") + 1] = UPPER
    classes[ord("0") : ord("9") + 1] = DIGIT
    classes[list(_SPACES)] = SPACE
    classes[list(_STOPS)] = STOP
    classes[list(_SYMBOLS)] = SYMBOL
    classes[128:192] = _FOLLOW
    classes[192:] = WIDE
    return classes


_CLASS_OF = _byte_classes()
_COMMON = [w.encode() for w in VOCABULARY]
#: Odd constants that spread word numbers over 64 bits, one for each place of a window.
_SPREAD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
WINDOW = len(_SPREAD)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the rules.

    A text of fewer than ``guard_words`` words is not judged by divergence: its
    histograms are noise. Noise falls with the root of the length, so a distance may
    be ``max_..._distance + ..._slack / sqrt(words)``. A reference
    of few documents may be odd as a whole, so ``reference_slack`` of the same slack over
    the root of their number is added: verdicts change little by little, not at once, as a language grows. ``reference_share``: the
    reference of a language with this share of all documents is there for the documents
    of all languages. ``max_languages``: the languages of most documents, which have a
    reference; documents of any further ones are judged by the base rules only.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    guard_words: int = 50
    max_class_distance: float = 0.17
    class_slack: float = 1.0
    max_word_distance: float = 0.11
    word_slack: float = 2.1
    reference_slack: float = 0.3
    reference_share: float = 0.01
    max_languages: int = 10_000


FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double, reference_docs long"
)
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance",
         "word_distance", "base_failed", "kept")


def class_histogram(data: bytes) -> np.ndarray:
    """Characters of each class in a UTF-8 text."""
    return np.bincount(_CLASS_OF[np.frombuffer(data, dtype=np.uint8)], minlength=CLASSES + 1)[:CLASSES]


def numbered(words: list[bytes]) -> tuple[dict[bytes, int], np.ndarray]:
    """The distinct words by first use, and each word's number."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    return numbers, np.array([number(w, len(numbers)) for w in words], dtype=np.int64)


def word_histogram(numbers: dict[bytes, int], ids: np.ndarray) -> np.ndarray:
    """Occurrences of each common word, and of all others in the last place."""
    counts = np.zeros(len(_COMMON) + 1, dtype=np.int64)
    found = [(place, numbers[w]) for place, w in enumerate(_COMMON) if w in numbers]
    if found:
        places, own = np.array(found).T
        counts[places] = np.bincount(ids, minlength=len(numbers))[own]
    counts[-1] = len(ids) - counts.sum()
    return counts


def repeated_words(n_distinct: int, ids: np.ndarray) -> int:
    """Words inside 5-word windows that occur twice or more, the first one included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, dtype=np.uint64)
    spread = ids.astype(np.uint64)
    for k in range(WINDOW):
        mixed += spread[k : k + n] * _SPREAD[k]
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    names = ids[:n]  # hashes may collide: number the windows exactly
    for k in range(1, WINDOW):
        _, names = np.unique(names * n_distinct + ids[k : k + n], return_inverse=True)
    found = np.flatnonzero(np.bincount(names)[names] > 1)
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    edges[found] += 1
    edges[found + WINDOW] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    repeated = 0
    for line in data.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(_SPACES):
            seen.add(line)
    return repeated


def js_distance(rows: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row to its nearest reference."""
    if not len(references):
        return np.zeros(len(rows))

    def entropy(p: np.ndarray) -> np.ndarray:
        return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(axis=-1)

    p = rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)
    q = references / np.maximum(references.sum(axis=1, keepdims=True), 1)
    own, theirs = entropy(p), entropy(q)
    nearest = np.full(len(rows), np.inf)
    for reference, its in zip(q, theirs):
        divergence = entropy((p + reference) / 2) - (own + its) / 2
        nearest = np.minimum(nearest, divergence)
    return np.sqrt(np.clip(nearest, 0.0, 1.0))


def _encoded(texts: Iterable[str | None]) -> Iterator[bytes]:
    for text in texts:
        yield b"" if text is None else text.encode()


def _sum_histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per language of a partition: documents and summed histograms."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, data in zip(batch["lang"], _encoded(batch["text"])):
            counts = np.concatenate([[1], class_histogram(data), word_histogram(*numbered(data.split()))])
            if lang in sums:
                sums[lang] += counts
            else:
                sums[lang] = counts
    if sums:
        yield pd.DataFrame(
            {
                "lang": np.repeat(np.array(list(sums), dtype=object), [len(s) for s in sums.values()]),
                "place": np.concatenate([np.arange(len(s)) for s in sums.values()]),
                "n": np.concatenate(list(sums.values())),
            }
        )


@dataclass(frozen=True)
class References:
    """Histograms: of common languages, and of each rare one; and the documents of each."""

    docs: dict[str | None, int]
    common: np.ndarray
    rare: dict[str | None, np.ndarray]


def language_references(docs: DataFrame, share: float = 0.01, most: int = 10_000) -> References:
    """One histogram per language, summed over all its documents: character classes, then
    common words. Languages with ``share`` of all documents are common. Of more than
    ``most`` languages, those of most documents count, so no more rows reach the driver."""
    sums = (
        docs.select("lang", "text")
        .mapInPandas(_sum_histograms, "lang string, place int, n long")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n"))
    )
    by_lang = sums.groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("counts"),
        F.sum(F.when(F.col("place") == 0, F.col("n"))).alias("docs"),
    )
    sized = by_lang.crossJoin(F.broadcast(by_lang.agg(F.sum("docs").alias("total"))))
    sized = sized.orderBy(F.col("docs").desc(), "lang").limit(most)
    is_common = F.col("docs") >= F.col("total") * share
    width = CLASSES + len(VOCABULARY) + 1
    with small_batches(docs.sparkSession):
        found = sized.select("lang", "docs", "counts", is_common.alias("common")).collect()
    rows = sorted(found, key=lambda r: (r["lang"] or "", r["lang"] is not None))
    histograms = [np.array([r["counts"][i + 1] for i in range(width)]) for r in rows]
    return References(
        {r["lang"]: r["docs"] for r in rows},
        np.array([h for r, h in zip(rows, histograms) if r["common"]]).reshape(-1, width),
        {r["lang"]: h for r, h in zip(rows, histograms) if not r["common"]},
    )


def _distances(rows: np.ndarray, langs: np.ndarray, references: References, part: slice) -> np.ndarray:
    """Distance of each row to the nearest reference of a common or its own language."""
    common = references.common[:, part]
    out = np.zeros(len(rows))
    rare = np.array([lang in references.rare for lang in langs], dtype=bool)
    out[~rare] = js_distance(rows[~rare], common)
    for lang in set(langs[rare]):
        own = rare & (langs == lang)
        out[own] = js_distance(rows[own], np.vstack([common, references.rare[lang][None, part]]))
    return out


def _features(references: References):
    names = [c.split()[0] for c in FEATURES.split(", ")]

    def measured(texts: pa.Array, own: pa.Array) -> pa.Array:
        langs = np.array(own.to_pylist(), dtype=object)
        base, classes, commons = [], [], []
        for data in _encoded(texts.to_pylist()):
            numbers, ids = numbered(data.split())
            chars = class_histogram(data)
            blanks = sum(data.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
            base.append(
                (len(ids), int(chars.sum()) - blanks, int(chars[SYMBOL]), duplicate_lines(data),
                 repeated_words(len(numbers), ids))
            )
            classes.append(chars)
            commons.append(word_histogram(numbers, ids))
        by_class = _distances(np.array(classes).reshape(-1, CLASSES), langs, references, slice(None, CLASSES))
        by_word = _distances(
            np.array(commons).reshape(-1, len(VOCABULARY) + 1), langs, references, slice(CLASSES, None)
        )
        known = np.array([references.docs.get(lang, 0) for lang in langs], dtype=np.int64)
        columns = [*np.array(base, dtype=np.int64).reshape(-1, 5).T, by_class, by_word, known]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=names)

    def measure(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, own in batches:  # of one batch, few texts at once become Python objects
            for start in range(0, len(texts), TEXTS_AT_ONCE):
                yield measured(texts.slice(start, TEXTS_AT_ONCE), own.slice(start, TEXTS_AT_ONCE))

    return F.arrow_udf(measure, FEATURES)


def quality_rules(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` (with ``text`` and ``lang``) and the columns ``ADDED``.

    Texts are judged whole. A null text counts as empty and fails the base rules; a
    null ``lang`` is a language of its own. A language's reference holds the text that is
    judged, so the only text of a language passes. Same-named columns are replaced. Rows, repeated
    ones too, are judged one by one; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    references = language_references(docs, rules.reference_share, rules.max_languages)
    rest = [c for c in docs.columns if c not in ADDED]
    measured = docs.select(*rest, _features(references)(F.col("text"), F.col("lang").cast("string")).alias("_quality"))
    q = F.col("_quality")
    failed = (q["n_words"] < rules.min_words) | (
        q["n_repeat_words"] * 100 > q["n_words"] * rules.max_repeat_percent
    )
    noise = 1 / F.sqrt(F.greatest(q["n_words"], F.lit(1)))
    noise += rules.reference_slack / F.sqrt(F.greatest(q["reference_docs"], F.lit(1)))
    near = (q["n_words"] < rules.guard_words) | (q["reference_docs"] == 0) | (
        (q["class_distance"] <= rules.max_class_distance + rules.class_slack * noise)
        & (q["word_distance"] <= rules.max_word_distance + rules.word_slack * noise)
    )
    return measured.select(
        *rest,
        *[q[c].alias(c) for c in ADDED[:-2]],
        failed.alias("base_failed"),
        (~failed & near).alias("kept"),
    )
