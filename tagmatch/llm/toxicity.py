"""Toxicity by a weighted lexicon.

Texts are folded (case, look-alike letters, digits in the place of letters) and
searched for all lexicon words at once by an Aho-Corasick automaton. Words inside an
exception phrase don't count. The sum of weights and its share of the text's length
give the score. Lexicon, weights and the score's scale are learned from labelled texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship
from tagmatch.sources.shared import stored

#: Labelled texts that the lexicon is learned from at most, chosen by a hash of doc_id.
SAMPLE = 20_000
#: A lexicon word is in this many toxic texts that earlier words don't explain.
MIN_TEXTS = 5
#: A text is explained by this many lexicon words.
EXPLAINED_BY = 4
#: Lexicon words are beginnings of words of these lengths; shorter words are no signal.
STEMS = range(4, 9)
#: Least log ratio of its shares of toxic and of clean texts.
MIN_WEIGHT = 2.0

# Letters of other alphabets that look Latin.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһкмтвнґАЕОРСУХІЈЅКМТВНαοενιρτυκςΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhkmtbhraeopcyxijskmtbhaoevipTukcabezhikmnoptyx".lower(),
)
# Digits and signs written for letters.
DIGITS = str.maketrans("01345789@$!|", "oieastbgasil")
# Phrases in which a lexicon word is harmless.
EXCEPTIONS = (
    "idiot proof", "clown fish", "clown nose", "circus clown", "trash can", "trash bin", "take out the trash",
    "stupid question", "no such thing as a stupid question", "sore loser", "pond scum", "pathetic fallacy",
)

# Accents, and characters that are not seen: joiners, marks of direction, soft hyphens.
_UNSEEN = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]+")
_MARKED = re.compile(r"[^\s]*[0-9@$!|][^\s]*")
_HAS_MARKS = re.compile(r"[0-9@$!|]")
#: A sign of punctuation stands for a letter only before another.
_INNER = re.compile(r"[0-9@$]|[!|](?=\w)")
_GAPS = re.compile(r"[\s\-]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def _unmasked(token: re.Match) -> str:
    return _INNER.sub(lambda m: m[0].translate(DIGITS), token[0]) if any(map(str.isalpha, token[0])) else token[0]


def fold(text: str) -> str:
    """The text in lower case: letters of fonts and widths, accented and look-alike ones as
    plain Latin letters, digits and signs as letters in tokens that also have letters,
    characters that are not seen left out, and white space and hyphens as one blank."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(LOOKALIKES))
        text = _UNSEEN.sub("", text).translate(LOOKALIKES)
    text = text.lower()
    if _HAS_MARKS.search(text):
        text = _MARKED.sub(_unmasked, text)
    return _GAPS.sub(" ", text)


@dataclass(frozen=True)
class Lexicon:
    """Words with their weights, harmless phrases, and the score's coefficients: base,
    for the log of the sum of weights, and for the log of the sum per 100 words."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    scale: tuple[float, float, float] = field(default=(-3.0, 2.0, 1.0))


class Matcher:
    """The automaton of a lexicon."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for phrase in lexicon.exceptions:
            self.automaton.add_word(fold(phrase), (len(fold(phrase)), 0.0))
        for word, weight in lexicon.weights.items():
            self.automaton.add_word(word, (len(word), weight))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def total(self, text: str) -> float:
        """Sum of the weights of words that begin like a lexicon word, outside exception
        phrases. A phrase is whole words; its last may have an s more."""
        if self.empty:
            return 0.0
        folded, found, harmless = fold(text), [], []
        for last, (size, weight) in self.automaton.iter(folded):
            start = last - size + 1
            if start and folded[start - 1].isalpha():
                continue
            if weight:
                found.append((start, last, weight))
            elif not _LETTERS.match(folded, last + 1 + folded.startswith("s", last + 1)):
                harmless.append((start, last, weight))
        if not harmless:
            return sum(w for _, _, w in found)
        covered = np.zeros(len(folded), dtype=bool)
        for start, last, _ in harmless:
            covered[start : last + 1] = True
        return sum(w for start, last, w in found if not covered[start : last + 1].all())

    def score(self, text: str | None) -> float:
        text = text or ""
        base, by_sum, by_share = self.lexicon.scale
        x = self._signals(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, base + by_sum * x[0] + by_share * x[1]))))

    def _signals(self, text: str) -> tuple[float, float]:
        total = self.total(text)
        return math.log1p(total), math.log1p(100 * total / max(1, len(text.split()))) if total else 0.0


def stems(text: str | None) -> set[str]:
    """The beginnings of the text's words that could be lexicon words."""
    words = set(_LETTERS.findall(fold(text or "")))
    return {word[:n] for word in words for n in STEMS if len(word) >= n}


def _stem_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of a partition that hold each stem, by label."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[int(toxic)].update(stems(text))
    names = sorted(counts[0].keys() | counts[1].keys())
    yield pd.DataFrame(
        {"word": names, "bad": [counts[1][w] for w in names], "good": [counts[0][w] for w in names]}
    ).astype({"word": object, "bad": "int64", "good": "int64"})


def choose(weights: dict[str, float], texts: list[set[str]]) -> dict[str, float]:
    """The stems that explain the toxic texts, best first.

    A stem is worth its weight for each text that is not explained yet; of equal ones
    the longer is taken. Beginnings and longer forms of a taken stem are out."""
    need = [EXPLAINED_BY] * len(texts)
    worth = Counter(stem for text in texts for stem in text)
    left, taken = dict(weights), {}
    while left:
        best = max(left, key=lambda stem: (worth[stem] * left[stem], len(stem), stem))
        if worth[best] < MIN_TEXTS:
            del left[best]
            continue
        taken[best] = left[best]
        left = {s: w for s, w in left.items() if not s.startswith(best) and not best.startswith(s)}
        for n, text in enumerate(texts):
            if need[n] and best in text:
                need[n] -= 1
                if not need[n]:
                    worth.subtract(text)
    return taken


def _fitted(signals: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic coefficients by Newton's method with a small ridge; slopes stay positive."""
    x = np.column_stack([np.ones(len(signals)), signals])
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (toxic - p) - 0.01 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        beta = beta + np.linalg.solve(curve, slope)
    if beta[1] < 0 or beta[2] < 0:
        one = 1 if beta[2] < 0 else 2
        kept = _fitted(np.column_stack([signals[:, one - 1], np.zeros(len(signals))]), toxic)
        return (kept[0], kept[1], 0.0) if one == 1 else (kept[0], 0.0, kept[1])
    return float(beta[0]), float(beta[1]), float(beta[2])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Stems are taken only while they explain toxic texts that those before don't, so
    that words that merely come with others, or with copies of one text, stay out. At
    most ``sample`` labelled texts, by a hash of doc_id, are used. Of several texts of a
    doc_id the greatest is learned from, and of several labels the toxic one.
    Without toxic or clean texts the lexicon is empty and all scores are low.
    """
    ship(docs.sparkSession)
    chosen = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    labelled = docs.select("doc_id", "text").join(chosen, "doc_id")
    labelled = stored(labelled.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")), "labelled")
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon({})
    counts = labelled.select("text", "toxic").mapInPandas(_stem_counts, "word string, bad long, good long")
    counts = counts.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    heavy = counts.filter(F.col("bad") >= MIN_TEXTS).select("word", weight.alias("weight"))
    # Stems in five texts or more of a bounded sample, and that sample's toxic texts.
    weights = {r["word"]: r["weight"] for r in heavy.filter(F.col("weight") >= MIN_WEIGHT).collect()}

    def held(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(stems(t) & weights.keys()))

    rows = labelled.filter("toxic = 1").select(F.pandas_udf(held, "array<string>")("text").alias("w")).collect()
    taken = choose(weights, [set(r["w"]) for r in rows])
    draft = Lexicon(taken)

    def signals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(draft)
        for batch in batches:
            both = [matcher._signals(t or "") for t in batch["text"]]
            yield pd.DataFrame({"a": [x for x, _ in both], "b": [y for _, y in both], "toxic": batch["toxic"].astype("int64")})

    seen = np.array(
        [tuple(r) for r in labelled.select("text", "toxic").mapInPandas(signals, "a double, b double, toxic long").collect()]
    )
    return Lexicon(taken, EXCEPTIONS, _fitted(seen[:, :2], seen[:, 2]))


def with_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more).

    Whole texts are searched; a null text counts as empty and has the score of a text
    without lexicon words. Rows are scored one by one. Same-named columns are replaced.
    """
    ship(docs.sparkSession)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(lexicon)
        for texts in batches:
            yield pd.Series([matcher.score(t) for t in texts], dtype="float64")

    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*rest, F.pandas_udf(scores, "double")("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
