"""Language of a text by its words, and for unseen words by shorter and shorter character n-grams.

A known word scores its log frequency in each language. A word that was not learned is marked at both
ends and scores the mean log frequency of its longest n-grams that were learned, from length
``LONGEST`` down to 1. The prediction is the language with the greatest sum; its score is its share
after the sums, held to ``EVIDENCE`` words, are turned into odds.

The model is learned from a bounded sample: ``DOCUMENTS`` documents per language on average, chosen by
a hash of the id. It keeps counts of a word, or n-gram, in a language: the ``WORDS`` and ``GRAMS`` most
frequent ones by their share of the language, so that every language has its own and none is left out
for being rare. What the model holds is bounded by these two numbers, whatever the number of languages:
scores are kept as what a count adds to the score of a word that the language has not. Every text is predicted whole, and n-grams are taken of whole words, however long:
text without blanks is one word.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled row
every text is ``und``; a null id is neither held out nor learned from; repeated rows are predicted
alike; further columns are not looked at; an empty table gives no rows; ties go to the language that
comes first by name.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage

UNKNOWN = "und"
DOCUMENTS = 3000
WORDS = 120_000
GRAMS = 60_000
LONGEST = 4
EVIDENCE = 40
#: Scores of words, by language, that a worker remembers beyond the learned ones, and their greatest length.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 60
#: Starts of n-grams in one slice of a word; slices overlap by ``LONGEST - 1`` characters.
_SLICE = 57

_WORDS = re.compile(r"[^\W\d_]+")
_SMOOTHING = 0.5


#: Number of a language and what an entry adds to its score.
Gains = tuple[tuple[int, float], ...]


class Model(NamedTuple):
    """Log frequencies by word and by n-gram.

    ``word_base`` and ``gram_base`` hold the log frequency, by language, of an entry that the language
    has not; ``words`` and ``grams`` what is added for the languages that have it.
    """

    languages: tuple[str, ...]
    words: dict[str, Gains]
    grams: dict[str, Gains]
    word_base: tuple[float, ...]
    gram_base: tuple[float, ...]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _marked(word: str) -> str:
    return f"^{word}$"


def _sample(labelled: DataFrame) -> DataFrame:
    """About ``DOCUMENTS`` rows of each language."""
    counts = cut_lineage(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    scale = 1 << 30
    share = F.least(F.lit(1.0), F.lit(DOCUMENTS) / F.col("rows"))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < (F.lit(scale) * share).cast("long")
    return labelled.join(counts, "lang").where(chosen).select("lang", "text")


def _log_frequencies(rows: list, place: dict[str, int]) -> dict[str, Gains]:
    """What each entry adds, from rows (entry, language, count)."""
    gains: dict[str, list[tuple[int, float]]] = {}
    for entry, language, count in rows:
        gains.setdefault(entry, []).append((place[language], math.log(count + _SMOOTHING) - math.log(_SMOOTHING)))
    return {entry: tuple(found) for entry, found in gains.items()}


def _base(totals: dict[str, int], languages: list[str], entries: int) -> tuple[float, ...]:
    return tuple(
        math.log(_SMOOTHING) - math.log(totals.get(x, 0) + _SMOOTHING * (entries + 1)) for x in languages
    )


def _top(counts: DataFrame, totals: DataFrame, entry: str, limit: int) -> list[tuple[str, str, int]]:
    """The most frequent entries by share within their language: entry, language and count."""
    rows = (
        counts.join(totals, "lang")
        .withColumn("share", F.col("n") / F.col("total"))
        .orderBy(F.desc("share"), entry, "lang")
        .limit(limit)
        .select(entry, "lang", "n")
    )
    arrow = rows.toArrow()
    return list(zip(*[arrow.column(i).to_pylist() for i in range(3)]))


def _totals(counts: DataFrame) -> DataFrame:
    return cut_lineage(counts.groupBy("lang").agg(F.sum("n").alias("total")))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the labelled documents that are not held out."""
    labelled = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    ).where(F.col("lang").isNotNull() & (remainder(F.col("doc_id")) != 2))
    sample = _sample(labelled)
    letters = F.split(F.lower(F.col("text").cast("string")), r"\P{L}+")
    words = cut_lineage(
        sample.select("lang", F.explode(letters).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sliced = F.regexp_extract_all(
        F.concat(F.lit("^"), "word", F.lit("$")),
        F.lit(f"(?s)(?=(.{{1,{_SLICE + LONGEST - 1}}})).{{1,{_SLICE}}}"),
        F.lit(1),
    )
    grams = cut_lineage(
        words.select("lang", "n", F.explode(sliced).alias("word"))
        .select("lang", "n", "word", F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("size"))
        .where(F.length("word") >= F.col("size"))
        .select(
            "lang",
            "n",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.least(F.length("word") - F.col("size") + 1, F.lit(_SLICE))),
                    lambda at: F.substring("word", at, F.col("size")),
                )
            ).alias("gram"),
        )
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    word_totals, gram_totals = _totals(words), _totals(grams)
    top_words = _top(words, word_totals, "word", WORDS)
    top_grams = _top(grams, gram_totals, "gram", GRAMS)
    languages = sorted({row[1] for row in top_words} | {row[1] for row in top_grams})
    place = {language: i for i, language in enumerate(languages)}
    learned = docs.sparkSession.createDataFrame([(x,) for x in languages], "lang string")

    def base(totals: DataFrame, entries: int) -> tuple[float, ...]:
        found = totals.join(learned, "lang", "left_semi").collect()  # as many rows as entries at most
        return _base({row["lang"]: row["total"] for row in found}, languages, entries)

    return Model(
        tuple(languages),
        _log_frequencies(top_words, place),
        _log_frequencies(top_grams, place),
        base(word_totals, WORDS),
        base(gram_totals, GRAMS),
    )


_NEITHER, _WORD, _GRAM = range(3)
#: Different words of a text that are looked up at once.
_AT_ONCE = 8192


class Predictor(dict):
    """Words with the row that holds the base they score from and their gains.

    Unseen words are added up to a bound. The gains of all rows lie in two arrays, one row behind the other,
    so that those of all words of a text are taken and summed up at once.
    """

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.bases = np.zeros((3, len(model.languages)))
        self.bases[_WORD], self.bases[_GRAM] = model.word_base, model.gram_base
        self._start()

    def _start(self) -> None:
        """Only the learned words are known."""
        self.clear()
        known = self.model.words
        self.update(zip(known, range(len(known))))
        self.rows = len(known)
        sizes = np.fromiter(map(len, known.values()), np.int64, self.rows)
        self.held = int(sizes.sum())
        self.kind = np.full(self.rows + 1, _WORD)
        self.size = np.append(sizes, 0)
        self.start = np.cumsum(self.size) - self.size
        self.language = np.zeros(self.held + 1, np.int64)
        self.gain = np.zeros(self.held + 1)
        self.language[: self.held] = [at for gains in known.values() for at, _ in gains]
        self.gain[: self.held] = [gain for gains in known.values() for _, gain in gains]
        self.full = self.rows + self.held + REMEMBERED

    def _add(self, kind: int, gains: Gains) -> int:
        row, at, upto = self.rows, self.held, self.held + len(gains)
        if row >= len(self.kind):
            self.kind, self.size, self.start = (np.append(x, np.zeros_like(x)) for x in (self.kind, self.size, self.start))
        while upto > len(self.gain):
            self.language, self.gain = (np.append(x, np.zeros_like(x)) for x in (self.language, self.gain))
        self.kind[row], self.size[row], self.start[row] = kind, len(gains), at
        self.language[at:upto] = [language for language, _ in gains]
        self.gain[at:upto] = [gain for _, gain in gains]
        self.rows, self.held = row + 1, upto
        return row

    def __missing__(self, word: str) -> int:
        row = self._add(*self._back_off(_marked(word)))
        if len(word) <= REMEMBERED_LENGTH:
            self[word] = row
        return row

    def _back_off(self, word: str) -> tuple[int, Gains]:
        for size in range(min(LONGEST, len(word)), 0, -1):
            pieces = (word[i : i + size] for i in range(len(word) - size + 1))
            known = Counter(p for p in pieces if p in self.model.grams)
            if known:
                sums: dict[int, float] = {}
                for piece, n in known.items():
                    for at, gain in self.model.grams[piece]:
                        sums[at] = sums.get(at, 0.0) + gain * n
                return _GRAM, tuple((at, total / known.total()) for at, total in sums.items())
        return _NEITHER, ()

    def _sums(self, found: Counter) -> np.ndarray:
        words = list(found)
        sums = np.zeros(len(self.model.languages))
        for first in range(0, len(words), _AT_ONCE):
            if self.rows + self.held > self.full:
                self._start()
            part = words[first : first + _AT_ONCE]
            rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            counts = np.fromiter(map(found.__getitem__, part), float, len(part))
            sums += np.bincount(self.kind[rows], counts, 3) @ self.bases
            size = self.size[rows]
            skipped = np.cumsum(size) - size
            taken = np.arange(size.sum()) + np.repeat(self.start[rows] - skipped, size)
            sums += np.bincount(self.language[taken], self.gain[taken] * np.repeat(counts, size), len(sums))
        return sums

    def scores(self, word: str) -> tuple[float, ...]:
        """The log frequency of one word in each language, 0 where nothing of it was learned."""
        return tuple(self._sums(Counter([word])).tolist())

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.languages:
            return UNKNOWN, 0.0
        found = Counter(_WORDS.findall(text.lower()))
        if not any(any(map(str.isalpha, word)) for word in found):
            return UNKNOWN, 0.0
        sums = self._sums(found)
        best = int(np.argmax(sums))
        total = found.total()
        odds = np.exp((sums - sums[best]) * (min(total, EVIDENCE) / total))
        return self.model.languages[best], float(1 / odds.sum())


def predict(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: its id, held_out, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    number = uuid.uuid4().hex

    def start() -> Callable:
        return common.loaded(number, lambda: Predictor(Model(*shared.value))).predict

    held_out = F.coalesce(remainder(F.col(doc_id)) == 2, F.lit(False)).alias("held_out")
    return common.map_rows(
        docs.select(F.col(doc_id), held_out, F.col(text).cast("string")),
        "lang_pred string, score double",
        start,
        passed=2,
    )


def known_rows(
    docs: DataFrame,
    model: Model,
    least: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """The documents whose language is recognised, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    common.importable(docs.sparkSession)
    number = uuid.uuid4().hex

    @F.pandas_udf("boolean")
    def known(texts):
        predict_one = common.loaded(number, lambda: Predictor(Model(*shared.value))).predict
        found = [predict_one(content) for content in texts]
        return type(texts)([language != UNKNOWN and score >= least for language, score in found])

    return docs.where(known(F.col(text).cast("string")))
