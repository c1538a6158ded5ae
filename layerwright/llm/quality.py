"""Document quality by co-training on two views.

One classifier sees the text (its words, hashed, and its style), the other the metadata (language,
source, length). Both start from labelled documents. In each round either one labels the unlabelled
documents it is sure of, for the other to learn from. At the end both views are calibrated on labelled
documents kept apart, and a third small classifier, fitted on those, joins the two.

Bounds: at most ``LABELLED`` labelled documents, those of the smallest hash of the id, are learned from,
on the driver. All unlabelled documents take part in every round: their features are made in one pass
over the texts, told from the labelled ones by a join of these narrow rows, and written once; each Newton
step sums up, by partition, what the sure ones among them add to its gradient and Hessian.

Defined cases: a null text is an empty one; null metadata is a value of its own; labels with a null
quality or id are not looked at, of several labels of a document the greatest counts; without labels of
both kinds every score is the share of good labels, 0.5 without any; rows with a repeated id are scored
by their own text, and the one of the smallest text hash is learned from where the id has a label; an
empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage

LABELLED = 8000
ROUNDS = 4
#: Calibrated probability from which a classifier is sure, and its share of labelled documents kept apart.
SURE = 0.95
APART = 0.25
#: Newton's method ends at a step this small. Partial sums are added in this many tasks for the driver.
_STILL = 1e-8
_MERGED = 8
#: Documents summed up at a time.
_BLOCK = 2048

WORD_CELLS = 256
SOURCE_CELLS = 64
LANG_CELLS = 16
STYLE = 9

_WORDS = re.compile(r"\w+")
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_CLOSE = b".,;:?'\"-"


def _cell(value: str, cells: int) -> int:
    return zlib.crc32(value.encode(errors="replace")) % cells


class Cells(dict):
    """Hash cells of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        cell = self[word] = _cell(word, WORD_CELLS)
        return cell


def text_features(text: str, cells: Cells) -> np.ndarray:
    """Style of a text, and the share of its words in each hash cell."""
    raw = text.encode(errors="replace")
    size = len(raw) or 1
    lines = text.split("\n")
    parts = text.split()
    counts = Counter(_WORDS.findall(text.lower()))
    total = sum(counts.values()) or 1

    def share(kinds: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kinds))) / size

    symbols = share(_SYMBOLS)
    style = [
        share(_UPPER),
        share(_DIGITS),
        symbols,
        symbols - share(_CLOSE),
        len(set(lines)) / len(lines),
        len(counts) / total,
        len(parts) / size * 5,
        math.log1p(len(parts)) / 10,
        max(map(len, lines)) / size,
    ]
    hashed = np.zeros(WORD_CELLS, np.float32)
    np.add.at(hashed, [cells[word] for word in counts], list(counts.values()))
    return np.concatenate([np.array(style, np.float32), np.sqrt(hashed / total)])


def metadata_features(lang: str | None, source: str | None, size: int | None) -> np.ndarray:
    found = np.zeros(LANG_CELLS + SOURCE_CELLS + 2, np.float32)
    found[_cell(f"lang {lang}", LANG_CELLS)] = 1
    found[LANG_CELLS + _cell(f"source {source}", SOURCE_CELLS)] = 1
    found[-2] = math.log1p(max(0, size or 0)) / 10
    found[-1] = size is None
    return found


class Linear(NamedTuple):
    """A logistic classifier on scaled features."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    def logit(self, features: np.ndarray) -> np.ndarray:
        return (features - self.middle) / self.scale @ self.weights + self.offset


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Linear:
    """Penalised logistic regression by Newton's method."""
    features = features.astype(np.float64)
    middle, scale = features.mean(0), features.std(0)
    scale[scale < 1e-9] = 1.0
    given = np.hstack([(features - middle) / scale, np.ones((len(features), 1))])
    penalty = np.full(given.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(given.shape[1])
    for _ in range(steps):
        chance = sigmoid(given @ weights)
        slope = given.T @ (chance - labels) + penalty * weights
        bend = (given * (chance * (1 - chance) + 1e-6)[:, None]).T @ given + np.diag(penalty)
        weights -= np.linalg.solve(bend, slope)
    return Linear(middle, scale, weights[:-1], float(weights[-1]))


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


class Model(NamedTuple):
    """Both views with their calibration, and the classifier that joins them."""

    text: Linear | None
    metadata: Linear | None
    text_calibration: Linear | None
    metadata_calibration: Linear | None
    joint: Linear | None
    base: float

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Columns: joint score, text score, metadata score."""
        if self.joint is None:
            return np.full((len(text), 3), self.base)
        first = self.text_calibration.logit(self.text.logit(text)[:, None])
        second = self.metadata_calibration.logit(self.metadata.logit(metadata)[:, None])
        joint = self.joint.logit(np.stack([first, second], 1))
        return sigmoid(np.stack([joint, first, second], 1))


def _taught(other: np.ndarray, teachers: list) -> np.ndarray:
    """Marks of unlabelled documents by the view ``other``: of its first round that is sure, else -1."""
    marks = np.full(len(other), -1)
    for model, calibration in teachers:
        chance = sigmoid(calibration.logit(model.logit(other)[:, None]))
        for kind, sure in ((1, chance >= SURE), (0, chance <= 1 - SURE)):
            marks[(marks < 0) & sure] = kind
    return marks


def _sums(features: np.ndarray, marks: np.ndarray, at: Linear | None) -> np.ndarray:
    """What marked documents add: to count, sums and squares, or at a classifier to gradient and Hessian."""
    features = features.astype(np.float64)
    if at is None:
        return np.concatenate([[len(marks)], features.sum(0), np.square(features).sum(0)])
    given = np.hstack([(features - at.middle) / at.scale, np.ones((len(features), 1))])
    chance = sigmoid(given @ np.append(at.weights, at.offset))
    bend = (given * (chance * (1 - chance) + 1e-6)[:, None]).T @ given
    return np.concatenate([given.T @ (chance - marks), bend.ravel()])


def pool_sums(views: list[np.ndarray], asked: list) -> np.ndarray:
    """Sums over unlabelled documents, for each view asked (view, teachers, classifier), in a row."""
    found = []
    for view, teachers, at in asked:
        marks = _taught(views[1 - view], teachers)
        sure = marks >= 0
        found.append(_sums(views[view][sure], marks[sure], at))
    return np.concatenate(found)


Pool = Callable[[list], np.ndarray]


def _fit_views(
    views: list[np.ndarray], labels: np.ndarray, teachers: list, pool: Pool, ridge: float = 1.0, steps: int = 12
) -> tuple[list, list[int]]:
    """Both views fitted to the labelled and the sure documents, as ``fit`` does, and the counts of the latter."""

    def asked(at: list) -> list[np.ndarray]:
        own = [_sums(view, labels, x) for view, x in zip(views, at)]
        more = pool([(i, teachers[i], at[i]) for i in (0, 1)])
        cut = len(own[0])
        return [(own[0], more[:cut]), (own[1], more[cut:])]

    start, counts, models = asked([None, None]), [], []
    for view, (own, more) in zip(views, start):
        counts.append(int(more[0]))
        width = view.shape[1]
        n, total, squares = np.split(own + more, [1, 1 + width])
        middle = total / n
        scale = np.sqrt(np.maximum(squares / n - middle**2, 0))
        scale[scale < 1e-7] = 1.0
        models.append(Linear(middle, scale, np.zeros(width), 0.0))
    for _ in range(steps):
        largest = 0.0
        for i, (own, more) in enumerate(asked(models)):
            model = models[i]
            weights = np.append(model.weights, model.offset)
            penalty = np.append(np.full(len(weights) - 1, ridge), 1e-6)
            slope, bend = np.split(own + more, [len(weights)])
            step = np.linalg.solve(bend.reshape(len(weights), -1) + np.diag(penalty), slope + penalty * weights)
            weights -= step
            largest = max(largest, float(np.abs(step).max()))
            models[i] = Linear(model.middle, model.scale, weights[:-1], float(weights[-1]))
        if largest < _STILL:
            break
    return models, counts


def co_train(
    text: np.ndarray,
    metadata: np.ndarray,
    labels: np.ndarray,
    rounds: int = ROUNDS,
    pool: Pool | None = None,
) -> Model:
    """Learn both views; ``labels`` are 0, 1, or -1 for the unlabelled documents, unless ``pool`` sums these up."""
    known = np.flatnonzero(labels >= 0)
    base = float(labels[known].mean()) if len(known) else 0.5
    every = max(2, round(1 / APART))
    apart = np.concatenate(
        [np.flatnonzero(labels == kind)[::every] for kind in (0, 1)]
    )
    learned = np.setdiff1d(known, apart)
    if any(len(set(labels[rows])) < 2 for rows in (learned, apart)):
        return Model(None, None, None, None, None, base)
    views = [text, metadata]
    if pool is None:
        free = [view[labels < 0] for view in views]
        pool = partial(pool_sums, free)

    def calibrate(models: list) -> list:
        return [fit(m.logit(v[apart])[:, None], labels[apart], ridge=0.1) for m, v in zip(models, views)]

    models = [fit(view[learned], labels[learned]) for view in views]
    calibrated = calibrate(models)
    teachers: list[list] = [[], []]
    counts = [0, 0]
    for _ in range(rounds):
        for one, other in ((0, 1), (1, 0)):
            teachers[other].append((models[one], calibrated[one]))
        fitted, sure = _fit_views([v[learned] for v in views], labels[learned], teachers, pool)
        if sure == counts:
            break
        models, counts = fitted, sure
        calibrated = calibrate(models)
    logits = [c.logit(m.logit(v[apart])[:, None]) for c, m, v in zip(calibrated, models, views)]
    joint = fit(np.stack(logits, 1), labels[apart], ridge=0.1)
    return Model(*models, *calibrated, joint, base)


def _given(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    columns = {name.lower() for name in docs.columns}

    def optional(name: str, kind: str):
        return (F.col(name) if name in columns else F.lit(None)).cast(kind).alias(name)

    return docs.select(
        F.col(doc_id).alias("doc_id"),
        common.text_or_empty(text).alias("text"),
        optional("lang", "string"),
        optional("source", "string"),
        optional("n_chars", "long"),
    )


def _viewer() -> Callable:
    cells = Cells()
    return lambda content, lang, source, size: (
        text_features(content, cells),
        metadata_features(lang, source, size),
    )


def spark_pool(rows: DataFrame, marks: DataFrame | None = None) -> Pool:
    """Sums over the documents (text, lang, source, n_chars), whose features are written at the first call.

    With ``marks``, rows start with doc_id and those whose id is among the marks are left out. Features
    meet the marks by a shuffle whatever the sizes, so that the plan is the same for any input.
    """
    width = STYLE + WORD_CELLS
    written: list[DataFrame] = []

    def start() -> Callable:
        view = _viewer()
        return lambda *given: (np.concatenate(view(*given)).astype(np.float32).tobytes(),)

    def pool(asked: list) -> np.ndarray:
        if not written:
            views = common.map_rows(rows, "views binary", start, passed=0 if marks is None else 1)
            if marks is not None:
                views = views.join(marks.select("doc_id").hint("merge"), "doc_id", "left_anti").select("views")
            written.append(cut_lineage(views))
        plain = [
            (view, [tuple(map(tuple, pair)) for pair in teachers], at and tuple(at)) for view, teachers, at in asked
        ]

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = [
                (view, [(Linear(*m), Linear(*c)) for m, c in teachers], at and Linear(*at))
                for view, teachers, at in plain
            ]
            total = 0
            for batch in batches:
                for raw in common.in_slices(batch.column(0).to_pylist(), _BLOCK):
                    both = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1)
                    total = total + pool_sums([both[:, :width], both[:, width:]], asked)
            if not isinstance(total, int):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                for raw in batch.column(0):
                    total = total + np.frombuffer(raw.as_py())
            if not isinstance(total, int):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

        parts = written[0].mapInArrow(each, "sums binary").repartition(_MERGED).mapInArrow(merged, "sums binary")
        none = pool_sums([np.zeros((0, width), np.float32), np.zeros((0, LANG_CELLS + SOURCE_CELLS + 2))], asked)
        return sum((np.frombuffer(row["sums"]) for row in parts.collect()), none)

    return pool


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    labelled: int = LABELLED,
) -> Model:
    """Learn from a bounded sample of labelled documents and from all unlabelled ones."""
    given = _given(docs, doc_id, text)
    marks = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max("label") > 0).cast("int").alias("label"))
    )
    chosen = marks.orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(labelled)
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "lang", "source", "n_chars", "label"))
    rows = given.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(one.alias("one"))
    rows = rows.select("one.label", "one.text", "one.lang", "one.source", "one.n_chars")
    table = common.map_rows(rows, "text_view array<float>, metadata_view array<float>", _viewer).toArrow()
    if not table.num_rows:
        return Model(None, None, None, None, None, 0.5)
    views = [
        np.stack(table.column(name).combine_chunks().to_numpy(zero_copy_only=False))
        for name in ("text_view", "metadata_view")
    ]
    found = table.column("label").to_numpy()
    order = np.lexsort([*views[0].T[:STYLE], found])  # the same order whatever the order of the rows
    return co_train(views[0][order], views[1][order], found[order], pool=spark_pool(given, marks))


def score(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, score, text_score and metadata_score, each the chance of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def start() -> Callable:
        cells = Cells()
        judge = Model(*[Linear(*part) if isinstance(part, tuple) else part for part in shared.value])

        def one(content: str, lang: str | None, source: str | None, size: int | None) -> tuple:
            text_view = text_features(content, cells)[None]
            return tuple(judge.scores(text_view, metadata_features(lang, source, size)[None])[0].tolist())

        return one

    return common.map_rows(
        _given(docs, doc_id, text),
        "score double, text_score double, metadata_score double",
        start,
    )
