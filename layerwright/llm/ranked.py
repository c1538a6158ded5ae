"""Ranked lexical search: the documents with the highest summed term impacts for each query text.

Documents are held in segments. A segment keeps, for each term that a query has, the documents that hold
it with their impacts, and a sparse table of range maxima over these impacts: row ``j`` has the place of
the highest impact of every run of ``2 ** j`` postings. So the highest impact of a term within any interval
of documents is found in two look-ups, and the sum over a query's terms bounds what a document of the
interval can score.

A search keeps intervals by their bound. The best one is split at the document of highest impact for the
term that contributes most to the bound; that document is scored, and both sides go back with their own
bounds. Intervals of up to ``LEAF`` documents are scored whole, posting by posting. It ends when no bound
reaches the score of the lowest document kept. A task carries what it keeps for a query on from segment
to segment; the tasks' results are merged by score.

Counts of documents and terms come from all documents. Query texts are taken in blocks of about
``BLOCK_TERMS`` terms, each of which is a pass over the documents; one block at a time is sent to tasks.

Defined cases: a null text has no terms, and neither counts nor is found; a query without terms finds
nothing; only scores above 0 count, and equal ones go by ascending id, a null id last; rows with a
repeated id are documents of their own; a repeated query id is a query of its own; empty tables give no
rows; further columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage

TOP = 20
#: Terms of the queries that are looked for in one pass.
BLOCK_TERMS = 1_000_000
#: Documents, and postings, at which a segment is closed.
SEGMENT = 16_384
POSTINGS = 1 << 20
#: Documents of an interval that is scored whole.
LEAF = 256

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def text_terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").encode(errors="replace").lower().decode())  # bytes: A to Z only


class Queries(NamedTuple):
    """A block of query texts: their row numbers, and per text its term numbers with their counts."""

    numbers: list[int]
    vocabulary: dict[str, int]
    wanted: list[tuple[np.ndarray, np.ndarray]]


def _block(numbers: list[int], texts: list[str | None]) -> Queries:
    vocabulary: dict[str, int] = {}
    wanted = []
    for text in texts:
        counts = Counter(text_terms(text))
        found = [vocabulary.setdefault(term, len(vocabulary)) for term in counts]
        wanted.append((np.array(found, np.int64), np.array(list(counts.values()), np.int64)))
    return Queries(numbers, vocabulary, wanted)


_SEGMENT = "ids binary, missing binary, sizes binary, held binary, starts binary, docs binary, counts binary"


def _segments(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Rows (doc_id, text) as segments, written out: arrays of document ids and sizes, and of postings by term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        ids, sizes, terms, counts, lengths, n = [], [], [], [], [], 0

        def closed() -> pa.RecordBatch:
            places = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            number = np.array(terms, np.int64)
            order = np.argsort(number, kind="stable")
            held, starts = np.unique(number[order], return_index=True)
            parts = [
                np.array([i or 0 for i in ids], np.int64),
                np.array([i is None for i in ids], bool),
                np.array(sizes, np.int64),
                held,
                np.append(starts, len(number)).astype(np.int64),
                places[order],
                np.array(counts, np.int64)[order],
            ]
            columns = [pa.array([part.tobytes()], pa.binary()) for part in parts]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SEGMENT.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, common.SLICE):
                part = batch.slice(at, common.SLICE)
                for doc_id, text in zip(*[column.to_pylist() for column in part.columns]):
                    every = text_terms(text)
                    if not every:
                        continue
                    found = {known[t]: c for t, c in Counter(every).items() if t in known}
                    ids.append(doc_id)
                    sizes.append(len(every))
                    lengths.append(len(found))
                    terms.extend(found)
                    counts.extend(found.values())
                    n += len(found)
                    if len(ids) >= SEGMENT or n >= POSTINGS:
                        yield closed()
                        ids, sizes, terms, counts, lengths, n = [], [], [], [], [], 0
        if ids:
            yield closed()

    return cut_lineage(docs.mapInArrow(run, _SEGMENT))


class Weights(NamedTuple):
    """What the score takes from all documents: their number, their terms, and a weight per term."""

    documents: int
    terms: int
    weights: np.ndarray


def _weights(segments: DataFrame, terms: int) -> Weights:
    """Sums over all segments. Each task sums up its own, ranges of terms are added on, one row each."""
    width = 4096

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, total = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            sizes, held, starts = (
                [np.frombuffer(raw, np.int64) for raw in batch.column(i).to_pylist()] for i in range(3)
            )
            for size, numbers, start in zip(sizes, held, starts):
                documents += len(size)
                total += int(size.sum())
                holding[numbers] += np.diff(start)
        rows = [(-2, [documents]), (-1, [total])]
        rows += [(at, holding[at : at + width]) for at in range(0, terms, width)]
        for at, values in rows:
            values = np.asarray(values)
            if values.any():
                places = pa.array(np.flatnonzero(values) + at)
                yield pa.RecordBatch.from_arrays([places, pa.array(values[values != 0])], ["place", "n"])

    parts = segments.select("sizes", "held", "starts").mapInArrow(each, "place long, n long")
    summed = parts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(summed.column("place").to_pylist(), summed.column("n").to_pylist()))
    documents, total = found.get(-2, 0), found.get(-1, 0)
    weights = [
        math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(term, 0) + 1))) for term in range(terms)
    ]
    return Weights(documents, total, np.array(weights, np.int64))


class Postings(NamedTuple):
    """A term within a segment: its documents, their impacts, and the sparse table of places of maxima."""

    docs: np.ndarray
    impacts: np.ndarray
    table: np.ndarray


def range_table(impacts: np.ndarray) -> np.ndarray:
    """Row ``j``: for each place that of the highest impact among ``2 ** j`` from there; rows are filled up."""
    rows = [np.arange(len(impacts), dtype=np.int32)]
    step = 1
    while 2 * step <= len(impacts):
        left, right = rows[-1][: len(impacts) - 2 * step + 1], rows[-1][step : len(impacts) - step + 1]
        best = np.where(impacts[left] >= impacts[right], left, right)
        rows.append(np.concatenate([best, np.zeros(len(impacts) - len(best), np.int32)]))
        step *= 2
    return np.stack(rows)


class Segment:
    """The postings of a segment, with the look-ups of a search."""

    def __init__(self, raw: tuple[bytes, ...], weights: Weights) -> None:
        kinds = (np.int64, bool, np.int64, np.int64, np.int64, np.int32, np.int64)
        self.ids, self.missing, sizes, held, self.starts, self.docs, counts = (
            np.frombuffer(part, kind) for part, kind in zip(raw, kinds)
        )
        self.place = {int(term): i for i, term in enumerate(held)}
        lengths = 75 + (25 * sizes * weights.documents) // weights.terms
        share = (1_000_000_000 * counts) // (1000 * counts + 12 * lengths[self.docs])
        self.impacts = np.repeat(weights.weights[held], np.diff(self.starts)) * share
        self.tables: dict[int, np.ndarray] = {}

    def postings(self, at: int) -> Postings:
        """Those of the term at ``at``; its table is made when it is first asked for."""
        here = slice(self.starts[at], self.starts[at + 1])
        if at not in self.tables:
            self.tables[at] = range_table(self.impacts[here])
        return Postings(self.docs[here], self.impacts[here], self.tables[at])


class Search:
    """The intervals of one query over one segment."""

    def __init__(self, segment: Segment, wanted: tuple[np.ndarray, np.ndarray]) -> None:
        found = [(segment.place[t], n) for t, n in zip(wanted[0].tolist(), wanted[1]) if t in segment.place]
        self.segment = segment
        self.times = np.array([n for _, n in found], np.int64)
        lists = [segment.postings(at) for at, _ in found]
        self.lists = lists
        self.sizes = np.array([len(p.docs) for p in lists], np.int64)
        depth = max((len(p.table) for p in lists), default=1)
        # all terms side by side: postings in a row, and rows of the tables with them
        self.offsets = np.append(0, np.cumsum(self.sizes))[:-1]
        self.docs = np.concatenate([p.docs for p in lists]) if lists else np.zeros(0, np.int32)
        self.impacts = (
            np.concatenate([p.impacts * n for p, n in zip(lists, self.times)]) if lists else np.zeros(0, np.int64)
        )
        self.table = np.zeros((depth, len(self.docs)), np.int32)
        for p, offset in zip(lists, self.offsets):
            self.table[: len(p.table), offset : offset + len(p.docs)] = p.table + offset

    def bound(self, low: np.ndarray, high: np.ndarray) -> tuple[int, int]:
        """The sum of the terms' highest impacts among postings ``low`` to ``high``, and where the largest is."""
        some = np.flatnonzero(high > low)
        if not len(some):
            return 0, -1
        first, size = low[some], high[some] - low[some]
        row = np.frexp(size)[1] - 1
        left, right = self.table[row, first], self.table[row, high[some] - (1 << row)]
        best = np.where(self.impacts[left] >= self.impacts[right], left, right)
        values = self.impacts[best]
        return int(values.sum()), int(best[values.argmax()])

    def cut(self, low: np.ndarray, high: np.ndarray, doc: int) -> np.ndarray:
        """Per term the first posting from ``low`` to ``high`` whose document is ``doc`` or a later one."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            less = self.docs[middle] < doc
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]

    def whole(self, low: np.ndarray, high: np.ndarray, start: int, end: int) -> np.ndarray:
        """The scores of the documents ``start`` to ``end``."""
        sizes = high - low
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(low - ends + sizes, sizes)
        scores = np.zeros(end - start, np.int64)
        np.add.at(scores, self.docs[at] - start, self.impacts[at])
        return scores


class Kept:
    """The best documents of a query so far, as a heap whose first entry is the lowest of them."""

    def __init__(self, top: int) -> None:
        self.top, self.heap = top, []

    def add(self, score: int, missing: bool, doc_id: int) -> None:
        entry = (score, not missing, -doc_id)
        if len(self.heap) < self.top:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    @property
    def least(self) -> int:
        """A document below this score is not kept."""
        return self.heap[0][0] if len(self.heap) == self.top else 1


def search(segment: Segment, wanted: tuple[np.ndarray, np.ndarray], kept: Kept) -> int:
    """Offer ``kept`` every document of the segment that may belong there; the number of intervals opened."""
    state = Search(segment, wanted)
    low, high = state.offsets.copy(), state.offsets + state.sizes
    bound, best = state.bound(low, high)
    waiting, order, opened = [(-bound, 0, 0, len(segment.ids), low, high, best)], 0, 0
    while waiting and -waiting[0][0] >= kept.least:
        _, _, start, end, low, high, best = heapq.heappop(waiting)
        opened += 1
        if end - start <= LEAF:
            scores = state.whole(low, high, start, end)
            for at in np.flatnonzero(scores >= kept.least):
                kept.add(int(scores[at]), bool(segment.missing[start + at]), int(segment.ids[start + at]))
            continue
        doc = int(state.docs[best])
        middle = state.cut(low, high, doc)
        after = middle + (middle < high)
        after -= (middle < high) & (state.docs[np.minimum(middle, len(state.docs) - 1)] != doc)
        score = int(state.impacts[middle[after > middle]].sum())
        if score >= kept.least:
            kept.add(score, bool(segment.missing[doc]), int(segment.ids[doc]))
        for part in ((start, doc, low, middle), (doc + 1, end, after, high)):
            bound, best = state.bound(part[2], part[3])
            if bound >= kept.least:
                order += 1
                heapq.heappush(waiting, (-bound, order, *part, best))
    return opened


def _searched(segments: DataFrame, block: Queries, weights: Weights, top: int) -> DataFrame:
    """Per query and task its best documents: (query, doc_id, score)."""
    shared = segments.sparkSession.sparkContext.broadcast((block.numbers, block.wanted, tuple(weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, wanted, values = shared.value
        kept = [Kept(top) for _ in numbers]
        for batch in batches:
            for raw in zip(*[column.to_pylist() for column in batch.columns]):
                segment = Segment(raw, Weights(*values))
                for terms, best in zip(wanted, kept):
                    search(segment, terms, best)
        rows = [
            (number, None if not there else -doc_id, score)
            for number, best in zip(numbers, kept)
            for score, there, doc_id in best.heap
        ]
        for part in common.in_slices(rows, 1 << 16):
            columns = [pa.array(column, pa.int64()) for column in zip(*part)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    return segments.mapInArrow(run, "query long, doc_id long, score long")


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item (item_id, rank, doc_id, score) of its ``top`` highest-scoring documents, from rank 1."""
    spark = docs.sparkSession
    common.importable(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = cut_lineage(
        items.select(
            F.col(item_id).alias("item_id"),
            F.col(text).cast("string").alias("text"),
            F.monotonically_increasing_id().alias("query"),
        )
    )
    upper = F.coalesce(F.length("text"), F.lit(0)) / 2 + 1  # a term takes two characters, but for the last one
    total = asked.agg(F.sum(upper)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_terms))
    found = []
    for at in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == at).orderBy("query").collect()
        block = _block([row["query"] for row in mine], [row["text"] for row in mine])
        segments = _segments(given, block.vocabulary)
        weights = _weights(segments, len(block.vocabulary))
        found.append(cut_lineage(_searched(segments, block, weights, top)))
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(place))
    return ranked.where(F.col("rank") <= top).join(asked, "query").select("item_id", "rank", "doc_id", "score")
