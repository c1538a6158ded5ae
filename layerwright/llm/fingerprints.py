"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius by permuted block tables.

The terms of a text are its words and its pairs of neighbouring words, in lower case. Each has a hash of
``BITS`` bits and a whole-number weight that grows with the logarithm of how often it occurs. It votes with
its weight for the bits that its hash has set and against the others; a bit of the fingerprint is set
where the votes for it are more. The weights are whole, so the sums are exact and the same everywhere.

A search cuts fingerprints into ``RADIUS + 1`` blocks and keeps one table per block, with that block moved
to the front as its key: fingerprints that differ in at most ``RADIUS`` bits agree in one block at least.
Different fingerprints only are compared. Those of a bucket stand in pieces of at most about ``PIECE``,
and a piece meets a piece of queries in one step, so neither a crowded bucket nor its pairs become rows.

Defined cases: a null text is an empty one, whose fingerprint is zero; a text without letters and digits is
one term; rows without an id come after all others, rows that tie in id in order of their texts; a single
document is its own next one; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from layerwright.llm import common
from layerwright.session import cut_lineage

BITS = 128
RADIUS = 3
#: Fingerprints of a bucket that are compared at a time.
PIECE = 4096
#: A term that occurs once weighs so much; each time it occurs twice as often adds as much.
_UNIT = 16
#: Terms whose votes are added at a time.
_BLOCK = 1 << 14

_LANES = BITS // 64
_KEY = BITS // 8 // (RADIUS + 1)
_WORDS = re.compile(r"\w+")
_RANDOM = np.random.default_rng(12)
_FACTORS = _RANDOM.integers(0, 1 << 63, (2, _LANES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Hashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= 200_000:
            self.clear()
        found = self[word] = xxhash.xxh3_128_digest(word.encode(errors="replace"), 12)
        return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def terms(text: str, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a text's different terms (a row of 64-bit lanes each), and how often they occur."""
    words = _WORDS.findall(text.lower()) or ([text] if text else [])
    if not words:
        return np.zeros((0, _LANES), np.uint64), np.zeros(0, np.int64)
    single = np.frombuffer(b"".join([hashes[word] for word in words]), np.uint64).reshape(-1, _LANES)
    paired = _mixed(single[:-1] * _FACTORS[0] + single[1:] * _FACTORS[1])
    every = np.concatenate([single, paired])
    _, first, counts = np.unique(every[:, 0], return_index=True, return_counts=True)
    return every[first], counts


def fingerprint(text: str, hashes: Hashes) -> bytes:
    """The fingerprint of a text, as bytes."""
    found, counts = terms(text, hashes)
    weights = np.floor(_UNIT * (1 + np.log2(counts))) if len(counts) else np.zeros(0)
    votes = np.zeros(BITS)
    for at in range(0, len(found), _BLOCK):
        bits = np.unpackbits(found[at : at + _BLOCK].view(np.uint8), axis=1)
        votes += weights[at : at + _BLOCK] @ bits.astype(np.float64)
    return np.packbits(2 * votes > weights.sum()).tobytes()


def likeness(left: bytes, right: bytes) -> float:
    """The share of bits in which two fingerprints agree."""
    apart = int.from_bytes(left, "big") ^ int.from_bytes(right, "big")
    return 1 - apart.bit_count() / BITS


def spliced(text: str, other: str) -> str:
    """``text`` whose last half of code points is replaced by as many from the start of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _compared(text: str, own: bytes, other: str, next_print: bytes, hashes: Hashes) -> tuple:
    edited = spliced(text, other)
    edited_print = fingerprint(edited, hashes)
    digest = hashlib.sha256(edited.encode(errors="replace")).hexdigest()
    near = likeness(own, edited_print), likeness(own, next_print)
    return len(text), digest, own.hex(), edited_print.hex(), *near


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _with_next(ordered: DataFrame) -> DataFrame:
    """Rows (doc_id, text, place) in order within their ranges, compared with the row behind them.

    What a range does not hold, the row behind its last one, is left open: ``kind`` is ``row`` for a
    finished row, ``first`` and ``last`` for the texts at the ends of the range.
    """
    kind = ordered.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("doc_id", kind)]
        + [T.StructField("text", T.StringType())]
        + T.StructType.fromDDL(_RESULT).fields
    )
    empty = (None,) * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, before = Hashes(), None
        arrow = [to_arrow_type(field.dataType) for field in schema]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(column, t) for column, t in zip(zip(*rows), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            for at in range(0, batch.num_rows, common.SLICE):
                rows = []
                part = batch.slice(at, common.SLICE)
                for doc_id, text, place in zip(*[column.to_pylist() for column in part.columns]):
                    own = fingerprint(text, hashes)
                    if before is None:
                        rows.append(("first", place, None, text, *empty))
                    else:
                        rows.append(("row", place, before[0], None, *_compared(*before[1:], text, own, hashes)))
                    before = doc_id, text, own
                yield made(rows)
        if before is not None:
            yield made([("last", place, before[0], before[1], *empty)])

    return ordered.mapInArrow(run, schema)


def against_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike it is to that and to the next one.

    The next document is that of the next smaller id; after the smallest comes the largest. Texts are
    shuffled once, by ranges of the id, and only the texts at the ends of a range meet across ranges.
    """
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), common.text_or_empty(text).alias("text"))
    order = F.col("doc_id").desc_nulls_last()
    ordered = (
        rows.repartitionByRange(order, F.xxhash64("text"))
        .sortWithinPartitions(order, F.xxhash64("text"), "text")
        .select("doc_id", "text", F.spark_partition_id().alias("place"))
    )
    found = cut_lineage(_with_next(ordered))
    firsts = found.where("kind = 'first'").select("place", F.col("text").alias("next_text"))
    places = sorted(row["place"] for row in firsts.select("place").collect())  # one per range
    following = docs.sparkSession.createDataFrame(
        list(zip(places, places[1:] + places[:1])), "before int, place int"
    )
    lasts = found.where("kind = 'last'").select("doc_id", "text", F.col("place").alias("before"))
    open_rows = lasts.join(following, "before").join(firsts, "place").select("doc_id", "text", "next_text")

    def start() -> Callable:
        hashes = Hashes()

        def one(own: str, other: str) -> tuple:
            return _compared(own, fingerprint(own, hashes), other, fingerprint(other, hashes), hashes)

        return one

    closed = found.where("kind = 'row'").drop("kind", "place", "text")
    return closed.unionByName(common.map_rows(open_rows, _RESULT, start))


def _tables(prints: DataFrame, *kept: str) -> DataFrame:
    """Each fingerprint once per table, under the block that stands in front there."""
    blocks = [
        F.struct(F.lit(i).alias("table"), F.substring("print", i * _KEY + 1, _KEY).alias("key"))
        for i in range(RADIUS + 1)
    ]
    return prints.select(F.explode(F.array(*blocks)).alias("at"), "print", *kept).select("at.*", "print", *kept)


def _distances(queries: np.ndarray, points: np.ndarray, table: int) -> np.ndarray:
    """Distances of all queries to all points of a bucket; beyond the radius where an earlier table has both."""
    apart = queries[:, None, :] ^ points[None, :, :]
    found = np.bitwise_count(apart.view(np.uint64)).sum(axis=2, dtype=np.int64)
    blocks = apart.reshape(*apart.shape[:2], RADIUS + 1, _KEY)
    for earlier in range(table):
        found[~blocks[:, :, earlier].any(axis=2)] = BITS
    return found


def _met(prints: DataFrame, queries: DataFrame) -> DataFrame:
    """Pieces of a bucket's points beside pieces of its queries: (table, points, counts, asked).

    ``prints`` has (print, n), ``queries`` has (print). Larger buckets are cut by a hash; a query is sent
    to each piece of the points of its bucket.
    """
    points, asked = _tables(prints, "n"), _tables(queries)
    bucket = ["table", "key"]
    crowded = cut_lineage(
        points.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("size"))
        .where(F.col("size") > PIECE)
        .select(*bucket, F.expr(f"1 + size div {PIECE}").alias("pieces"))
    )

    def cut(rows: DataFrame) -> DataFrame:
        return rows.join(crowded, bucket, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))

    piece = F.pmod(F.xxhash64("print"), F.col("pieces"))
    held = (
        cut(points)
        .groupBy(*bucket, piece.alias("piece"))
        .agg(F.collect_list(F.struct("print", "n")).alias("points"))
    )
    sent = (
        cut(asked)
        .groupBy(*bucket, "pieces", piece.alias("part"))
        .agg(F.collect_list("print").alias("asked"))
        .select(*bucket, "asked", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    )
    return held.join(sent, [*bucket, "piece"]).select("table", "points.print", "points.n", "asked")


def _search(prints: DataFrame, queries: DataFrame, schema: str, emit: Callable) -> DataFrame:
    common.importable(prints.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for table, points, counts, asked in zip(*[column.to_pylist() for column in batch.columns]):
                own, other = (np.frombuffer(b"".join(p), np.uint8).reshape(-1, BITS // 8) for p in (asked, points))
                for at in range(0, len(own), 256):
                    yield emit(own[at : at + 256], other, np.array(counts), table)

    return _met(prints, queries).mapInArrow(run, schema)


def _raw(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def near_pairs(prints: DataFrame, queries: DataFrame) -> DataFrame:
    """All pairs (print, near, distance) of a query and another fingerprint within the radius.

    ``prints`` has the different fingerprints as (print binary, n long), ``queries`` those to look for.
    """

    def emit(own: np.ndarray, other: np.ndarray, counts: np.ndarray, table: int) -> pa.RecordBatch:
        apart = _distances(own, other, table)
        i, j = np.nonzero((apart <= RADIUS) & (apart > 0))
        columns = [_raw(own[i]), _raw(other[j]), pa.array(apart[i, j].astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["print", "near", "distance"])

    return _search(prints, queries, "print binary, near binary, distance int", emit)


def near_counts(prints: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query (print) the number of rows, itself included, whose fingerprint lies within the radius."""

    def emit(own: np.ndarray, other: np.ndarray, counts: np.ndarray, table: int) -> pa.RecordBatch:
        near = (_distances(own, other, table) <= RADIUS) @ counts
        return pa.RecordBatch.from_arrays([_raw(own), pa.array(near)], ["print", "n"])

    found = _search(prints, queries, "print binary, n long", emit)
    return found.groupBy("print").agg(F.sum("n").alias("n_near"))


def distinct_prints(rows: DataFrame, column: str = "fingerprint") -> DataFrame:
    """The different fingerprints of ``rows`` (hex text in ``column``) as (print, n)."""
    return rows.groupBy(F.unhex(column).alias("print")).agg(F.count(F.lit(1)).alias("n"))


def with_near_counts(rows: DataFrame, asked: Column, column: str = "fingerprint") -> DataFrame:
    """Rows with ``n_near``: how many others lie within the radius, where ``asked`` holds, else null."""
    rows = cut_lineage(rows)
    asked = F.coalesce(asked, F.lit(False))
    queries = rows.where(asked)
    counts = near_counts(distinct_prints(rows, column), distinct_prints(queries, column).select("print"))
    met = queries.join(counts.withColumn(column, F.lower(F.hex("print"))).drop("print"), column)
    met = met.withColumn("n_near", F.col("n_near") - 1)
    return met.unionByName(rows.where(~asked).withColumn("n_near", F.lit(None).cast("long"))).select(
        *rows.columns, "n_near"
    )
