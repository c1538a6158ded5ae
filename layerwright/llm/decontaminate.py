"""Benchmark passages in training texts, found by spaced seeds and tolerant of substituted words.

Two texts overlap where ``WINDOW`` words in a row of both, side by side, are equal but for at most two
of them. An item of fewer words must occur from end to end: one of 8 to 12 words with one substitution
at most, a shorter one word for word (``least_words`` leaves items out that are too short to tell a leak
from chance; by default none is). A mask picks some words of a run and ignores the others; the picked
words are hashed. The fixed ``MASKS`` of each size of item are such that every overlap holds a run whose
picked words are all equal (``lossless`` checks this), so joining the hashes of test and training texts
finds every overlap. Each hit gives a document, an item and their alignment; the aligned words are then
compared themselves. Documents are hashed with the masks of the sizes that the benchmark has, no others.

Words are runs of letters and digits, in lower case. Documents and items are cut into pieces of
``PIECE`` words that overlap by a mask, so that a long text is hashed in bounded memory.

Defined cases: a null text is an empty one; an item without an id is reported as ``null``; items with
a repeated id are looked for each; documents with a repeated id are judged by their own text; an empty
benchmark leaves every document clean; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage

WINDOW = 13
#: Words from which a run may have one substitution, and two.
ONE, TWO = 8, WINDOW
LONG = ((0, 1, 2, 3, 4, 5), (0, 1, 4, 6, 9, 10))
SHORT = ((0, 1, 2, 3, 4), (0, 1, 2, 5, 6, 7))
#: The masks by the size of an item, or ``WINDOW`` for all longer ones.
MASKS = {
    **{size: (tuple(range(size)),) for size in range(1, ONE)},
    **{size: SHORT for size in range(ONE, 11)},
    **{size: LONG for size in range(11, WINDOW + 1)},
}
PIECE = 4096
#: Seeds of a benchmark up to which they are sent to every task: 24 bytes each, 24 MB in all.
BROADCAST = 1_000_000


def substitutions(window: int) -> int:
    """How many words of a run of that length may differ."""
    return (window >= ONE) + (window >= TWO)


def lossless(masks: tuple, window: int) -> bool:
    """Whether every overlap holds a run in which no picked word is substituted."""
    runs = [{at + o for o in mask} for mask in masks for at in range(window - max(mask))]
    return all(
        any(run.isdisjoint(places) for run in runs)
        for places in combinations(range(window), substitutions(window))
    )


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def seeds(rows: DataFrame, keys: list[str], masks: Sequence[tuple[int, ...]]) -> DataFrame:
    """Per mask and place in ``words`` the hash of the picked words: the keys, at (from 0) and seed."""
    reach = max(max(mask) for mask in masks) + 1
    offsets = sorted({o for mask in masks for o in mask})
    pieces = (
        rows.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
        .where(F.size("hashes") > 0)
        .select(
            *keys,
            "hashes",
            F.explode(F.sequence(F.lit(0), F.size("hashes") - 1, F.lit(PIECE))).alias("first"),
        )
        .select(*keys, "first", F.slice("hashes", F.col("first") + 1, PIECE + reach - 1).alias("piece"))
    )
    places = F.sequence(F.col("first"), F.col("first") + F.least(F.size("piece"), F.lit(PIECE)) - 1)
    zipped = F.arrays_zip(places, *[F.slice("piece", o + 1, PIECE) for o in offsets])
    named = dict(zip(offsets, [f"word_{o}" for o in offsets]))
    placed = pieces.select(*keys, F.inline(zipped).alias("at", *named.values()))
    hashes = [
        F.when(
            F.col(named[max(mask)]).isNotNull() & F.col("at").isNotNull(),
            F.xxhash64(F.lit(",".join(map(str, mask))), *[named[o] for o in mask]),
        )
        for mask in masks
    ]
    return placed.select(*keys, "at", F.explode(F.array(*hashes)).alias("seed")).where("seed IS NOT NULL")


def items(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", least_words: int = 1
) -> DataFrame:
    """The items to be looked for, with a number each, their words and their length."""
    return cut_lineage(
        benchmark.select(
            F.monotonically_increasing_id().alias("item"),
            F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item_id"),
            words(F.col(text).cast("string")).alias("item_words"),
        )
        .withColumn("item_size", F.size("item_words"))
        .where(F.col("item_size") >= max(1, least_words))
    )


def hits(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Alignments (row_key, item, shift) of documents and items that share a seed."""
    size = F.least("item_size", F.lit(WINDOW))
    sizes = [row[0] for row in known.select(size.alias("size")).distinct().collect()]  # 13 at most
    used = sorted({MASKS[n] for n in sizes} or {LONG})
    of_items = cut_lineage(
        reduce(
            DataFrame.unionByName,
            [
                seeds(
                    known.where(size.isin([n for n in MASKS if MASKS[n] == masks])).select(
                        "item", F.col("item_words").alias("words")
                    ),
                    ["item"],
                    masks,
                )
                for masks in used
            ],
        ).withColumnRenamed("at", "item_at")
    )
    if of_items.count() <= BROADCAST:
        of_items = F.broadcast(of_items)
    return (
        seeds(
            documents.select("row_key", words(F.col("content")).alias("words")),
            ["row_key"],
            [mask for masks in used for mask in masks],
        )
        .join(of_items, "seed")
        .select("row_key", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )


def _best(size: Column) -> Column:
    """The most equal words in any run of that many aligned words."""
    return F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size("equal") - size + 1),
            lambda at: F.aggregate(F.slice("equal", at, size), F.lit(0), lambda sum_, e: sum_ + e),
        )
    )


def overlaps(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Verified overlaps: row_key, item_id, and the share of the item's words that stand aligned."""
    found = cut_lineage(hits(documents, known))
    start = F.greatest(F.col("shift"), F.lit(0))
    length = F.least(F.col("shift") + F.col("item_size"), F.size("words")) - start
    aligned = (
        documents.join(found.join(known.select("item", "item_size"), "item"), "row_key")
        .withColumn("words", words(F.col("content")))
        .select(
            "row_key",
            "item",
            (start - F.col("shift")).alias("skipped"),
            F.slice("words", start + 1, length).alias("doc_words"),
        )
        .join(known, "item")
        .select(
            "row_key",
            "item_id",
            "item_size",
            F.zip_with(
                "doc_words",
                F.slice("item_words", F.col("skipped") + 1, F.size("doc_words")),
                lambda a, b: F.when(a == b, 1).otherwise(0),
            ).alias("equal"),
        )
    )
    window = F.least(F.lit(WINDOW), "item_size")
    allowed = (window >= ONE).cast("int") + (window >= TWO).cast("int")
    return (
        aligned.where(F.size("equal") >= window)
        .where(_best(window) >= window - allowed)
        .select(
            "row_key",
            "item_id",
            (F.aggregate("equal", F.lit(0), lambda sum_, e: sum_ + e) / F.col("item_size")).alias("share"),
        )
    )


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.col(text).cast("string")
    return docs.select(common.row_key(F.col(doc_id), content).alias("row_key"), content.alias("content"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_words: int = 1,
) -> DataFrame:
    """Per document with an overlap: row_key, n_items, item_ids (sorted as text) and the best share."""
    known = items(benchmark, item_id, item_text, least_words)
    return cut_lineage(
        overlaps(_documents(docs, doc_id, text), known)
        .groupBy("row_key", "item_id")
        .agg(F.max("share").alias("share"))
        .groupBy("row_key")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("item_ids"),
            F.max("share").alias("best_share"),
        )
    )


def report(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, contaminated, n_items, item_ids and best_share."""
    key = common.row_key(F.col(doc_id), F.col(text).cast("string"))
    return (
        docs.select(F.col(doc_id).alias("doc_id"), key.alias("row_key"))
        .join(leaks(docs, benchmark, doc_id, text), "row_key", "left")
        .select(
            "doc_id",
            F.col("n_items").isNotNull().alias("contaminated"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.lit("")).alias("item_ids"),
            F.coalesce("best_share", F.lit(0.0)).alias("best_share"),
        )
    )


def clean_rows(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents without an overlap, with all their columns."""
    return common.drop_rows(docs, leaks(docs, benchmark, doc_id, text).select("row_key"), doc_id, text)
