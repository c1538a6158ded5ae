"""Exact duplicates with frequent digests taken out before the shuffle.

A Misra-Gries summary over all digests names every digest that more than ``support`` of the rows
carry. The named ones are counted exactly, and those winners, at most ``1 / support`` of them, are
broadcast: their rows are settled where they are read. All other digests go through an ordinary
shuffle, summed up before it, and only groups of two or more are joined back.

Defined cases: a null text is an empty one; a null id ranks behind every other id, so such a row stays
only where its group has no id at all (``keep_id`` is then null); of rows that tie for the smallest id
one stays; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage

#: Share of the rows from which a digest is found by the summary for certain.
SUPPORT = 0.004


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space."""
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")


def frequent(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """At most ``1 / support`` values of ``mark`` that hold every one borne by more than that share."""
    return digests.stat.freqItems(["mark"], support).select(F.explode("mark_freqItems").alias("mark"))


def _groups(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min("place").alias("first"))
        .where("group_size > 1")
    )


def decide(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and row_key."""
    content = common.text_or_empty(text)
    rows = cut_lineage(
        docs.select(
            F.struct(
                F.col(doc_id).isNull().alias("last"),
                F.col(doc_id).alias("id"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("place"),
            F.unhex(F.sha2(normalised(content), 256)).alias("digest"),
            common.row_key(F.col(doc_id), content).alias("row_key"),
        )
    )
    marked = rows.withColumn("mark", F.xxhash64("digest"))
    named = F.broadcast(frequent(marked.select("mark"), support))
    winners = cut_lineage(_groups(marked.join(named, "mark", "left_semi")))
    settled = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    groups = cut_lineage(_groups(rest))
    return (
        settled.unionByName(rest.join(groups, "digest", "left"), allowMissingColumns=True)
        .withColumn("first", F.coalesce("first", "place"))
        .select(
            F.col("place.id").alias("doc_id"),
            F.col("first.id").alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("place.row") == F.col("first.row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "row_key",
        )
    )


def unique_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = decide(docs, doc_id, text).where("kept").select("row_key")
    return common.keep_rows(docs, kept, doc_id, text)
