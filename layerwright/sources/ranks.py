"""Ranks kept with a table: a load ranks anew only the ranges that it touches.

The rows lie in ranges of the order, as buckets of a catalog table, each with its place in the range. An
index with one row per range says how many rows lie before it, and what of a run of ties goes on behind it.
The table that readers see is a view that adds the two: rank and percent rank come from a join with the
index, which is broadcast, without an exchange of rows and without a window. So rows that move the ranks of
all others by one change one range and the index.

The index of a version is a folder named in the text of the view. It is written before the view is
switched, so the one statement that switches a version switches its index as well.

``made_from`` names what the ranks were made from. A load that was lost between a change of those tables
and its ranks leaves another name there, and the next load ranks the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.operators import ordered
from layerwright.operators.ordered import Count, Ordered
from layerwright.session import cut_lineage
from layerwright.sources import tables

PLACE, UPTO = "__place", "__upto"
#: All ranges are cut anew where the largest holds so many times the mean.
UNEVEN = 8


class Ranking(NamedTuple):
    """How a table is ranked: from the highest ``measure`` down, ties by ``key``, which names a row.

    ``shown`` lists further columns of the view as (name, SQL text), which may use ``rank`` and
    ``pct_rank``; the percent rank itself is shown where ``percent_rank`` is set.
    """

    measure: str
    key: tuple[str, ...]
    shown: tuple[tuple[str, str], ...] = ()
    percent_rank: bool = True

    @property
    def order(self) -> list[Ordered]:
        return [Ordered(self.measure, descending=True), *map(Ordered, self.key), Ordered(ordered._HASH)]


def load_all(rows: DataFrame, table: str, ranking: Ranking, made_from: str = "", root: str | None = None) -> None:
    """Rank the whole table and store it."""
    found = ordered._ranged(rows, ranking.order[:-1])
    ranges = len(found.bounds) + 1
    first = {at + 1: bound[0] for at, bound in enumerate(found.bounds)}
    counts = ordered.count_ranges(found.rows, ranking.measure, first, ranges)
    index = _write_index(rows, table, ranking, found.bounds, counts, root)
    tables.replace_table(
        _placed(found.rows, ranking, rows.columns),
        table,
        root,
        bucketed=True,
        properties={tables.INDEX: index, "made_from": made_from},
        shown=_view(rows.columns, ranking, index),
    )


def load_changes(
    changed: DataFrame, rows: DataFrame, table: str, ranking: Ranking, made_from: str = "", root: str | None = None
) -> list[int]:
    """Put ``rows`` in the place of the rows whose key is in ``changed``; the ranges that were touched.

    ``rows`` holds what there is now of the changed keys; keys without a row are gone.
    """
    spark = rows.sparkSession
    keys = list(ranking.key)
    version = tables.current(spark, table)
    stored = spark.table(version)
    columns = [c for c in stored.columns if c not in (PLACE, UPTO, tables.BUCKET)]
    bounds, counts = _read_index(spark, table)
    first = {at + 1: bound[0] for at, bound in enumerate(bounds)}
    ranges = len(bounds) + 1

    keyed = cut_lineage(changed.select(*keys).distinct())
    new = ordered.with_hash(rows.select(*columns))
    new = cut_lineage(new.withColumn(ordered._RANGE, ordered.range_of(ranking.order, bounds, new.schema)))
    left = stored.join(keyed, keys, "left_semi").select(F.col(tables.BUCKET).alias(ordered._RANGE))
    both = left.union(new.select(ordered._RANGE)).distinct().collect()  # one row per range at most
    touched = sorted(row[0] for row in both)
    if not touched:
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('made_from' = '{made_from}')")
        return touched

    kept = (
        stored.where(F.col(tables.BUCKET).isin(touched))
        .join(keyed, keys, "left_anti")
        .withColumn(ordered._HASH, F.xxhash64(*columns))
        .withColumn(ordered._RANGE, F.col(tables.BUCKET))
    )
    ranked = cut_lineage(kept.select(*new.columns).unionByName(new))
    again = ordered.count_ranges(ranked, ranking.measure, first, ranges)
    counts = {at: count for at, count in counts.items() if at not in set(touched)} | again
    index = _write_index(rows.select(*columns), table, ranking, bounds, counts, root)
    tables.replace_buckets(
        _placed(ranked, ranking, columns),
        table,
        touched,
        root,
        properties={tables.INDEX: index, "made_from": made_from},
        emptied=[at for at in touched if at not in again],
        shown=_view(columns, ranking, index),
    )
    return touched


def fits(spark: SparkSession, table: str, made_from: str, columns: Sequence[str]) -> bool:
    """Can changes be added to the stored ranks: were they made from that, of those columns, and are they even?"""
    noted = tables.properties_of(spark, table)
    if tables.INDEX not in noted or noted["made_from"] != made_from:
        return False
    stored = [c for c in spark.table(tables.current(spark, table)).columns if c not in (PLACE, UPTO, tables.BUCKET)]
    bounds, counts = _read_index(spark, table)
    sizes = [count.n for count in counts.values()] or [0]
    return stored == list(columns) and max(sizes) * (len(bounds) + 1) <= UNEVEN * max(sum(sizes), 1)


def _placed(rows: DataFrame, ranking: Ranking, columns: Sequence[str]) -> DataFrame:
    place, upto = ordered.places(ranking.order)
    return rows.select(
        *columns, place.alias(PLACE), upto.alias(UPTO), F.col(ordered._RANGE).alias(tables.BUCKET)
    )


def _index_schema(kinds: T.StructType, ranking: Ranking) -> T.StructType:
    parts = [T.StructField(c, kinds[c].dataType) for c in (ranking.measure, *ranking.key)]
    bound = T.StructType([*parts, T.StructField(ordered._HASH, T.LongType())])
    numbers = ("n", "n_valued", "leading", "before", "run_end", "n_rows", "all_valued")
    return T.StructType(
        [
            T.StructField(ordered._RANGE, T.IntegerType()),
            T.StructField("bound", bound),
            *[T.StructField(name, T.LongType()) for name in numbers],
            T.StructField("goes_on", kinds[ranking.measure].dataType),
        ]
    )


def _write_index(
    rows: DataFrame,
    table: str,
    ranking: Ranking,
    bounds: Sequence[tuple],
    counts: dict[int, Count],
    root: str | None,
) -> str:
    """One row per range; the folder it was written to."""
    ranges = len(bounds) + 1
    first = {at + 1: bound[0] for at, bound in enumerate(bounds)}
    before, last = ordered.offsets(counts, first, ranges)
    n_rows = sum(count.n for count in counts.values())
    n_valued = sum(count.n_valued for count in counts.values())
    lines: list[tuple[Any, ...]] = []
    for at in range(ranges):
        count = counts.get(at, Count(0, 0, 0))
        bound = tuple(bounds[at - 1]) if at else None
        lines.append((at, bound, *count, before[at], last.get(at), n_rows, n_valued, first.get(at + 1)))
    spark = rows.sparkSession
    folder = tables.fresh_folder(spark, table, root)
    spark.createDataFrame(lines, _index_schema(rows.schema, ranking)).coalesce(1).write.parquet(folder)
    return folder


def _read_index(spark: SparkSession, table: str) -> tuple[list[tuple], dict[int, Count]]:
    """The bounds of the ranges, and the counts of those that have rows."""
    folder = tables.properties_of(spark, table)[tables.INDEX]
    lines = sorted(spark.read.parquet(folder).collect(), key=lambda line: line[ordered._RANGE])
    counts = {line[ordered._RANGE]: Count(line.n, line.n_valued, line.leading) for line in lines if line.n}
    return [tuple(line.bound) for line in lines[1:]], counts


def _view(columns: Sequence[str], ranking: Ranking, index: str) -> str:
    """The text of the view; ``{version}`` stands for the table with the rows."""
    named = ", ".join(f"`{c}`" for c in columns)
    # the last range has no run that goes on, nor an end of it
    end = (
        f"CASE WHEN i.run_end IS NOT NULL AND v.`{ranking.measure}` <=> i.goes_on THEN i.run_end "
        f"ELSE i.before + v.{UPTO} END"
    )
    below = f"i.all_valued - CASE WHEN v.`{ranking.measure}` IS NULL THEN 0 ELSE {end} END"
    share = f"CASE WHEN i.n_rows < 2 THEN 0.0D ELSE ({below}) / CAST(i.n_rows - 1 AS DOUBLE) END"
    further = "".join(f", {text} AS `{name}`" for name, text in ranking.shown)
    shown = f"{named}, rank{', pct_rank' if ranking.percent_rank else ''}{further}"
    return (
        f"SELECT {shown} FROM (SELECT /*+ BROADCAST(i) */ {', '.join(f'v.`{c}`' for c in columns)}, "
        f"i.before + v.{PLACE} AS rank, {share} AS pct_rank "
        f"FROM {{version}} v JOIN parquet.`{index}` i ON v.{tables.BUCKET} = i.{ordered._RANGE})"
    )
