"""Whole-table order statistics without a single-task sort.

``Window.orderBy`` with no partition sends every row to one task, and a window partitioned by a hot
key sends that key's rows to one task. Both operators here split the *order* instead: bounds from a
sample cut it into ranges, each row finds its range by binary search among the bounds, and a window
works within a range. The range is known before any row moves, so the rows take one exchange, that of
the window; the bounds end in a hash of the whole row, so equal values are spread as well.

What a range needs to know of the others is one row per range: how many rows lie before it, and what
of a run of ties, or of a group, crosses its bounds. It is summed up ahead of the exchange from the
columns of the order alone and comes back as a literal. The sample only decides how even the ranges
are; every result is the same for any bounds.

The rows are written out first: they are read for the sample, the summary and the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.session import cut_lineage

_RANGE = "__range"
_HASH = "__hash"

#: Ranges for each shuffle partition, so that a few that hash together do no harm, and sampled rows
#: for each range.
RANGES = 4
SAMPLED = 16


class Ordered(NamedTuple):
    """A column of an order: ascending with NULLs first, or descending with NULLs last."""

    name: str
    descending: bool = False

    def sorting(self) -> Column:
        column = F.col(self.name)
        return column.desc_nulls_last() if self.descending else column.asc_nulls_first()


def _before(order: Sequence[Ordered], bound: Column) -> Column:
    """Does the row stand before the row whose columns the struct ``bound`` holds?"""
    found = F.lit(False)
    for part in reversed(order):
        own, other = F.col(part.name), bound.getField(part.name)
        if part.descending:
            less = F.coalesce(own > other, own.isNotNull() & other.isNull())
        else:
            less = F.coalesce(own < other, own.isNull() & other.isNotNull())
        found = less | (own.eqNullSafe(other) & found)
    return found


class Ranges(NamedTuple):
    """Rows with the range they fall into, the order, and the first row of each range but the first."""

    rows: DataFrame
    order: list[Ordered]
    bounds: list[tuple]


def with_hash(df: DataFrame) -> DataFrame:
    """Rows with the hash of the whole row, which ends every order here."""
    return df.withColumn(_HASH, F.xxhash64(*df.columns))


def _ranged(df: DataFrame, order: Sequence[Ordered]) -> Ranges:
    """``df`` written out, each row with its hash and its range in the order."""
    rows = with_hash(cut_lineage(df))
    order = [*order, Ordered(_HASH)]
    bounds = _bounds(rows, order)
    return Ranges(rows.withColumn(_RANGE, range_of(order, bounds, rows.schema)), order, bounds)


def _bounds(rows: DataFrame, order: Sequence[Ordered]) -> list[tuple]:
    """The first row, by the columns of the order, of each range but the first, from a sample."""
    names = [part.name for part in order]
    spark = rows.sparkSession
    count = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, rows.count() // (count * SAMPLED))
    drawn = rows.select(*names).where(F.pmod(F.xxhash64(_HASH), F.lit(every)) == 0).distinct()
    sample = drawn.orderBy(*[part.sorting() for part in order]).collect()  # a few rows per range
    step = max(1, len(sample) // count)
    return [tuple(row) for row in sample[step::step]]


def range_of(order: Sequence[Ordered], bounds: Sequence[tuple], kinds: T.StructType) -> Column:
    """The range a row falls into, by binary search among the bounds."""
    if not bounds:
        return F.lit(0)
    names = [part.name for part in order]
    listed = F.array(
        *[
            F.struct(*[F.lit(value).cast(kinds[name].dataType).alias(name) for name, value in zip(names, bound)])
            for bound in bounds
        ]
    )
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def passed(at: Column, step: Column) -> Column:
        reached = (at + step <= len(bounds)) & ~_before(order, F.get(listed, at + step - 1))
        return F.when(reached, at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), passed)


def _by_range(values: dict[int, object], kind: T.DataType, ranges: int) -> Column:
    """One value per range, looked up by the range of the row."""
    listed = [F.lit(values.get(at)).cast(kind) for at in range(ranges)]
    return F.get(F.array(*listed), F.col(_RANGE))


class Count(NamedTuple):
    """What a range holds: its rows, those with a value, and those that go on with the value of its bound."""

    n: int
    n_valued: int
    leading: int


def count_ranges(rows: DataFrame, measure: str, first: dict[int, object], ranges: int) -> dict[int, Count]:
    """The counts of each range that has rows; ``first`` gives the value of the bound of a range."""
    kind = rows.schema[measure].dataType
    leading = F.col(measure).eqNullSafe(_by_range(first, kind, ranges)).cast("int")
    summary = rows.groupBy(_RANGE).agg(
        F.count(F.lit(1)).alias("n"), F.count(measure).alias("n_valued"), F.sum(leading).alias("leading")
    )
    return {row[_RANGE]: Count(row.n, row.n_valued, row.leading) for row in summary.collect()}


def offsets(counts: dict[int, Count], first: dict[int, object], ranges: int) -> tuple[dict[int, int], dict[int, int]]:
    """Per range the rows before it, and the rank of the last row of the run that goes on behind it."""
    before, total = {}, 0
    for at in range(ranges):
        before[at] = total
        total += counts[at].n if at in counts else 0
    last: dict[int, int] = {}
    for at in reversed(range(ranges - 1)):
        following = at + 1
        if following + 1 < ranges and _same(first[following + 1], first[following]):
            last[at] = last[following]
        else:
            last[at] = before[following] + (counts[following].leading if following in counts else 0)
    return before, last


def places(order: Sequence[Ordered], part: str = _RANGE) -> tuple[Column, Column]:
    """The place of a row in its range, and that of the last row of its value there."""
    in_range = Window.partitionBy(part)
    place = F.row_number().over(in_range.orderBy(*[column.sorting() for column in order]))
    upto = F.count(F.lit(1)).over(in_range.orderBy(order[0].sorting()))
    return place.cast("long"), upto


def rank_table(
    df: DataFrame,
    measure: str,
    tie_break: Sequence[str],
    rank: str = "rank",
    percent_rank: str | None = "pct_rank",
) -> DataFrame:
    """Number rows from the highest ``measure`` down, and give the ascending percent rank.

    ``rank`` is 1..n; equal measures are ordered by ``tie_break``. ``percent_rank`` is
    (rows below) / (n - 1), the same for equal measures, 0 for a single row. NULL measures come last
    in the numbering and above every value in the percent rank, as with NULLS LAST in both orders.
    """
    found = _ranged(df, [Ordered(measure, descending=True), *map(Ordered, tie_break)])
    ranges = len(found.bounds) + 1
    kind = df.schema[measure].dataType
    first = {at + 1: bound[0] for at, bound in enumerate(found.bounds)}
    counts = count_ranges(found.rows, measure, first, ranges)
    n_rows = sum(count.n for count in counts.values())
    n_valued = sum(count.n_valued for count in counts.values())
    before, last = offsets(counts, first, ranges)
    place, upto = places(found.order)
    offset = _by_range(before, T.LongType(), ranges)
    result = found.rows.withColumn("__place", place)
    numbered = (offset + F.col("__place")).alias(rank)
    if percent_rank is None:
        return result.select(*df.columns, numbered)
    goes_on = _by_range({at - 1: value for at, value in first.items()}, kind, ranges)
    in_last = F.col(_RANGE) == ranges - 1
    result = result.withColumn("__upto", upto)
    run_end = F.when(
        ~in_last & F.col(measure).eqNullSafe(goes_on), _by_range(last, T.LongType(), ranges)
    ).otherwise(offset + F.col("__upto"))
    below = F.lit(n_valued) - F.when(F.col(measure).isNull(), F.lit(0)).otherwise(run_end)
    share = F.lit(0.0) if n_rows < 2 else below / F.lit(float(n_rows - 1))
    return result.select(*df.columns, numbered, share.alias(percent_rank))


def _same(left: object, right: object) -> bool:
    """Equal as SQL sees it: NaN is NaN, and NULL here is the run of NULLs."""
    return left == right or (left != left and right != right)


def previous_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    into: str,
    has_previous: str | None = None,
) -> DataFrame:
    """LAG of ``value`` over ``keys`` ordered by ``order``, for groups of any size.

    A group that spans several ranges gets its first row's predecessor in a range from the last row
    of the range before. ``has_previous`` names an optional flag: is there a preceding row at all.
    """
    found = _ranged(df, list(map(Ordered, [*keys, *order])))
    rows = found.rows
    key_struct = F.struct(*[F.col(k) for k in keys])
    last = F.struct(key_struct.alias("keys"), F.col(value).alias("value"))
    sort_key = F.struct(*[F.col(part.name) for part in found.order])
    ends = sorted(rows.groupBy(_RANGE).agg(F.max_by(last, sort_key).alias("last")).collect())
    carried = [
        (after[_RANGE], tuple(before["last"]["keys"]), before["last"]["value"], True)
        for before, after in zip(ends, ends[1:])
    ]
    schema = T.StructType(
        [
            T.StructField(_RANGE, T.IntegerType()),
            T.StructField("__end_keys", T.StructType([df.schema[k] for k in keys])),
            T.StructField("__end_value", df.schema[value].dataType),
            T.StructField("__end", T.BooleanType()),
        ]
    )
    in_range = Window.partitionBy(_RANGE, *keys).orderBy(*[F.col(c).asc() for c in (*order, _HASH)])
    rows = rows.withColumn("__row", F.row_number().over(in_range)).withColumn("__lag", F.lag(value).over(in_range))
    # one row per range; their number is set by the shuffle partitions, not by the data
    summary = F.broadcast(df.sparkSession.createDataFrame(carried, schema))
    joined = rows.join(summary, _RANGE, "left")
    continues = (
        (F.col("__row") == 1)
        & F.coalesce(F.col("__end"), F.lit(False))
        & key_struct.eqNullSafe(F.col("__end_keys"))
    )
    out = joined.withColumn(
        into, F.when(continues, F.col("__end_value")).otherwise(F.col("__lag"))
    )
    names = [*df.columns, into]
    if has_previous is not None:
        out = out.withColumn(has_previous, (F.col("__row") > 1) | continues)
        names.append(has_previous)
    return out.select(*names)
