"""Validity windows: from a change log plus the current state to (from, to) periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.operators.ordered import previous_in_group
from layerwright.session import cut_lineage


def validity_windows(
    past: DataFrame,
    current: DataFrame,
    introduced: DataFrame,
    entity: str,
    slot: str,
    value: str,
    period: str = "period",
    intro: str = "intro",
    carry: Sequence[str] = (),
    rule: str = "documented",
) -> DataFrame:
    """Periods in which ``value`` held for (``entity``, ``slot``).

    ``past`` says a value held up to and including ``period``; ``current`` holds the value of today;
    ``introduced`` gives the first period of each entity, one row per entity. Columns out: entity,
    slot, value, valid_from, valid_to (NULL: still valid), and ``carry`` from introduced (past rows)
    or from ``current``.

    Rules:
    ``documented``  a past value runs from one after the slot's previous change (or from the
                    introduction) to its own change period.
    ``as_written``  the windows of the model as first written, which reads the introduction where
                    the change period belongs.
    """
    if rule not in ("documented", "as_written"):
        raise ValueError(f"unknown rule {rule!r}")
    # read three times below: for the split into ranges, for the rows, and for the last change
    past = cut_lineage(past.select(entity, slot, value, period))
    changes = previous_in_group(
        past,
        [entity, slot],
        [period, value],
        period,
        into="__prior",
        has_previous="__follows",
    )
    closed = changes.select(
        entity,
        slot,
        value,
        "__prior",
        "__follows",
        F.col(period).alias("__until"),
        F.lit(False).alias("__open"),
        *[F.lit(None).cast(current.schema[c].dataType).alias(c) for c in carry],
    )
    # The last change per slot needs no ordering, so it is aggregated from the log itself.
    last = past.groupBy(entity, slot).agg(
        F.max(period).alias("__prior"), F.lit(True).alias("__follows")
    )
    open_ended = current.join(last, [entity, slot], "left").select(
        entity,
        slot,
        value,
        "__prior",
        F.coalesce("__follows", F.lit(False)).alias("__follows"),
        F.lit(None).cast(past.schema[period].dataType).alias("__until"),
        F.lit(True).alias("__open"),
        *carry,
    )

    # One join to the introductions serves both sides.
    intro_side = introduced.select(
        entity, F.col(intro).alias("__intro"), *[F.col(c).alias(f"__{c}") for c in carry]
    )
    rows = closed.unionByName(open_ended).join(intro_side, entity, "left")
    if rule == "documented":
        prior, until = F.col("__prior"), F.col("__until")
    else:
        prior = F.when(F.col("__follows"), F.col("__intro"))
        until = F.when(~F.col("__open"), F.col("__intro"))
    return rows.select(
        *[F.when(F.col("__open"), F.col(c)).otherwise(F.col(f"__{c}")).alias(c) for c in carry],
        entity,
        slot,
        value,
        F.coalesce(prior + 1, F.col("__intro")).alias("valid_from"),
        until.alias("valid_to"),
    )
