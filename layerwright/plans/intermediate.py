"""Unnested, pivoted and historised views over the staging views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.functions import surrogate_key, url_tail
from layerwright.operators.history import validity_windows
from layerwright.operators.reshape import pivot_fixed, unpivot
from layerwright.operators.unnest import unnest, unnest_nested

# Stat names in the payload and the columns they become.
STAT_COLUMNS = {
    "hp": "hp",
    "attack": "attack",
    "defense": "defense",
    "special-attack": "special_attack",
    "special-defense": "special_defense",
    "speed": "speed",
}

_KEYS = ("fetch_date", "poke_id")


def stats(stg_stats: DataFrame) -> DataFrame:
    """One row per entity and fetch, one column per stat; a missing stat is NULL."""
    rows = unnest(stg_stats, "stats", {"base_stat": "value", "stat.name": "stat"}, *_KEYS)
    rows = rows.withColumn("value", F.col("value").cast("int"))
    return pivot_fixed(rows, _KEYS, "stat", "value", STAT_COLUMNS)


def types(stg_types: DataFrame) -> DataFrame:
    """One row per entity and type slot."""
    rows = unnest(stg_types, "types", {"slot": "slot", "type.name": "type"}, *_KEYS)
    rows = rows.withColumn("slot", F.col("slot").cast("int"))
    return rows.select(surrogate_key("poke_id", "slot").alias("type_id"), *rows.columns)


def _past(stg: DataFrame, outer: str, inner: str, inner_fields: dict[str, str]) -> DataFrame:
    rows = unnest_nested(stg, outer, inner, {"generation.url": "url"}, inner_fields, *_KEYS)
    return rows.select(
        *_KEYS, url_tail("url").cast("int").alias("poke_gen"), *inner_fields.values()
    )


def past_types(stg_past_types: DataFrame) -> DataFrame:
    """One row per entity, period and slot: the type that held until that period."""
    rows = _past(stg_past_types, "past_types", "types", {"slot": "slot", "type.name": "type"})
    rows = rows.withColumn("slot", F.col("slot").cast("int"))
    key = surrogate_key("poke_id", "poke_gen", "slot")
    return rows.select(key.alias("past_type_id"), *rows.columns)


def past_stats(stg_past_stats: DataFrame) -> DataFrame:
    """One row per entity, period and stat: the value that held until that period."""
    fields = {"base_stat": "stat_value", "stat.name": "stat_name"}
    rows = _past(stg_past_stats, "past_stats", "stats", fields)
    rows = rows.withColumn("stat_value", F.col("stat_value").cast("int"))
    key = surrogate_key("poke_id", "poke_gen", "stat_name")
    return rows.select(key.alias("past_stat_id"), *rows.columns)


def entity_moves(stg_moves: DataFrame) -> DataFrame:
    """Distinct entity and move pairs per fetch."""
    rows = unnest(stg_moves, "moves", {"move.url": "url"}, *_KEYS)
    pairs = rows.select(*_KEYS, url_tail("url").cast("bigint").alias("move_id")).distinct()
    key = surrogate_key("poke_id", "move_id")
    return pairs.select(key.alias("pokemon_move_id"), *pairs.columns)


def _introductions(stg_entities: DataFrame) -> DataFrame:
    return stg_entities.select("poke_id", F.col("poke_gen").alias("intro"), "fetch_date")


def type_history(
    int_past_types: DataFrame,
    int_types: DataFrame,
    stg_entities: DataFrame,
    rule: str = "documented",
) -> DataFrame:
    """Validity windows of every type slot, the current type included."""
    windows = validity_windows(
        int_past_types.withColumnRenamed("poke_gen", "period"),
        int_types,
        _introductions(stg_entities),
        "poke_id",
        "slot",
        "type",
        carry=["fetch_date"],
        rule=rule,
    )
    return _history_columns(windows, "slot", "type", "type_id")


def stats_history(
    int_past_stats: DataFrame,
    int_stats: DataFrame,
    stg_entities: DataFrame,
    rule: str = "documented",
) -> DataFrame:
    """Validity windows of every stat, the current value included."""
    current = unpivot(int_stats, _KEYS, STAT_COLUMNS, "stat", "stat_value")
    past = int_past_stats.select(
        "poke_id",
        F.col("stat_name").alias("stat"),
        "stat_value",
        F.col("poke_gen").alias("period"),
    )
    windows = validity_windows(
        past,
        current,
        _introductions(stg_entities),
        "poke_id",
        "stat",
        "stat_value",
        carry=["fetch_date"],
        rule=rule,
    )
    return _history_columns(windows, "stat", "stat_value", "stat_id")


def _history_columns(windows: DataFrame, slot: str, value: str, key_name: str) -> DataFrame:
    return windows.select(
        surrogate_key("poke_id", slot, "valid_from").alias(key_name),
        "fetch_date",
        "poke_id",
        slot,
        value,
        F.col("valid_from").alias("valid_from_gen"),
        F.col("valid_to").alias("valid_to_gen"),
    )
