"""Queries over the marts: the explorer's lists, its filter and cards, questions and analyses.

``marts`` is a dict of DataFrames by mart name, as ``marts.loaded_marts`` returns. Everything stays
a plan until the caller collects it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions import round_scaled
from layerwright.operators.serving import count_per_group, having_any, top_k, with_flag
from layerwright.plans.marts import STATS, TOTAL

Marts = dict[str, DataFrame]
MISSING = "—"


@contextmanager
def registered(marts: Marts) -> Iterator[None]:
    """Temp views of the marts while the block runs; views that had their names come back after it."""
    spark = next(iter(marts.values())).sparkSession
    hidden = {name: spark.table(name) for name in marts if _is_temporary(spark, name)}
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in marts:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)


def _is_temporary(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def run_sql(marts: Marts, query: str, **args: Any) -> DataFrame:
    """A read query over mart names; ``:name`` parameters come from ``args``.

    The query is planned at once, so the names need not stay registered for the result to be read.
    """
    with registered(marts):
        return next(iter(marts.values())).sparkSession.sql(query, args=args)


# ---- lists ---------------------------------------------------------------------------------


def generation_list(marts: Marts) -> DataFrame:
    return marts["mart_generations"].select("poke_gen", "gen_name")


def entity_list(marts: Marts) -> DataFrame:
    """Entities with stats, and rank and tier where ranked."""
    ranks = marts["mart_strongest_pokemons"].select("poke_id", "rank", "tier")
    return (
        marts["mart_pokemons"]
        .join(marts["mart_stats"], "poke_id")
        .join(ranks, "poke_id", "left")
        .select(
            "poke_id", "poke_name", "poke_gen", "height", "weight", *STATS, TOTAL, "rank", "tier"
        )
        .orderBy("poke_id")
    )


def type_list(marts: Marts) -> DataFrame:
    return marts["mart_types"].select("poke_id", "slot", "type").orderBy("poke_id", "slot")


def starter_ids(marts: Marts) -> DataFrame:
    return marts["mart_strongest_starters"].select("poke_id")


def legendary_ids(marts: Marts) -> DataFrame:
    return marts["mart_pokemon_species"].where("is_legendary").select("poke_id")


def species_list(marts: Marts) -> DataFrame:
    return marts["mart_pokemon_species"]


def move_list(marts: Marts) -> DataFrame:
    """Every entity with the moves it can learn."""
    bridge = marts["mart_pokemon_moves"].select("poke_id", "move_id")
    return bridge.join(marts["mart_moves"], "move_id").select(
        "poke_id", "move_name", "type", "power", "accuracy", "pp", "damage_class"
    )


# ---- explorer ------------------------------------------------------------------------------


def explore(
    marts: Marts,
    generation: int,
    total_range: tuple[int, int] | None = None,
    types: Sequence[str] = (),
) -> DataFrame:
    """Entities of a generation, by total (both ends in) and by any of the chosen types."""
    rows = entity_list(marts).where(F.col("poke_gen") == generation)
    if total_range is not None:
        rows = rows.where(F.col(TOTAL).between(*total_range))
    return having_any(rows, marts["mart_types"], "poke_id", "type", types).orderBy("poke_id")


def cards(marts: Marts) -> DataFrame:
    """What a card shows per entity: badges, types by slot, and a dash for a missing rank or tier."""
    slots = marts["mart_types"].groupBy("poke_id").agg(
        F.max(F.when(F.col("slot") == 1, F.col("type"))).alias("primary_type"),
        F.max(F.when(F.col("slot") == 2, F.col("type"))).alias("secondary_type"),
    )
    rows = entity_list(marts).join(slots, "poke_id", "left")
    rows = rows.join(marts["mart_generations"], "poke_gen", "left")
    rows = with_flag(rows, starter_ids(marts), "poke_id", "is_starter")
    rows = with_flag(rows, legendary_ids(marts), "poke_id", "is_legendary")
    return (
        rows.withColumn("rank", F.coalesce(F.col("rank").cast("string"), F.lit(MISSING)))
        .withColumn("tier", F.coalesce("tier", F.lit(MISSING)))
        .select(
            "poke_id",
            "poke_name",
            "gen_name",
            "primary_type",
            "secondary_type",
            "rank",
            "tier",
            "is_starter",
            "is_legendary",
        )
    )


def card(marts: Marts, poke_id: int) -> DataFrame:
    """One entity's card. Read from stored marts, the key filter reaches the scan of each of them."""
    return cards(marts).where(F.col("poke_id") == poke_id)


def moves_of(marts: Marts, poke_id: int) -> DataFrame:
    """One entity's moves in table order."""
    rows = move_list(marts).where(F.col("poke_id") == poke_id).drop("poke_id")
    return rows.orderBy("damage_class", "type", "move_name")


# ---- worked questions ----------------------------------------------------------------------


def strongest_entities(marts: Marts, k: int = 5) -> DataFrame:
    rows = marts["mart_strongest_pokemons"].orderBy("rank").limit(k)
    return rows.select("poke_name", TOTAL, "tier")


def types_of(marts: Marts, name: str) -> DataFrame:
    """Names are matched in lower case."""
    named = marts["mart_pokemons"].where(F.lower("poke_name") == name.lower())
    return (
        named.join(marts["mart_types"], "poke_id").select("poke_name", "type", "slot").orderBy("slot")
    )


def count_by_generation(marts: Marts) -> DataFrame:
    counted = count_per_group(marts["mart_pokemons"], "poke_gen", into="pokemon_count")
    return (
        counted.join(marts["mart_generations"], "poke_gen")
        .groupBy("gen_name", "poke_gen")
        .agg(F.sum("pokemon_count").alias("pokemon_count"))
        .orderBy("poke_gen")
        .select("gen_name", "pokemon_count")
    )


def learnable_moves(marts: Marts, name: str) -> DataFrame:
    named = marts["mart_pokemons"].where(F.lower("poke_name") == name.lower()).select("poke_id")
    return (
        marts["mart_pokemon_moves"]
        .join(named, "poke_id")
        .join(marts["mart_moves"], "move_id")
        .select("move_name", "type", "power", "damage_class")
        .orderBy("move_name")
    )


def learnable_moves_by_power(marts: Marts, name: str) -> DataFrame:
    """The same moves, strongest first and those without power last."""
    return learnable_moves(marts, name).orderBy(F.col("power").desc_nulls_last(), "move_name")


def strongest_of_type(marts: Marts, type_name: str, k: int = 10) -> DataFrame:
    """Current types only, which is all that the type mart holds."""
    typed = marts["mart_types"].where(F.col("type") == type_name).select("poke_id")
    rows = marts["mart_pokemons"].join(marts["mart_stats"], "poke_id").join(typed, "poke_id")
    return top_k(rows, k, TOTAL, "poke_id").select(
        "poke_name", TOTAL, "attack", "special_attack", "speed"
    )


def best_starter(marts: Marts) -> DataFrame:
    rows = marts["mart_strongest_starters"].orderBy("rank").limit(1)
    return rows.select("poke_name", TOTAL, "poke_gen")


def fastest(marts: Marts, k: int = 10) -> DataFrame:
    rows = marts["mart_pokemons"].join(marts["mart_stats"], "poke_id")
    return top_k(rows, k, "speed", "poke_id").select("poke_name", "speed", TOTAL)


def strongest_moves_of_type(marts: Marts, type_name: str, k: int = 10) -> DataFrame:
    rows = marts["mart_moves"].where((F.col("type") == type_name) & F.col("power").isNotNull())
    return top_k(rows, k, "power", "move_id").select(
        "move_name", "power", "accuracy", "pp", "damage_class"
    )


def moves_per_type(marts: Marts) -> DataFrame:
    counted = count_per_group(marts["mart_moves"], "type", into="move_count")
    return counted.orderBy(F.desc("move_count"), "type")


def changed_type(marts: Marts) -> DataFrame:
    """Closed type windows; they are in the history mart."""
    closed = marts["mart_past_types"].where(F.col("valid_to_gen").isNotNull())
    return (
        closed.join(marts["mart_pokemons"].select("poke_id", "poke_name"), "poke_id")
        .select("poke_name", "type", "slot", "valid_from_gen", "valid_to_gen")
        .orderBy("poke_name", "slot", "valid_from_gen")
    )


def average_by_generation(marts: Marts, stat: str = TOTAL) -> DataFrame:
    rows = marts["mart_pokemons"].select("poke_gen", "poke_id").join(marts["mart_stats"], "poke_id")
    return rows.groupBy("poke_gen").agg(F.avg(stat).alias("average")).orderBy("poke_gen")


# ---- analyses ------------------------------------------------------------------------------


def tallest(stg_entities: DataFrame, k: int = 10) -> DataFrame:
    return top_k(stg_entities, k, "height", "poke_id").select("poke_id", "poke_name", "height")


def size_ratio(stg_entities: DataFrame) -> DataFrame:
    """Height over weight of entities that have both."""
    sized = stg_entities.where((F.col("height") > 0) & (F.col("weight") > 0))
    return sized.select(
        "poke_id",
        "poke_name",
        "height",
        "weight",
        round_scaled(F.col("height") / F.col("weight")).alias("height_weight_ratio"),
    ).orderBy("poke_name", "poke_id")
