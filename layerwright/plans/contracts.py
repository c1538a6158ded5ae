"""What each view and mart must satisfy, and how fresh each raw table must be."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.functions import total
from layerwright.operators import quality as q
from layerwright.operators.quality import Check
from layerwright.plans.marts import STATS, TOTAL

# Accepted values and bounds.
TYPES = [
    "normal",
    "fire",
    "water",
    "electric",
    "grass",
    "ice",
    "fighting",
    "poison",
    "ground",
    "flying",
    "psychic",
    "bug",
    "rock",
    "ghost",
    "dragon",
    "dark",
    "steel",
    "fairy",
]
SLOTS = [1, 2]
PAST_STATS = ["hp", "attack", "defense", "special", "special-attack", "special-defense", "speed"]
DAMAGE_CLASSES = ["physical", "special", "status"]
TIERS = ["S", "A", "B", "C", "D", "F"]
STAT_RANGE = (0, 255)
HEIGHT_RANGE = (0, 100)
WEIGHT_RANGE = (0, 10000)

# Age in days of a raw table's newest row after which to warn, and to fail.
FRESHNESS_DAYS = {
    "pokemons": (15, 30),
    "pokemon_catalogue": (180, 360),
    "version_groups": (360, 720),
    "moves": (360, 720),
    "pokemon_species": (15, 30),
    "generations": (360, 720),
}

# Columns that must not be NULL, and columns that must not repeat, per model.
NOT_NULL = {
    "stg_generations": ("fetch_date", "poke_gen", "gen_api_name", "gen_name"),
    "stg_move_details": (
        "fetch_date",
        "move_id",
        "move_name",
        "pp",
        "priority",
        "type",
        "damage_class",
        "poke_gen",
    ),
    "stg_past_stats": ("fetch_date", "poke_id"),
    "stg_past_types": ("fetch_date", "poke_id"),
    "stg_pokemon_catalogue": ("fetch_date", "poke_gen", "poke_name", "poke_id"),
    "stg_pokemon_moves": ("fetch_date", "poke_id", "moves"),
    "stg_pokemon_species": ("fetch_date", "poke_id", "is_legendary", "is_mythical", "is_baby"),
    "stg_pokemons": ("fetch_date", "poke_gen", "poke_id", "poke_name"),
    "stg_stats": ("fetch_date", "poke_id", "stats"),
    "stg_types": ("fetch_date", "poke_id", "types"),
    "stg_version_groups": (
        "fetch_date",
        "version_group_id",
        "version_group_name",
        "poke_gen",
        "version_id",
        "version_name",
    ),
    "int_past_stats": ("past_stat_id", "fetch_date", "poke_id", "poke_gen", "stat_name", "stat_value"),
    "int_past_types": ("past_type_id", "fetch_date", "poke_id", "poke_gen", "slot", "type"),
    "int_pokemon_moves": ("pokemon_move_id", "poke_id", "move_id"),
    "int_stats": (
        "fetch_date",
        "poke_id",
        "hp",
        "attack",
        "defense",
        "special_attack",
        "special_defense",
        "speed",
    ),
    "int_type_history": ("type_id", "fetch_date", "poke_id", "slot", "type", "valid_from_gen"),
    "int_types": ("type_id", "fetch_date", "poke_id", "slot", "type"),
    "mart_generations": ("poke_gen", "gen_name"),
    "mart_moves": ("move_id", "move_name", "pp", "priority", "type", "damage_class", "poke_gen"),
    "mart_past_types": ("type_id",),
    "mart_pokemon_moves": ("pokemon_move_id",),
    "mart_pokemon_species": ("poke_id", "is_legendary", "is_mythical", "is_baby"),
    "mart_pokemons": ("poke_gen", "poke_id", "poke_name"),
    "mart_stats": ("poke_id",),
    "mart_strongest_pokemons": ("poke_id", "poke_name", "rank"),
    "mart_types": ("type_id",),
    "mart_version_group_versions": ("version_id", "version_name", "version_group_id"),
    "mart_version_groups": ("version_group_id", "version_group_name", "poke_gen"),
}
UNIQUE = {
    "stg_generations": ("poke_gen",),
    "stg_move_details": ("move_id",),
    "stg_pokemon_species": ("poke_id",),
    "stg_pokemons": ("poke_id",),
    "int_past_stats": ("past_stat_id",),
    "int_past_types": ("past_type_id",),
    "int_pokemon_moves": ("pokemon_move_id",),
    "int_stats": ("poke_id",),
    "int_type_history": ("type_id",),
    "int_types": ("type_id",),
    "mart_generations": ("poke_gen",),
    "mart_moves": ("move_id",),
    "mart_past_types": ("type_id",),
    "mart_pokemon_moves": ("pokemon_move_id",),
    "mart_pokemon_species": ("poke_id",),
    "mart_pokemons": ("poke_id",),
    "mart_stats": ("poke_id",),
    "mart_strongest_pokemons": ("poke_id",),
    "mart_types": ("type_id",),
    "mart_version_group_versions": ("version_id",),
    "mart_version_groups": ("version_group_id",),
}


def _value_checks(types: list[str]) -> dict[str, list[Check]]:
    typed = [q.accepted_values("slot", SLOTS), q.accepted_values("type", types)]
    stat_ranges = [q.accepted_range(stat, *STAT_RANGE) for stat in STATS]
    return {
        "stg_move_details": [q.accepted_values("damage_class", DAMAGE_CLASSES)],
        "stg_pokemon_catalogue": [q.unique_combination("poke_id", "fetch_date")],
        "stg_pokemons": [
            q.accepted_range("height", *HEIGHT_RANGE),
            q.accepted_range("weight", *WEIGHT_RANGE),
            q.row_rule(
                "no_negative_size",
                ["height", "weight"],
                (F.col("height") < 0) | (F.col("weight") < 0),
            ),
        ],
        "int_past_stats": [
            q.accepted_values("stat_name", PAST_STATS),
            q.accepted_range("stat_value", *STAT_RANGE),
        ],
        "int_past_types": typed,
        "int_stats": [
            *stat_ranges,
            q.row_rule(
                "all_stats_present",
                STATS,
                reduce(lambda left, right: left | right, [F.col(s).isNull() for s in STATS]),
            ),
        ],
        "int_type_history": typed,
        "int_types": typed,
        "mart_moves": [q.accepted_values("damage_class", DAMAGE_CLASSES)],
        "mart_pokemons": [q.min_value("height", 0), q.min_value("weight", 0)],
        "mart_stats": [
            *stat_ranges,
            q.min_value(TOTAL, 0),
            q.row_rule("total_is_sum", [TOTAL], F.col(TOTAL) != total(STATS)),
        ],
        "mart_strongest_pokemons": [
            q.min_value(TOTAL, 0),
            q.accepted_values("tier", TIERS),
            q.row_rule("first_is_top_tier", ["tier"], (F.col("rank") == 1) & (F.col("tier") != "S")),
        ],
    }


def checks_of(model: str, marts: dict[str, DataFrame] | None = None, types: list[str] = TYPES) -> list[Check]:
    """The checks declared for one model. ``types`` are the accepted type names."""
    checks = [q.not_null(c) for c in NOT_NULL.get(model, ())]
    checks += [q.unique(c) for c in UNIQUE.get(model, ())]
    checks += _value_checks(types).get(model, [])
    if model == "mart_version_group_versions" and marts is not None:
        checks.append(
            q.relationships("version_group_id", marts["mart_version_groups"], "version_group_id")
        )
    return checks


def report(
    models: dict[str, DataFrame], types: list[str] = TYPES
) -> DataFrame:
    """Failures of every declared check over the given models: model, check, columns, failures."""
    parts = []
    for name, df in models.items():
        parents = models if "mart_version_groups" in models else None
        checks = checks_of(name, parents, types)
        if checks:
            parts.append(q.run_checks(df, checks).select(F.lit(name).alias("model"), "*"))
        if name == "mart_types":
            missing = q.group_without(df, "poke_id", F.col("slot") == 1)
            parts.append(_counted(missing, name, "has_primary_slot", "poke_id"))
        if name == "mart_strongest_pokemons":
            parts.append(_counted(q.rank_gaps(df), name, "ranks_contiguous", "rank"))
    return reduce(DataFrame.unionByName, parts)


def _counted(failing: DataFrame, model: str, check: str, columns: str) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(check).alias("check"),
        F.lit(columns).alias("columns"),
        "failures",
    )


def freshness_report(raw: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """Status of every given raw table at ``as_of``."""
    parts = [
        q.freshness(
            raw[name], "fetch_date", as_of, timedelta(days=warn), timedelta(days=fail)
        ).select(F.lit(name).alias("source"), "*")
        for name, (warn, fail) in FRESHNESS_DAYS.items()
        if name in raw
    ]
    return reduce(DataFrame.unionByName, parts)
