"""Typed views over the raw payloads. Every function is lazy: DataFrame in, DataFrame out.

A function takes its raw table as landed. Where a raw table may hold several fetches of one entity,
``newest_fetch`` is applied first, so that later models see each entity once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions import clean_text, last_match, matching, parse, round_scaled, url_segment, url_tail
from layerwright.operators.latest import latest_per_key
from layerwright.operators.unnest import unnest
from layerwright.sources.raw import payload_schema

# The language of names and texts kept by the models.
LANGUAGE = "en"

# The array columns handed on by ``entity_arrays``, one per view.
ENTITY_ARRAYS = ("stats", "types", "moves", "past_types", "past_stats")


def newest_fetch(raw: DataFrame, key: str = "id") -> DataFrame:
    """The newest landed row per id. Runs before the parse, on unparsed payloads."""
    return latest_per_key(raw, [key], ["fetch_date", "batch_id", F.xxhash64("payload").desc()])


def _parsed(
    raw: DataFrame, name: str, *keep: str, fields: Sequence[str] = ()
) -> DataFrame:
    """The payload as struct ``p``; only the named fields, if any are named, are read from it."""
    return raw.select(*keep, parse("payload", payload_schema(name, *fields)).alias("p"))


def _int(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("int")


def _id(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def generations(raw: DataFrame) -> DataFrame:
    """One row per generation and name in the kept language."""
    rows = _parsed(raw, "generations", "fetch_date").select(
        "fetch_date",
        _int("p.id").alias("poke_gen"),
        F.col("p.name").alias("gen_api_name"),
        matching("p.names", "language.name", LANGUAGE).alias("names"),
    )
    return unnest(rows, "names", {"name": "gen_name"}, "fetch_date", "poke_gen", "gen_api_name")


def catalogue(raw: DataFrame) -> DataFrame:
    """Newest catalogue entry per entity."""
    rows = _parsed(raw, "pokemon_catalogue", "fetch_date").select(
        "fetch_date", _int("p.id").alias("poke_gen"), F.col("p.pokemon_species").alias("species")
    )
    listed = unnest(
        rows, "species", {"url": "url", "name": "poke_name"}, "fetch_date", "poke_gen"
    ).select("fetch_date", "poke_gen", _id(url_segment("url")).alias("poke_id"), "poke_name")
    return latest_per_key(listed, ["poke_id"], ["fetch_date", "poke_gen", "poke_name"])


def typed_entities(raw: DataFrame) -> DataFrame:
    """Every field of the entity payload that some view reads, as columns, from a single parse."""
    return _parsed(raw, "pokemons", "fetch_date", "id").select("fetch_date", "id", "p")


def _entity_fields(rows: DataFrame, *fields: str) -> DataFrame:
    """Struct ``p`` of the named fields, from payloads or from typed rows."""
    if "p" in rows.columns:
        return rows.select("fetch_date", "id", F.struct(*[F.col(f"p.{f}") for f in fields]).alias("p"))
    return _parsed(rows, "pokemons", "fetch_date", "id", fields=fields)


def entities(raw: DataFrame, catalogue_view: DataFrame) -> DataFrame:
    """Name and size per entity, with the generation the catalogue gives, if any."""
    sized = _entity_fields(raw, "name", "height", "weight").select(
        "fetch_date",
        F.col("id").alias("poke_id"),
        F.col("p.name").alias("poke_name"),
        round_scaled(_int("p.height") / 10).alias("height"),
        round_scaled(_int("p.weight") / 10).alias("weight"),
    )
    joined = sized.join(catalogue_view.select("poke_id", "poke_gen"), "poke_id", "left")
    return joined.select("fetch_date", "poke_gen", "poke_id", "poke_name", "height", "weight")


def entity_arrays(raw: DataFrame, *names: str) -> DataFrame:
    """Array columns of the entity payload, all five by default, from a single parse."""
    names = names or ENTITY_ARRAYS
    parsed = _entity_fields(raw, *names)
    return parsed.select(
        "fetch_date", F.col("id").alias("poke_id"), *[F.col(f"p.{n}").alias(n) for n in names]
    )


def move_details(raw: DataFrame) -> DataFrame:
    return _parsed(raw, "moves", "fetch_date").select(
        "fetch_date",
        _id("p.id").alias("move_id"),
        F.col("p.name").alias("move_name"),
        *[_int(f"p.{name}").alias(name) for name in ("power", "accuracy", "pp", "priority")],
        F.col("p.type.name").alias("type"),
        F.col("p.damage_class.name").alias("damage_class"),
        _int(url_tail("p.generation.url")).alias("poke_gen"),
    )


def version_groups(raw: DataFrame) -> DataFrame:
    """One row per version group and version."""
    rows = _parsed(raw, "version_groups", "fetch_date").select(
        "fetch_date",
        _int("p.id").alias("version_group_id"),
        F.col("p.name").alias("version_group_name"),
        _int(url_segment("p.generation.url")).alias("poke_gen"),
        F.col("p.versions").alias("versions"),
    )
    group = ("fetch_date", "version_group_id", "version_group_name", "poke_gen")
    return unnest(rows, "versions", {"url": "url", "name": "version_name"}, *group).select(
        *group, _int(url_segment("url")).alias("version_id"), "version_name"
    )


def species(raw: DataFrame) -> DataFrame:
    """Newest species row per entity: last text and the genus in the kept language, flags, parent.

    Text and genus are picked inside their arrays, without a shuffle. A payload with two matching
    genera gives two rows and one with none keeps its row.
    """
    parsed = _parsed(newest_fetch(raw), "pokemon_species", "fetch_date", "id")
    text = last_match("p.flavor_text_entries", "language.name", LANGUAGE)["flavor_text"]
    flags = ("is_legendary", "is_mythical", "is_baby")
    rows = parsed.select(
        "fetch_date",
        F.col("id").alias("poke_id"),
        clean_text(text).alias("description"),
        matching("p.genera", "language.name", LANGUAGE).alias("genera"),
        *[F.col(f"p.{flag}").cast("boolean").alias(flag) for flag in flags],
        F.col("p.color.name").alias("color"),
        F.col("p.habitat.name").alias("habitat"),
        F.col("p.evolves_from_species.name").alias("evolves_from_name"),
        _id(url_segment("p.evolves_from_species.url")).alias("evolves_from_id"),
    )
    # one row per entity before this point, so an outer unnest equals the left join on the key
    return rows.select(
        "fetch_date",
        "poke_id",
        "description",
        F.explode_outer("genera.genus").alias("genus"),
        *flags,
        "color",
        "habitat",
        "evolves_from_name",
        "evolves_from_id",
    )
