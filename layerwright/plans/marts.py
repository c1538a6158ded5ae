"""The finished tables: from views to keyed, incrementally loaded marts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from layerwright.functions import tier, tier_sql, total
from layerwright.operators.incremental import high_water_mark, since
from layerwright.operators.ordered import rank_table
from layerwright.plans import intermediate as inter
from layerwright.plans import staging as stg
from layerwright.session import cut_lineage
from layerwright.sources import ranks, tables
from layerwright.sources.raw import Landed

TOTAL = "total_stat_points"
STATS = tuple(inter.STAT_COLUMNS.values())


@dataclass(frozen=True)
class Mart:
    """Where a mart comes from: its source view, its key and its columns."""

    view: str
    key: str
    columns: tuple[str, ...]
    distinct: bool = False

    @property
    def landed_in(self) -> str:
        """The raw table whose fetch times the rows of the view carry."""
        return LANDED_IN.get(self.view, "pokemons")


# Views whose rows carry the fetch times of another raw table than the entities'.
LANDED_IN = {
    "stg_generations": "generations",
    "stg_move_details": "moves",
    "stg_pokemon_species": "pokemon_species",
    "stg_version_groups": "version_groups",
}

# Key and columns of every incrementally loaded mart.
MARTS = {
    "mart_generations": Mart("stg_generations", "poke_gen", ("poke_gen", "gen_name")),
    "mart_moves": Mart(
        "stg_move_details",
        "move_id",
        (
            "move_id",
            "move_name",
            "power",
            "accuracy",
            "pp",
            "priority",
            "type",
            "damage_class",
            "poke_gen",
        ),
    ),
    "mart_past_types": Mart(
        "int_type_history",
        "type_id",
        ("type_id", "poke_id", "slot", "type", "valid_from_gen", "valid_to_gen"),
    ),
    "mart_pokemon_moves": Mart(
        "int_pokemon_moves", "pokemon_move_id", ("pokemon_move_id", "poke_id", "move_id")
    ),
    "mart_pokemon_species": Mart(
        "stg_pokemon_species",
        "poke_id",
        (
            "poke_id",
            "description",
            "genus",
            "is_legendary",
            "is_mythical",
            "is_baby",
            "color",
            "habitat",
            "evolves_from_name",
            "evolves_from_id",
        ),
    ),
    "mart_pokemons": Mart(
        "stg_pokemons", "poke_id", ("poke_gen", "poke_id", "poke_name", "height", "weight")
    ),
    "mart_stats": Mart("int_stats_total", "poke_id", ("poke_id", *STATS, TOTAL)),
    "mart_types": Mart("int_types", "poke_id", ("type_id", "poke_id", "slot", "type")),
    "mart_version_group_versions": Mart(
        "stg_version_groups", "version_id", ("version_id", "version_name", "version_group_id")
    ),
    "mart_version_groups": Mart(
        "stg_version_groups",
        "version_group_id",
        ("version_group_id", "version_group_name", "poke_gen"),
        distinct=True,
    ),
}


class Views:
    """The staging and intermediate views over a set of raw tables, each built when asked for.

    ``raw`` maps raw table names to DataFrames; ``sources.raw.Landed`` does so for the tables of a database
    and lets incremental loads take their mark and their batches from the catalog. Entities and moves are cut to their newest fetch
    unless ``all_fetches`` is set. With ``stored`` the entity payloads are parsed once, for all views,
    and the typed rows are written to the shared folder.
    """

    def __init__(
        self,
        raw: dict[str, DataFrame] | Landed,
        all_fetches: bool = False,
        history_rule: str = "documented",
        stored: bool = False,
    ):
        self._raw = raw
        self._all_fetches = all_fetches
        self._history_rule = history_rule
        self._stored = stored
        self._built: dict[str, DataFrame] = {}
        self._cut: dict[str, DataFrame] = {}
        self._typed: DataFrame | None = None

    def stored(self) -> Views:
        """The same views over entity payloads that are parsed and written once."""
        return Views(self._raw, self._all_fetches, self._history_rule, stored=True)

    def since(self, table: str, mark: Any) -> Views:
        """The views over the rows of one raw table landed at or after a mark.

        The newest row of an id among those is its newest row of all, so each view gives the rows that
        it would give for those ids over the whole table, and the filter reaches the scan.
        """
        if isinstance(self._raw, Landed):
            rows = self._raw.since(table, mark)
        else:
            rows = since(self._raw[table], "fetch_date", mark)
        raw = _Replaced(self._raw, table, rows)
        return Views(raw, self._all_fetches, self._history_rule, stored=True)

    def newest(self, table: str) -> Any:
        """The newest fetch time of a raw table, from the catalog where that keeps it."""
        if isinstance(self._raw, Landed):
            return self._raw.newest(table)
        return high_water_mark(self._raw[table].select("fetch_date"), "fetch_date")

    def raw(self, table: str) -> DataFrame:
        return self._raw[table]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._BUILDERS[name](self)
        return self._built[name]

    def names(self) -> list[str]:
        return list(self._BUILDERS)

    def _newest(self, table: str) -> DataFrame:
        if self._all_fetches:
            return self._raw[table]
        if table not in self._cut:
            self._cut[table] = stg.newest_fetch(self._raw[table])
        return self._cut[table]

    def _entities(self) -> DataFrame:
        """Entity rows with their payload, or with the typed fields where those are stored."""
        if not self._stored:
            return self._newest("pokemons")
        if self._typed is None:
            self._typed = cut_lineage(stg.typed_entities(self._newest("pokemons")))
        return self._typed

    def _array(self, name: str) -> DataFrame:
        return stg.entity_arrays(self._entities(), name)

    _BUILDERS = {
        "stg_generations": lambda v: stg.generations(v._raw["generations"]),
        "stg_pokemon_catalogue": lambda v: stg.catalogue(v._raw["pokemon_catalogue"]),
        "stg_pokemons": lambda v: stg.entities(v._entities(), v["stg_pokemon_catalogue"]),
        "stg_stats": lambda v: v._array("stats"),
        "stg_types": lambda v: v._array("types"),
        "stg_pokemon_moves": lambda v: v._array("moves"),
        "stg_past_types": lambda v: v._array("past_types"),
        "stg_past_stats": lambda v: v._array("past_stats"),
        "stg_move_details": lambda v: stg.move_details(v._newest("moves")),
        "stg_version_groups": lambda v: stg.version_groups(v._raw["version_groups"]),
        "stg_pokemon_species": lambda v: stg.species(v._raw["pokemon_species"]),
        "int_stats": lambda v: inter.stats(v["stg_stats"]),
        "int_stats_total": lambda v: with_total(v["int_stats"]),
        "int_types": lambda v: inter.types(v["stg_types"]),
        "int_past_types": lambda v: inter.past_types(v["stg_past_types"]),
        "int_past_stats": lambda v: inter.past_stats(v["stg_past_stats"]),
        "int_pokemon_moves": lambda v: inter.entity_moves(v["stg_pokemon_moves"]),
        "int_type_history": lambda v: inter.type_history(
            v["int_past_types"], v["int_types"], v["stg_pokemons"], v._history_rule
        ),
        "int_stats_history": lambda v: inter.stats_history(
            v["int_past_stats"], v["int_stats"], v["stg_pokemons"], v._history_rule
        ),
    }


class _Replaced:
    """Raw tables by name with one of them replaced; the others are still built when asked for."""

    def __init__(self, raw: dict[str, DataFrame], name: str, rows: DataFrame):
        self._raw, self._name, self._rows = raw, name, rows

    def __getitem__(self, name: str) -> DataFrame:
        return self._rows if name == self._name else self._raw[name]


def with_total(int_stats: DataFrame) -> DataFrame:
    return int_stats.withColumn(TOTAL, total(STATS))


def mart(views: Views, name: str) -> DataFrame:
    """A mart as a full rebuild would hold it."""
    spec = MARTS[name]
    rows = views[spec.view].select(*spec.columns)
    return rows.distinct() if spec.distinct else rows


STRONGEST = "mart_strongest_pokemons"
RANKED_COLUMNS = ("poke_gen", "poke_id", "poke_name", *STATS, TOTAL)
RANKING = ranks.Ranking(TOTAL, ("poke_id",), (("tier", tier_sql("pct_rank")),), percent_rank=False)


def with_stats(mart_entities: DataFrame, mart_stats: DataFrame) -> DataFrame:
    """The rows that are ranked."""
    rows = mart_entities.select("poke_gen", "poke_id", "poke_name").join(mart_stats, "poke_id")
    return rows.select(*RANKED_COLUMNS)


def strongest(mart_entities: DataFrame, mart_stats: DataFrame) -> DataFrame:
    """Every entity ranked by its total, with a tier from the percent rank."""
    ranked = rank_table(with_stats(mart_entities, mart_stats), TOTAL, ["poke_id"])
    return ranked.withColumn("tier", tier("pct_rank")).drop("pct_rank")


def strongest_starters(
    mart_entities: DataFrame, mart_stats: DataFrame, starters: DataFrame
) -> DataFrame:
    """The seeded entities ranked among themselves."""
    seed = starters.select("poke_id")
    rows = (
        mart_entities.select("poke_gen", "poke_id", "poke_name")
        .join(seed, "poke_id")
        .join(mart_stats, "poke_id")
    )
    return rank_table(
        rows.select("poke_gen", "poke_id", "poke_name", *STATS, TOTAL),
        TOTAL,
        ["poke_id"],
        percent_rank=None,
    )


class LiveMarts:
    """Marts by name as a full rebuild would hold them, planned when asked for and never stored."""

    def __init__(self, views: Views, starters: DataFrame | None = None):
        self._views = views
        self._starters = starters
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name == "mart_strongest_pokemons":
            return strongest(self["mart_pokemons"], self["mart_stats"])
        if name == "mart_strongest_starters":
            return strongest_starters(self["mart_pokemons"], self["mart_stats"], self._starters)
        return mart(self._views, name)

    def some(self, *names: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in names}


def load_marts(
    views: Views,
    database: str,
    starters: DataFrame | None = None,
    names: list[str] | None = None,
    mark_from: str = "source",
    full_refresh: bool = False,
    buckets: int | None = None,
) -> None:
    """Load the named marts (all by default) into ``database``, then the ranked ones.

    ``buckets`` lays the marts out by key, so that a load rewrites only what its batch touches. Marks
    come from the fetch times of the raw tables, or from the catalog where the views are over ``Landed``,
    and a later load reads only raw rows at or after them. Entity payloads are parsed once for all marts.
    The ranks over the whole marts are stored as well, and a later load ranks anew only the ranges that
    its batch touches; the starters' cover all starters of the marts, not only those of the newest batch.
    """
    wanted = list(MARTS) if names is None else names
    spark = views.raw(MARTS[wanted[0]].landed_in).sparkSession
    tables.create_database(spark, database)
    whole = views.stored()
    narrowed: dict[tuple[str, Any], Views] = {}
    batches: dict[str, DataFrame] = {}
    before = _ranked_from(spark, database)
    for name in wanted:
        spec = MARTS[name]

        def rows_since(mark: Any, name: str = name, spec: Mart = spec) -> DataFrame:
            at = spec.landed_in, mark
            if at not in narrowed:
                narrowed[at] = views.since(*at)
            batches[name] = narrowed[at][spec.view]
            return batches[name]

        tables.load_mart(
            lambda spec=spec: whole[spec.view],
            f"{database}.{name}",
            spec.key,
            spec.columns,
            mark_from=mark_from,
            full_refresh=full_refresh,
            distinct=spec.distinct,
            buckets=buckets,
            dated=views.raw(spec.landed_in).select("fetch_date"),
            rows_since=rows_since,
            newest_time=lambda spec=spec: views.newest(spec.landed_in),
        )
    loaded = set(_RANKED_FROM) & set(wanted)
    if loaded and _ranked_from(spark, database) is not None:
        _load_ranks(spark, database, before, [batches.get(name) for name in sorted(loaded)])
    if starters is not None:
        ranked = strongest_starters(
            _loaded(spark, database, "mart_pokemons"),
            _loaded(spark, database, "mart_stats"),
            starters,
        )
        tables.replace_table(ranked, f"{database}.mart_strongest_starters")


_RANKED_FROM = ("mart_pokemons", "mart_stats")


def _ranked_from(spark: SparkSession, database: str) -> str | None:
    """The versions of the marts that are ranked, None where one is missing."""
    names = [f"{database}.{name}" for name in _RANKED_FROM]
    if not all(tables.exists(spark, name) for name in names):
        return None
    return ",".join(tables.current(spark, name) for name in names)


def _load_ranks(
    spark: SparkSession, database: str, before: str | None, batches: list[DataFrame | None]
) -> None:
    """Bring the stored ranks up to date: from the keys of the batches where they held what was there before."""
    table = f"{database}.{STRONGEST}"
    made_from = _ranked_from(spark, database)
    entities, stats = (_loaded(spark, database, name) for name in _RANKED_FROM)
    known = before is not None and None not in batches
    if not known or not ranks.fits(spark, table, before, RANKED_COLUMNS):
        ranks.load_all(with_stats(entities, stats), table, RANKING, made_from)
        return
    changed = cut_lineage(
        reduce(DataFrame.union, [batch.select("poke_id") for batch in batches]).distinct()
    )
    rows = with_stats(entities.join(changed, "poke_id", "left_semi"), stats.join(changed, "poke_id", "left_semi"))
    ranks.load_changes(changed, rows, table, RANKING, made_from)


def _loaded(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}").drop(tables.BUCKET)


def loaded_marts(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The mart tables of a database by name, the stored ranks among them."""
    names = [*MARTS, STRONGEST, "mart_strongest_starters"]
    return {
        name: _loaded(spark, database, name)
        for name in names
        if tables.exists(spark, f"{database}.{name}")
    }
