"""Raw landing tables built from the driver tables.

Every payload is made from one row of its source table, so the landing is a narrow job whatever the
keys look like, and its size grows with the tables. A payload is many times as wide as its row, so the
rows are dealt to tasks by their number first; how they lie in files does not matter. Edge cases are tied to column values: empty
arrays, missing stats, texts in other languages only, two or no matching genera, NULL parents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.plans.marts import LiveMarts, Views
from layerwright.session import fresh_path
from layerwright.sources.seeds import STARTERS, read_seed
from workloads.registry import table

FIRST = "2024-01-01 00:00:00"
SECOND = "2024-06-01 00:00:00"
API = "https://api.example.org/v2"

#: Rows of a source table that one task turns into payloads.
ROWS_OF_A_TASK = 1 << 15

# Factor of the key for each stat, in the order of the payload.
STAT_FACTORS = {
    "hp": 1,
    "attack": 7,
    "defense": 11,
    "special-attack": 13,
    "special-defense": 17,
    "speed": 19,
}


def _url(kind: str, number: str) -> str:
    return f"concat('{API}/{kind}/', {number}, '/')"


def _named(name: str) -> str:
    return f"named_struct('name', {name})"


def _stat(name: str, value: str) -> str:
    return f"named_struct('base_stat', CAST({value} AS INT), 'stat', {_named(repr(name))})"


def _typed(slot: int, name: str) -> str:
    return f"named_struct('slot', {slot}, 'type', {_named(name)})"


def _said(field: str, text: str, language: str) -> str:
    return f"named_struct('{field}', {text}, 'language', {_named(repr(language))})"


def _when(condition: str, *elements: str) -> str:
    """The elements as an array where the condition holds, else an empty array."""
    full = f"array({', '.join(elements)})"
    return f"IF({condition}, {full}, filter({full}, x -> false))"


def _dealt(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A source table in as many partitions as its rows ask for."""
    rows = table(spark, folder, name)
    return rows.repartition(max(1, math.ceil(rows.count() / ROWS_OF_A_TASK)), key)


def _land(rows: DataFrame, fetched: str, payload: dict[str, str], key: str | None = None) -> DataFrame:
    fields = ", ".join(f"'{name}', {value}" for name, value in payload.items())
    return rows.selectExpr(
        *([] if key is None else [f"CAST({key} AS BIGINT) AS id"]),
        f"TIMESTAMP_NTZ '{fetched}' AS fetch_date",
        f"'batch-{fetched[:10]}' AS batch_id",
        f"to_json(named_struct({fields}), map('ignoreNullFields', 'false')) AS payload",
    )


EARLY = "(p_size + 3) % 9 + 1"
LATE = "p_size % 9 + 1"


def _change(period: str, *types: str) -> str:
    generation = f"named_struct('url', {_url('generation', period)})"
    return f"named_struct('generation', {generation}, 'types', array({', '.join(types)}))"


def _entity_payload(height: str, n_moves: int) -> dict[str, str]:
    stats = [
        _stat(name, f"p_partkey * {factor} % 256")
        for name, factor in STAT_FACTORS.items()
        if name != "speed"
    ]
    speed = _stat("speed", f"p_partkey * {STAT_FACTORS['speed']} % 256")
    old_type, old_brand = _typed(1, "'OLD ' || p_type"), _typed(2, "'OLD ' || p_brand")
    once = _change(f"{EARLY} + 1", old_type)
    twice = (
        _change(f"{EARLY} + 1", old_type, old_brand),
        _change(f"{EARLY} + 3", _typed(1, "'MID ' || p_type")),
    )
    second_slot = _change(f"{LATE} + 2", old_brand)
    past_stat = (
        f"named_struct('generation', named_struct('url', {_url('generation', LATE + ' + 2')}), "
        f"'stats', array({_stat('attack', '10')}, {_stat('special', '20')}))"
    )
    move = _url("move", f"(p_partkey * 7 + j * 13) % {n_moves} + 1")
    return {
        "name": "p_name",
        "height": height,
        "weight": "CAST(floor(p_retailprice) AS INT)",
        "stats": f"concat(array({', '.join(stats)}), {_when('p_size != 1', speed)})",
        "types": f"concat(array({_typed(1, 'p_type')}), {_when('p_size > 25', _typed(2, 'p_brand'))})",
        "past_types": (
            f"CASE WHEN p_size <= 5 THEN array({', '.join(twice)}) "
            f"WHEN p_size <= 10 THEN array({once}) ELSE {_when('p_size > 45', second_slot)} END"
        ),
        "past_stats": _when("p_size BETWEEN 20 AND 23", past_stat),
        # the first move is listed twice
        "moves": (
            "transform(concat(array(0), sequence(0, p_size % 5)), "
            f"j -> named_struct('move', named_struct('url', {move})))"
        ),
    }


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as entities; those larger than 25 are fetched a second time, then taller."""
    part = _dealt(spark, folder, "part", "p_partkey")
    n_moves = table(spark, folder, "supplier").count()
    first = _land(part, FIRST, _entity_payload("p_size", n_moves), "p_partkey + 1")
    second = _land(
        part.where("p_size > 25"), SECOND, _entity_payload("p_size + 10", n_moves), "p_partkey + 1"
    )
    return first.unionByName(second)


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """One document per part; size 10 lists nothing, larger ones are listed again later."""
    part = _dealt(spark, folder, "part", "p_partkey")

    def listed(name: str, number: str) -> str:
        return f"named_struct('name', {name}, 'url', {_url('species', number)})"

    def document(generation: str, name: str, keep: str) -> dict[str, str]:
        form = listed(f"{name} || ' form'", "p_partkey + 1000000000001")
        return {
            "id": generation,
            "pokemon_species": _when(keep, listed(name, "p_partkey + 1"), form),
        }

    first = _land(part, FIRST, document(EARLY, "'old ' || p_name", "p_size != 10"))
    second = _land(part.where("p_size > 10"), SECOND, document(LATE, "p_name", "true"))
    return first.unionByName(second)


def species(spark: SparkSession, folder: str) -> DataFrame:
    part = _dealt(spark, folder, "part", "p_partkey")
    french = _said("flavor_text", "'fr ' || p_name", "fr")
    first_text = _said("flavor_text", "p_name || chr(12) || 'first'", "en")
    last_text = _said("flavor_text", "p_name || chr(12) || 'is' || chr(10) || p_type", "en")
    said_in_english = "p_size != 7"
    texts = ", ".join(
        [
            _when(said_in_english, first_text),
            f"array({french})",
            _when(said_in_english, last_text),
            f"array({french})",
        ]
    )
    genera = ", ".join(
        [
            f"array({_said('genus', repr('fr'), 'fr')})",
            _when("p_size != 9", _said("genus", "p_brand", "en")),
            _when("p_size = 8", _said("genus", "'second'", "en")),
        ]
    )
    parent = f"named_struct('name', 'parent of ' || p_name, 'url', {_url('species', 'p_partkey')})"

    def document(color: str) -> dict[str, str]:
        return {
            "flavor_text_entries": f"concat({texts})",
            "genera": f"concat({genera})",
            "is_legendary": "p_brand = 'Brand#9'",
            "is_mythical": "p_type = 'SMALL'",
            "is_baby": "p_size < 3",
            "color": _named(color),
            "habitat": f"IF(p_size <= 40, {_named('p_brand')}, NULL)",
            "evolves_from_species": f"IF(p_size > 20, {parent}, NULL)",
        }

    first = _land(part, FIRST, document("'grey'"), "p_partkey + 1")
    return first.unionByName(_land(part, SECOND, document("p_type"), "p_partkey + 1"))


def moves(spark: SparkSession, folder: str) -> DataFrame:
    payload = {
        "id": "s_suppkey + 1",
        "name": "lower(s_name)",
        "power": "IF(s_nationkey >= 6, CAST(floor(abs(s_acctbal)) AS INT) % 150, NULL)",
        "accuracy": "IF(s_nationkey >= 3, s_nationkey + 50, NULL)",
        "pp": "s_nationkey + 5",
        "priority": "s_nationkey % 3 - 1",
        "type": _named("'type-' || s_nationkey"),
        "damage_class": _named("elt(s_nationkey % 3 + 1, 'physical', 'special', 'status')"),
        "generation": f"named_struct('url', {_url('generation', 's_nationkey % 9 + 1')})",
    }
    return _land(_dealt(spark, folder, "supplier", "s_suppkey"), FIRST, payload, "s_suppkey + 1")


def generations(spark: SparkSession, folder: str) -> DataFrame:
    names = [_said("name", "'Nation ' || n_name", "en"), _said("name", "'Pays ' || n_name", "fr")]
    payload = {
        "id": "n_nationkey + 1",
        "name": "lower(n_name)",
        "names": f"array({', '.join(names)})",
    }
    return _land(table(spark, folder, "nation"), FIRST, payload)


def version_groups(spark: SparkSession, folder: str) -> DataFrame:
    def version(suffix: str, number: str) -> str:
        return f"named_struct('name', lower(n_name) || '{suffix}', 'url', {_url('version', number)})"

    versions = [version("-red", "n_nationkey * 2 + 1"), version("-blue", "n_nationkey * 2 + 2")]
    payload = {
        "id": "n_nationkey + 1",
        "name": "lower(n_name)",
        "generation": f"named_struct('url', {_url('generation', 'n_regionkey + 1')})",
        "versions": f"array({', '.join(versions)})",
    }
    return _land(table(spark, folder, "nation"), FIRST, payload)


BUILDERS = {
    "generations": generations,
    "pokemon_catalogue": catalogue,
    "version_groups": version_groups,
    "pokemons": entities,
    "moves": moves,
    "pokemon_species": species,
}


class RawTables:
    """Raw tables by name, each built only when a view asks for it.

    ``until`` leaves out what was fetched later, in the tables named in ``of`` or in all of them.
    """

    def __init__(
        self, spark: SparkSession, folder: str, until: str | None = None, of: tuple[str, ...] = tuple(BUILDERS)
    ):
        self._source = (spark, folder)
        self._until = until
        self._of = of
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            landed = BUILDERS[name](*self._source)
            if self._until is not None and name in self._of:
                landed = landed.where(f"fetch_date <= TIMESTAMP_NTZ '{self._until}'")
            self._built[name] = landed
        return self._built[name]


def starters(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of one brand as a CSV seed, written and read back."""
    path = fresh_path(spark, "starters")
    seed = table(spark, folder, "part").where(F.col("p_brand") == "Brand#1")
    seed.selectExpr(f"{LATE} AS generation", "p_partkey + 1 AS poke_id").write.csv(
        path, header=True
    )
    return read_seed(spark, path, STARTERS)


def views(spark: SparkSession, folder: str, **options) -> Views:
    return Views(RawTables(spark, folder), **options)


def live_marts(spark: SparkSession, folder: str, with_starters: bool = False) -> LiveMarts:
    seed = starters(spark, folder) if with_starters else None
    return LiveMarts(views(spark, folder), seed)
