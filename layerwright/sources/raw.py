"""Raw landing tables: append-only rows of (id, fetch_date, batch_id, payload).

Where the payload carries its own id, that id is a column too, so that a landing never parses what
earlier ones stored.

Raw tables are partitioned by batch. Beside each stands ``<name>_keys``, which holds per batch a bitmap of
the hashed ids that landed with it. A landing compares its own ids with the bitmaps and reads only the
batches that may hold one of them; ids that no bitmap has are new for certain. The bitmaps are written
before the rows, so a job lost in between leaves bits without rows, which cost a look and nothing else.

``<name>_spans`` holds no rows, only partitions in the catalog: for each landing and batch the earliest and
the latest fetch time. A span is entered as begun before the rows and as done after them. ``Landed`` answers
from these entries which fetch is the newest and which batches hold rows since some time; of batches with a
landing that was lost in between, or without a span, it reads the fetch times instead.

Rows that are put into a raw table by other means than ``land`` have to come under batches of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime
from typing import Any, NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions import as_utc_timestamp, parse, payload_subset, url_tail
from layerwright.operators.incremental import append_unseen, high_water_mark, since
from layerwright.operators.latest import latest_per_key
from layerwright.operators.planning import split_malformed
from layerwright.operators.unnest import unnest
from layerwright.session import cut_lineage
from layerwright.sources import tables

_LANDING = "id bigint, fetch_date timestamp_ntz, batch_id string, payload string"

# The raw tables and their columns. Ids are 64 bit so that they do not overflow.
RAW_TABLES = {
    "generations": _LANDING,
    "pokemon_catalogue": _LANDING,
    "version_groups": _LANDING,
    "pokemons": _LANDING,
    "moves": _LANDING,
    "pokemon_species": _LANDING,
    "pokemon_ids": "poke_id bigint, poke_gen int",
}

# The payload fields the models read. Scalars stay text and are cast where used.
_NAMED = "struct<name:string>"
_LINK = "struct<url:string>"
_ENTRY_STATS = f"array<struct<base_stat:string, stat:{_NAMED}>>"
_ENTRY_TYPES = f"array<struct<slot:string, type:{_NAMED}>>"
PAYLOADS = {
    "generations": {
        "id": "string",
        "name": "string",
        "names": f"array<struct<name:string, language:{_NAMED}>>",
    },
    "pokemon_catalogue": {
        "id": "string",
        "pokemon_species": "array<struct<name:string, url:string>>",
    },
    "version_groups": {
        "id": "string",
        "name": "string",
        "generation": _LINK,
        "versions": "array<struct<name:string, url:string>>",
    },
    "pokemons": {
        "name": "string",
        "height": "string",
        "weight": "string",
        "stats": _ENTRY_STATS,
        "types": _ENTRY_TYPES,
        "past_types": f"array<struct<generation:{_LINK}, types:{_ENTRY_TYPES}>>",
        "past_stats": f"array<struct<generation:{_LINK}, stats:{_ENTRY_STATS}>>",
        "moves": f"array<struct<move:{_LINK}>>",
    },
    "moves": {
        "id": "string",
        "name": "string",
        "power": "string",
        "accuracy": "string",
        "pp": "string",
        "priority": "string",
        "type": _NAMED,
        "damage_class": _NAMED,
        "generation": _LINK,
    },
    "pokemon_species": {
        "flavor_text_entries": f"array<struct<flavor_text:string, language:{_NAMED}>>",
        "genera": f"array<struct<genus:string, language:{_NAMED}>>",
        "is_legendary": "string",
        "is_mythical": "string",
        "is_baby": "string",
        "color": _NAMED,
        "habitat": _NAMED,
        "evolves_from_species": "struct<name:string, url:string>",
    },
}


def payload_schema(table: str, *fields: str) -> str:
    """Schema of the named payload fields of a raw table, or of all its fields."""
    shape = PAYLOADS[table]
    return ", ".join(f"{name} {shape[name]}" for name in (fields or shape))


# Payloads cut to the fields needed before landing; the others land whole. Their landed
# rows have no id of their own; it is the payload's.
LANDED_SUBSET = ("generations", "pokemon_catalogue", "version_groups")


def create_raw_tables(spark: SparkSession, database: str) -> None:
    """The database and its raw tables, each created only if absent."""
    tables.create_database(spark, database)
    for name, columns in RAW_TABLES.items():
        parts = "batch_id" if "batch_id" in columns else None
        tables.create_if_absent(spark, f"{database}.{name}", columns, parts)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines: id, fetch_date as ISO text, batch_id, payload as JSON text."""
    schema = "id bigint, fetch_date string, batch_id string, payload string"
    return spark.read.schema(schema).json(path)


def stamp(df: DataFrame, fetch_date: str, batch_id: str) -> DataFrame:
    """Fetch time and batch id added to every row."""
    return df.withColumn("fetch_date", F.lit(fetch_date)).withColumn("batch_id", F.lit(batch_id))


def prepare(landed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows for raw table ``name``, rows for quarantine) from landed rows.

    The fetch time becomes a timestamp, and the payload is cut to the needed fields where the raw
    table keeps only those. Unreadable payloads and rows without an id are for quarantine.
    """
    good, bad = split_malformed(landed)
    if name in LANDED_SUBSET:
        own_id = F.get_json_object("payload", "$.id").cast("bigint")
        good = good.withColumn("id", F.coalesce("id", own_id))
    bad = bad.unionByName(good.where("id IS NULL"))
    good = good.where("id IS NOT NULL").withColumn("fetch_date", as_utc_timestamp("fetch_date"))
    if name in LANDED_SUBSET:
        good = good.withColumn("payload", payload_subset("payload", payload_schema(name)))
    columns = [part.split()[0] for part in RAW_TABLES[name].split(", ")]
    return good.select(*columns), bad


# What tells a row apart from those the raw table holds already.
GUARDS = {"id": ["id"], "fetch": ["id", "batch_id"]}


def land(
    spark: SparkSession, database: str, name: str, landed: DataFrame, guard: str = "id"
) -> None:
    """Append the landed rows that the raw table does not hold yet.

    ``guard="id"`` lands an id once. ``guard="fetch"`` lands it once per batch, so that a later batch
    may bring a newer payload of a known id. Of rows that are alike under the guard within one landing
    the newest lands. Unreadable payloads and rows without an id go to ``<name>_quarantine`` with
    everything they came with, each once. Landing the same rows again adds nothing to either table.
    The landed rows are evaluated once; of the tables only batches that may hold their like are read.
    """
    if guard not in GUARDS:
        raise ValueError(f"unknown guard {guard!r}")
    keys = GUARDS[guard]
    target = f"{database}.{name}"
    good, bad = prepare(cut_lineage(landed), name)
    if "batch_id" in keys:
        good = good.withColumn("batch_id", F.coalesce("batch_id", F.lit("")))
    good = cut_lineage(latest_per_key(good, keys, ["fetch_date", "payload"]))
    own = good.withColumn("batch_id", _batch())
    known = held_batches(spark, target, own, only_own="batch_id" in keys)
    if known is not None:
        good = cut_lineage(append_unseen(known.withColumn("batch_id", _batch()), own, keys))
    if name == "pokemon_catalogue":
        # before the payloads: once those are in, they no longer count as unseen
        lookup = f"{database}.pokemon_ids"
        found = latest_per_key(id_lookup(good), ["poke_id"], [F.col("poke_gen").asc()])
        tables.append(append_unseen(spark.table(lookup), found, ["poke_id"]), lookup)
    bitmaps = _bitmaps(good.withColumn("batch_id", _batch()))
    tables.create_like(bitmaps, f"{target}_keys")
    tables.append(bitmaps, f"{target}_keys")
    spans = _own_spans(good)
    _enter(spark, target, spans, "begun")
    tables.append(good, target)
    _enter(spark, target, spans, "done")
    _forget(spark, target, spans)
    quarantine = f"{target}_quarantine"
    tables.create_like(bad, quarantine, "batch_id")
    batches = [row[0] for row in bad.select(_batch().alias("batch_id")).distinct().collect()]
    tables.append(_unseen_rows(spark.table(quarantine).where(_batch().isin(batches)), bad), quarantine)


#: Bits of the bitmaps of a batch, in buckets of 32,768 each; only buckets with a bit are stored.
KEY_BITS = 1 << 26


def _batch() -> Column:
    """The batch of a row as text; an empty one is read back from its partition as NULL."""
    return F.coalesce("batch_id", F.lit(""))


def _key_bit() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(KEY_BITS))


def _bitmaps(rows: DataFrame) -> DataFrame:
    """Per batch and bucket the bitmap of the hashed ids."""
    bit = _key_bit()
    return rows.groupBy("batch_id", F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )


def _has_bit(bits: str, position: str) -> str:
    """SQL: is the bit at ``position`` set?"""
    byte = f"cast(conv(hex(substring({bits}, cast({position} div 8 as int) + 1, 1)), 16, 10) as int)"
    return f"getbit({byte}, cast({position} % 8 as int)) = 1"


class Span(NamedTuple):
    """The fetch times a landing brought to a batch, None where no row had one."""

    landing: str
    batch: str
    first: datetime | None
    last: datetime | None


_SPANS = "state string, landing string, batch string, first string, last string"
#: Stands before each value of a span, so that an empty one is told apart from a missing one.
_MARK = "="


def _own_spans(good: DataFrame) -> list[Span]:
    """One span for each batch of a landing."""
    landing = uuid.uuid4().hex
    found = good.groupBy(_batch().alias("batch")).agg(F.min("fetch_date"), F.max("fetch_date"))
    return [Span(landing, *row) for row in found.collect()]  # batches of one landing


def _entries(state: str, spans: Iterable[Span]) -> list[str]:
    def quoted(value: Any) -> str:
        text = "" if value is None else value.isoformat() if isinstance(value, datetime) else value
        text = text.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{_MARK}{text}'"

    names = ("state", *Span._fields)
    listed = [", ".join(f"{n} = {quoted(v)}" for n, v in zip(names, (state, *span))) for span in spans]
    return [f"PARTITION ({entry})" for entry in listed]


def _enter(spark: SparkSession, target: str, spans: list[Span], state: str) -> None:
    parts = ", ".join(part.split()[0] for part in _SPANS.split(", "))
    tables.create_if_absent(spark, f"{target}_spans", f"none boolean, {_SPANS}", parts)
    if spans:
        spark.sql(f"ALTER TABLE {target}_spans ADD IF NOT EXISTS {' '.join(_entries(state, spans))}")


def _forget(spark: SparkSession, target: str, spans: list[Span]) -> None:
    """Take out the spans entered as begun; they are done."""
    if spans:
        spark.sql(f"ALTER TABLE {target}_spans DROP IF EXISTS {', '.join(_entries('begun', spans))}")


class Landed:
    """The raw tables of a database by name, with what the catalog knows of their fetch times."""

    def __init__(self, spark: SparkSession, database: str):
        self._spark, self._database = spark, database

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.table(f"{self._database}.{name}")

    def _spans(self, name: str) -> tuple[dict[str, list[Span]], set[str]]:
        """The spans of each stored batch, and the batches whose spans may be wrong or are missing."""
        target = f"{self._database}.{name}"
        stored = {"" if batch is None else batch for (batch,) in partitions(self._spark, target)}
        entered: dict[str, list[Span]] = {batch: [] for batch in stored}
        begun, done = set(), set()
        index = f"{target}_spans"
        for part in partitions(self._spark, index) if tables.exists(self._spark, index) else ():
            state, landing, batch, *times = (value.removeprefix(_MARK) for value in part)
            if batch in stored:
                first, last = (datetime.fromisoformat(time) if time else None for time in times)
                entered[batch].append(Span(landing, batch, first, last))
                (done if state == "done" else begun).add((landing, batch))
        unsure = {batch for _, batch in begun - done} | {b for b, spans in entered.items() if not spans}
        return entered, unsure

    def _in(self, name: str, batches: Iterable[str]) -> DataFrame:
        chosen = sorted(batches)
        return self[name].where(_batch().isin(chosen) if chosen else F.lit(False))

    def newest(self, name: str) -> datetime | None:
        """The newest fetch time of a raw table; rows are read only of batches that may have another one."""
        entered, unsure = self._spans(name)
        times = [s.last for batch, spans in entered.items() if batch not in unsure for s in spans]
        if unsure:
            times.append(high_water_mark(self._in(name, unsure), "fetch_date"))
        return max((time for time in times if time is not None), default=None)

    def since(self, name: str, mark: Any) -> DataFrame:
        """Rows at or after the mark; batches that ended before it are not read."""
        if mark is None:
            return self[name]
        entered, unsure = self._spans(name)
        late = {batch for batch, spans in entered.items() if any(s.last and s.last >= mark for s in spans)}
        return since(self._in(name, late | unsure), "fetch_date", mark)


def partitions(spark: SparkSession, table: str) -> list[tuple[str | None, ...]]:
    """The values of each partition in the catalog, in the order of the partition columns."""
    return [
        tuple(_partition_value(part.partition("=")[2]) for part in row[0].split("/"))
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    ]


def _partition_value(written: str) -> str | None:
    """A value as it was before the catalog made it fit for a path; colons, for one, are escaped there."""
    return None if written == "__HIVE_DEFAULT_PARTITION__" else unquote(written)


def held_batches(spark: SparkSession, target: str, rows: DataFrame, only_own: bool = False) -> DataFrame | None:
    """The part of raw table ``target`` that may hold an id of ``rows``: whole batches; None if there is none.

    With ``only_own`` only the batches that ``rows`` come with can hold their like. Batches without
    bitmaps always may.
    """
    stored = {"" if batch is None else batch for (batch,) in partitions(spark, target)}
    if not stored:
        return None
    batches = stored
    index = f"{target}_keys"
    if tables.exists(spark, index):
        bitmaps = spark.table(index)
        asked = rows.groupBy(F.bitmap_bucket_number(_key_bit()).alias("bucket")).agg(
            F.collect_set(F.bitmap_bit_position(_key_bit())).alias("positions")  # at most 32,768
        )
        met = bitmaps.join(asked, "bucket").where(F.expr(f"exists(positions, p -> {_has_bit('bits', 'p')})"))
        marked = {row[0] for row in met.select("batch_id").distinct().collect()}
        indexed = {row[0] for row in bitmaps.select("batch_id").distinct().collect()}
        batches = stored & marked | stored - indexed
    if only_own:
        batches &= {row[0] for row in rows.select("batch_id").distinct().collect()}
    if not batches:
        return None
    return spark.table(target).where(_batch().isin(sorted(batches)))


def _unseen_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows, each once, of which the target holds no equal one; NULLs are equal to each other."""

    def marked(df: DataFrame) -> DataFrame:
        values = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in batch.columns]
        return df.withColumn("__row", F.sha2(F.concat_ws("\1", *values), 256))

    fresh = marked(batch).dropDuplicates(["__row"])
    return fresh.join(marked(target).select("__row"), "__row", "left_anti").drop("__row")


def id_lookup(catalogue: DataFrame) -> DataFrame:
    """Catalogue payloads flattened to (poke_id, poke_gen)."""
    parsed = catalogue.select(parse("payload", payload_schema("pokemon_catalogue")).alias("p"))
    documents = parsed.select(
        F.col("p.id").cast("int").alias("poke_gen"), F.col("p.pokemon_species").alias("species")
    )
    rows = unnest(documents, "species", {"url": "url"}, "poke_gen")
    return rows.select(url_tail("url").cast("bigint").alias("poke_id"), "poke_gen")
