"""Catalog tables whose replacement is all-or-nothing.

A table that is replaced is a view on its newest version. A load writes its rows to a new folder, enters
a new version in the catalog, with its columns, layout, keys and bucket folders, and then points the view
at it: that one statement is the switch, for a change of columns or layout and for any number of buckets
alike. The plan that builds the new rows may read the old version, readers never see a half-written one,
and a job lost anywhere leaves the old version or the new one whole.

A load of a bucketed table writes the buckets it touched; its version takes those from the new folder
and the others from where they lay. The version before the newest stays in the catalog for readers that
have planned on it; earlier entries go with the next load, folders stay until ``vacuum`` removes them.

Tables that only grow, such as raw ones, are plain tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.operators.incremental import high_water_mark, keyed_replace, since
from layerwright.session import shared_folder


BUCKET = "key_bucket"
#: The property that names a folder which the view reads besides the rows.
INDEX = "index"
#: Stands between the name of a table and that of a version.
_VERSION = "__v_"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def replace_table(
    df: DataFrame,
    table: str,
    root: str | None = None,
    bucketed: bool = False,
    properties: dict[str, Any] | None = None,
    shown: str = "SELECT * FROM {version}",
) -> None:
    """Write ``df`` as the whole content of ``table``, its columns included.

    ``shown`` is what the view selects from the version.
    """
    spark = df.sparkSession
    folder = _write(df, table, root, bucketed)
    held = None
    if bucketed:
        written = spark.read.schema(df.schema).parquet(folder).select(BUCKET).distinct()
        held = {row[0]: folder for row in written.collect()}  # at most one row per bucket
    _switch(df, table, folder, held, properties or {}, shown)


def current(spark: SparkSession, table: str) -> str:
    """The catalog table that holds the rows: the version a view points at, or the table itself."""
    if spark.catalog.getTable(table).tableType != "VIEW":
        return table
    return _properties(spark, table)["version"]


def _switch(
    df: DataFrame,
    table: str,
    folder: str,
    held: dict[int, str] | None,
    properties: dict[str, Any],
    shown: str = "SELECT * FROM {version}",
) -> None:
    """Enter a version of ``table`` with the columns of ``df`` and point the view at it.

    ``held`` gives the folder of each bucket where the version has buckets.
    """
    spark = df.sparkSession
    fresh = f"{table}{_VERSION}{uuid.uuid4().hex[:12]}"
    _create(df, fresh, folder, held, properties)
    former = ""
    if exists(spark, table):
        former = current(spark, table)
        if former == table:  # a table from before versions
            former = f"{table}{_VERSION}first"
            spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('version' = '{fresh}') AS {shown.format(version=fresh)}"
    )
    _drop_versions(spark, table, {fresh, former})


def _versions(spark: SparkSession, table: str) -> list[str]:
    database, _, name = table.rpartition(".")
    inside = f"IN {database} " if database else ""
    listed = spark.sql(f"SHOW TABLES {inside}LIKE '{name}{_VERSION}*'").collect()
    return [f"{database}.{row['tableName']}" if database else row["tableName"] for row in listed]


def _drop_versions(spark: SparkSession, table: str, kept: set[str]) -> None:
    """Take versions out of the catalog; their folders stay."""
    kept = {name.lower() for name in kept}
    for name in _versions(spark, table):
        if name.lower() not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types, in order but for the bucket column, which a catalog table keeps last."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema if f.name != BUCKET]


def is_bucketed(spark: SparkSession, table: str) -> bool:
    return any(c.name == BUCKET and c.isPartition for c in spark.catalog.listColumns(current(spark, table)))


def _create(
    df: DataFrame, table: str, folder: str, held: dict[int, str] | None = None, properties: dict[str, Any] | None = None
) -> None:
    spark = df.sparkSession
    layout = f"PARTITIONED BY ({BUCKET}) " if held is not None else ""
    noted = dict(properties or {})
    for at, place in enumerate(sorted(set((held or {}).values()))):
        noted[f"folder.{at}"] = place
        noted[f"buckets.{at}"] = ",".join(str(b) for b in sorted(held) if held[b] == place)
    listed = ", ".join(f"'{name}' = '{value}'" for name, value in noted.items())
    extra = f" TBLPROPERTIES ({listed})" if listed else ""
    spark.sql(f"CREATE TABLE {table} ({df.schema.toDDL()}) USING parquet {layout}LOCATION '{folder}'{extra}")
    if held:
        parts = " ".join(
            f"PARTITION ({BUCKET} = {bucket}) LOCATION '{place}/{BUCKET}={bucket}'" for bucket, place in held.items()
        )
        spark.sql(f"ALTER TABLE {table} ADD {parts}")


def _held(stored: dict[str, str]) -> dict[int, str]:
    """The folder of each bucket, from the properties of a version."""
    return {
        int(bucket): place
        for name, place in stored.items()
        if name.startswith("folder.")
        for bucket in stored[f"buckets.{name.partition('.')[2]}"].split(",")
    }


def vacuum(spark: SparkSession, table: str, root: str | None = None) -> list[str]:
    """Delete the folders of earlier versions of a table, and their catalog entries; the paths deleted.

    No reader may still be using an earlier version.
    """
    base = f"{(root or shared_folder(spark)).rstrip('/')}/{table.replace('.', '/')}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    newest = current(spark, table)
    _drop_versions(spark, table, {newest})
    noted = _properties(spark, newest)
    used = set(_held(noted).values()) or {_location(spark, newest)}
    used |= {noted[INDEX]} if INDEX in noted else set()
    names = {place.rstrip("/").rpartition("/")[2] for place in used}
    removed = []
    if not all(system.exists(jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")) for name in names):
        raise ValueError(f"{table} does not lie in {base}")
    for status in system.listStatus(path):
        folder = status.getPath()
        if status.isDirectory() and folder.getName() not in names:
            system.delete(folder, True)
            removed.append(folder.toString())
    return removed


def _location(spark: SparkSession, what: str) -> str:
    found = spark.sql(f"DESCRIBE FORMATTED {what}").where("col_name = 'Location'").collect()
    return found[0]["data_type"]


def replace_buckets(
    df: DataFrame,
    table: str,
    buckets: Sequence[int],
    root: str | None = None,
    properties: dict[str, Any] | None = None,
    emptied: Sequence[int] = (),
    shown: str = "SELECT * FROM {version}",
) -> None:
    """Write ``df`` as the whole content of some buckets of ``table``; the files of the others stay.

    All buckets change at once, with the switch to the new version. ``emptied`` have no rows any more.
    """
    spark = df.sparkSession
    held = _held(_properties(spark, current(spark, table)))
    folder = _write(df, table, root, bucketed=True)
    held |= {bucket: folder for bucket in buckets}
    held = {bucket: place for bucket, place in held.items() if bucket not in set(emptied)}
    _switch(df, table, folder, held, properties or {}, shown)


def fresh_folder(spark: SparkSession, table: str, root: str | None = None) -> str:
    """A folder of the table that nothing has been written to."""
    return f"{(root or shared_folder(spark)).rstrip('/')}/{table.replace('.', '/')}/{uuid.uuid4().hex}"


def _write(df: DataFrame, table: str, root: str | None, bucketed: bool) -> str:
    folder = fresh_folder(df.sparkSession, table, root)
    if bucketed:
        # few files per bucket, and a bucket with a hot key still split over several tasks
        df.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(folder)
    else:
        df.write.parquet(folder)
    return folder


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The bucket a row's key belongs to."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def create_if_absent(
    spark: SparkSession, table: str, schema: T.StructType | str, parts: str | None = None
) -> None:
    """An empty table of the given columns, unless there is one; ``parts`` names a partition column."""
    if not exists(spark, table):
        create_like(spark.createDataFrame([], schema), table, parts)


def create_like(df: DataFrame, table: str, parts: str | None = None) -> None:
    """An empty table with the columns of ``df``, unless there is one; ``parts`` names a partition column."""
    spark = df.sparkSession
    if not exists(spark, table):
        folder = f"{shared_folder(spark).rstrip('/')}/{table.replace('.', '/')}/{uuid.uuid4().hex}"
        layout = f"PARTITIONED BY ({parts}) " if parts else ""
        spark.sql(f"CREATE TABLE {table} ({df.schema.toDDL()}) USING parquet {layout}LOCATION '{folder}'")


def append(df: DataFrame, table: str) -> None:
    """Add rows to an existing table, columns matched by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(current(df.sparkSession, table))


def load_mart(
    source: DataFrame | Callable[[], DataFrame],
    table: str,
    key: str | Sequence[str],
    columns: Sequence[str],
    loaded_at: str = "fetch_date",
    mark_from: str = "source",
    full_refresh: bool = False,
    distinct: bool = False,
    root: str | None = None,
    buckets: int | None = None,
    dated: DataFrame | None = None,
    rows_since: Callable[[Any], DataFrame] | None = None,
    newest_time: Callable[[], Any] | None = None,
) -> None:
    """Bring a mart up to date from its source model.

    First run or ``full_refresh``: all rows. Later: rows at or after the high-water mark replace the
    mart rows that share their key. With ``mark_from="source"`` the mark is the newest time in the
    source, so only the newest batch is taken; with ``mark_from="target"`` it is the newest time
    already loaded (kept in the table property ``loaded_until``), so batches that arrived between
    two runs are taken too.

    ``dated`` is a narrower frame with the same newest time, from which the mark is read instead of
    from the source; ``rows_since`` gives the source rows at or after a mark where filtering the
    source would not reach its scan. With both of them ``source`` may be a function, which is called
    only where all rows are needed. ``newest_time`` gives the mark where it is known without a pass.

    With ``buckets`` the table is laid out by a hash of the key (column ``key_bucket``), and a later
    load reads and rewrites only the buckets its batch touches. None keeps the layout the table has, 0
    asks for none; another count than the stored one rebuilds the table. A load whose keys or columns
    differ from those of the table needs ``full_refresh``.
    """
    if mark_from not in ("source", "target"):
        raise ValueError(f"unknown mark_from {mark_from!r}")
    whole = source if callable(source) else lambda: source
    dated = whole() if dated is None else dated
    spark = dated.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    stored = properties_of(spark, table)
    have = int(stored.get("key_buckets", 0))
    want = have if buckets is None else buckets
    incremental = exists(spark, table) and not full_refresh
    # the mark costs a pass, so it is only taken where it is used
    newest = None
    if incremental or mark_from == "target":
        newest = high_water_mark(dated, loaded_at) if newest_time is None else newest_time()

    if incremental:
        if stored.get("keys", ",".join(keys)) != ",".join(keys):
            raise ValueError(f"{table} is keyed by {stored['keys']}: full_refresh is needed")
        mark = newest
        if mark_from == "target":
            mark = _loaded_until(spark, stored, dated.schema[loaded_at])
        rows = whole() if rows_since is None or mark is None else rows_since(mark)
        batch = since(rows, loaded_at, mark)
    else:
        batch = whole()
    batch = batch.select(*columns)
    if distinct:
        batch = batch.distinct()
    if incremental and _shape(spark.table(table)) != _shape(batch):
        raise ValueError(f"{table} has other columns: full_refresh is needed")
    properties = {"keys": ",".join(keys), "key_buckets": want}
    if mark_from == "target" and newest is not None:
        properties["loaded_until"] = newest
    elif "loaded_until" in stored:
        properties["loaded_until"] = stored["loaded_until"]
    if incremental and want == have and want:
        batch = with_bucket(batch, keys, want)
        # at most ``buckets`` numbers
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
        target = spark.table(table).where(F.col(BUCKET).isin(touched))
        replace_buckets(keyed_replace(target, batch, keys), table, touched, root, properties)
    else:
        if incremental:
            batch = keyed_replace(spark.table(table).drop(BUCKET), batch, keys)
        if want:
            batch = with_bucket(batch, keys, want)
        replace_table(batch, table, root, bucketed=bool(want), properties=properties)


def properties_of(spark: SparkSession, table: str) -> dict[str, str]:
    """What is noted with the newest version of a table; nothing where there is none."""
    return _properties(spark, current(spark, table)) if exists(spark, table) else {}


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _loaded_until(spark: SparkSession, stored: dict[str, str], field: T.StructField):
    if "loaded_until" not in stored:
        return None
    text = F.lit(stored["loaded_until"]).cast(field.dataType)
    return spark.range(1).select(text).first()[0]
