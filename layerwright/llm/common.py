"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: The folder that holds the package, for Python workers that do not have it on their path.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows converted to Python at a time.
SLICE = 512


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session find this package."""
    environment = spark.sparkContext.environment
    folders = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in folders:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, folders)])


#: What this worker has loaded last. One thing at a time, so that stages do not add up in its memory.
_LOADED: dict[str, Any] = {}


def loaded(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept for the later tasks of the same worker."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = make()
    return _LOADED[key]


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_rows(
    df: DataFrame, added: str | T.StructType, start: Callable[[], Callable], passed: int = 1
) -> DataFrame:
    """Pass rows through a Python function, Arrow batch by Arrow batch.

    ``start`` is called once per task and returns a function. It gets the values of the columns after
    the first ``passed`` ones, row by row, and returns the values of the ``added`` columns as a tuple.
    The first ``passed`` columns are handed on as they are.
    """
    importable(df.sparkSession)
    kept = T.StructType(df.schema.fields[:passed])
    more = added if isinstance(added, T.StructType) else T.StructType.fromDDL(added)
    schema = T.StructType(kept.fields + more.fields)
    types = [field.type for field in to_arrow_schema(more)]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                given = [column.to_pylist() for column in part.columns[passed:]]
                rows = [function(*values) for values in zip(*given)]
                made = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*part.columns[:passed], *made], names)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def row_key(doc_id: Column, text: Column) -> Column:
    """Identifies a document by its id and its text, so that a repeated id does no harm."""
    return F.concat_ws(
        ":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))
    )


def keep_rows(docs: DataFrame, keys: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose ``row_key`` is among ``keys`` (a frame of one column), each key once.

    The join leaves the rows dealt and sorted by key, so that dropping repeats takes no shuffle of its
    own.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(F.col(doc_id), F.col(text).cast("string")))
    return keyed.join(keys.toDF(key), key, "left_semi").dropDuplicates([key]).select(docs.columns)


def drop_rows(docs: DataFrame, keys: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose ``row_key`` is not among ``keys`` (a frame of one column)."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(F.col(doc_id), F.col(text).cast("string")))
    return keyed.join(keys.toDF(key), key, "left_anti").select(docs.columns)


def in_slices(values: list, size: int) -> Iterable[list]:
    for at in range(0, len(values), size):
        yield values[at : at + size]
