"""Landed files taken up as they arrive: each file is read once, then the job ends or waits.

This is the refresh that follows a landing: new files go to the raw table and, after each batch, the
marts that depend on it are brought up to date by the ordinary incremental load.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from layerwright.sources import raw

LANDED = "id bigint, fetch_date string, batch_id string, payload string"


def follow_landing(
    spark: SparkSession,
    database: str,
    name: str,
    folder: str,
    progress: str,
    after_batch: Callable[[], None] | None = None,
    once: bool = True,
    files_per_batch: int | None = None,
    guard: str = "id",
) -> StreamingQuery:
    """Append new JSON files of ``folder`` to raw table ``name``.

    ``progress`` is the checkpoint folder that remembers which files are done. A batch repeated after
    a failure adds no row twice: landing leaves out what the raw table and the quarantine hold under
    ``guard`` (see ``raw.land``). With ``once`` the query stops when all files present are done.
    """
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}
    files = spark.readStream.schema(LANDED).options(**options).json(folder)

    def take(batch: DataFrame, _: int) -> None:
        raw.land(batch.sparkSession, database, name, batch, guard)
        # the batch ran in a session of its own; this one must not keep an older list of files
        for table in (name, f"{name}_quarantine"):
            spark.catalog.refreshTable(f"{database}.{table}")
        if after_batch is not None:
            after_batch()

    writer = files.writeStream.foreachBatch(take).option("checkpointLocation", progress)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
