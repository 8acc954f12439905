"""Incremental load of landed files into a merged raw table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.sinks import merge_latest


def incremental_ingest(
    spark: SparkSession,
    landing: str,
    schema: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    file_format: str = "json",
    max_files: int = 1000,
) -> None:
    """Merge every file that arrived since the last run, then stop.

    ``checkpoint`` remembers the files already taken. A batch repeated after a
    failure merges to the same table, as merging keeps the newest row per key; it
    rewrites the key ranges it touches. Read the table with ``sinks.read_merged``.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .format(file_format)
        .load(landing)
    )

    def merge(batch: DataFrame, _: int) -> None:
        rows = transform(batch) if transform else batch
        merge_latest(batch.sparkSession, target, rows, keys, newest)

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
