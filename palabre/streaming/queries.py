"""Starting and stopping streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palabre.sources.manifests import Manifest, ManifestConflict


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run whose progress is kept in the checkpoint, made with it.

    It stays the same when the query starts again from there. A new checkpoint, even in
    the same place, is another run, whose batches are numbered from 0 again.
    """
    kept = Manifest(spark, f"{checkpoint.rstrip('/')}/run_name")
    while not (found := kept.read()[1]):
        try:
            kept.replace({"name": uuid.uuid4().hex}, 0)
        except ManifestConflict:
            continue  # another start has just named it
    return found["name"]


BatchFunction = Callable[[DataFrame, int], None]


def start_batches(
    stream: DataFrame,
    process: BatchFunction,
    checkpoint: str,
    interval: str | None = None,
    available_now: bool = False,
    name: str | None = None,
    empty_too: bool = False,
) -> StreamingQuery:
    """Run ``process`` on every non-empty micro-batch (with ``empty_too`` on every one).

    ``interval`` is a fixed trigger such as ``'30 seconds'``; without it batches
    follow each other at once. ``available_now`` works off what is there and
    ends. Each query needs a checkpoint of its own. An error fails the query, so
    the batch is run again after a restart.
    """

    def process_if_any(batch: DataFrame, batch_id: int) -> None:
        if empty_too or not batch.isEmpty():
            process(batch, batch_id)

    writer = (
        stream.writeStream.foreachBatch(process_if_any)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def run_all(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait until one of the queries ends or fails, then stop the others."""
    running = list(queries)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        stop_all(running)
