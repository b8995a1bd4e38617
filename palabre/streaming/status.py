"""Messages and verdicts to the kept status."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palabre.operators.ingest import ingest_json
from palabre.operators.status import KeptStatus
from palabre.schemas import CHECK_MESSAGE, IA_MESSAGE, MESSAGE, MESSAGE_METADATA
from palabre.sources.topics import Topics
from palabre.streaming.queries import run_name, start_batches

log = logging.getLogger(__name__)


def merge_batch(
    batch: DataFrame,
    batch_id: int,
    kept: KeptStatus,
    run: str = "main",
    message_topic: str = IA_MESSAGE,
    verdict_topic: str = CHECK_MESSAGE,
) -> list[int]:
    """Merge the messages and verdicts of a batch of both topics; the buckets written.

    They are read as the chat's ingest reads them, so ids are the same. What isn't valid is
    left to the ingest, which keeps it.
    """
    records = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sent = ingest_json(
            records.filter(F.col("topic") == message_topic),
            MESSAGE,
            aliases={"Created_At": ["created_at"]},
            keep_id=True,
            unwrap=True,
        ).valid
        checked = ingest_json(records.filter(F.col("topic") == verdict_topic), MESSAGE_METADATA).valid
        written = kept.merge(sent, checked, run, batch_id)
    finally:
        records.unpersist()
    log.info("%s batch %d: buckets %s", kept.location, batch_id, written)
    return written


def start_status(
    spark: SparkSession,
    topics: Topics,
    kept: KeptStatus,
    checkpoint: str,
    message_topic: str = IA_MESSAGE,
    verdict_topic: str = CHECK_MESSAGE,
    interval: str | None = None,
    available_now: bool = False,
    **source_options: str,
) -> StreamingQuery:
    """Keep the status of messages up to date with the topics of messages and verdicts."""
    run = run_name(spark, checkpoint)
    both = topics.stream(spark, message_topic, **source_options).unionByName(
        topics.stream(spark, verdict_topic, **source_options)
    )
    return start_batches(
        both,
        lambda batch, batch_id: merge_batch(batch, batch_id, kept, run, message_topic, verdict_topic),
        checkpoint,
        interval=interval,
        available_now=available_now,
    )
