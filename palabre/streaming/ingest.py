"""Topic to table: validated, replay-safe ingest."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from palabre.functions.records import to_envelope
from palabre.functions.values import date_parts
from palabre.operators.ingest import Ingested, ingest_json
from palabre.schemas import stored
from palabre.sources.tables import (
    BATCH_COLUMN,
    BATCH_PARTITIONS,
    DATE_COLUMNS,
    RUN_COLUMN,
    ensure_table,
    quarantine,
    write_batch,
)
from palabre.sources.topics import Topics
from palabre.streaming.outbox import Outbox
from palabre.streaming.queries import run_name, start_batches

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestJob:
    """What to do with the records of one topic.

    ``with_id`` stores an id in front of the record. With ``buckets`` the table is
    bucketed by ``bucket_by``: the column that later joins are made on.
    ``by_date`` partitions the table by the day of the ingest.
    ``save_topic`` gets a copy of each stored record. ``show`` prints that many
    records of each batch to the console.
    """

    topic: str
    schema: StructType
    table: str
    error_table: str
    key: str | None = None
    required: Sequence[str] = ()
    aliases: Mapping[str, Sequence[str]] | None = None
    with_id: bool = True
    keep_id: bool = False
    unwrap: bool = False
    by_date: bool = False
    save_topic: str | None = None
    file_format: str = "orc"
    bucket_by: str = "id"
    buckets: int | None = None
    show: int = 0
    location: str | None = None
    error_location: str | None = None

    def create_table(self, spark: SparkSession) -> None:
        dates = DATE_COLUMNS if self.by_date else {}
        ensure_table(
            spark,
            self.table,
            stored(self.schema) if self.with_id else self.schema,
            file_format=self.file_format,
            bucket_by=self.bucket_by,
            buckets=self.buckets,
            partition_by={**BATCH_PARTITIONS, **dates},
            location=self.location,
        )


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    job: IngestJob,
    topics: Topics | None = None,
    run: str = "main",
    outbox: Outbox | None = None,
) -> dict[str, int]:
    """Store the valid records of a micro-batch, quarantine the others, publish copies.

    The batch is parsed once. Ids depend on the records' topic positions only and
    each batch of a run owns its partition, so a replay replaces what it wrote. Copies for
    the save topic are made from that partition and, with an ``outbox``, sent once; without
    one a replay sends them again, with the same ids. Returns the numbers of
    records: valid and invalid ones are counted in what was written, so a task that ran
    twice changes nothing.
    """
    spark = batch.sparkSession
    ingested = ingest_json(
        batch,
        job.schema,
        key=job.key,
        required=job.required,
        aliases=job.aliases,
        unwrap=job.unwrap,
        with_id=job.with_id,
        keep_id=job.keep_id,
    )
    parsed = ingested.parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kept = replace(ingested, parsed=parsed)
        observed = Observation()
        counted = replace(ingested, parsed=parsed.observe(observed, *kept.counts()))
        job.create_table(spark)
        if job.show:
            kept.parsed.drop("processed_time").show(job.show, truncate=False)
        rows = counted.valid
        if job.by_date:
            rows = rows.select("*", *date_parts(F.col("processed_time")))
        cluster_by = job.bucket_by if job.buckets else None
        write_batch(rows, job.table, batch_id, cluster_by=cluster_by, run=run)
        counts = dict(observed.get)
        if counts["invalid"]:
            quarantine(kept.invalid, job.error_table, batch_id, job.error_location, run)
        counts = _reconciled(spark, kept, counts, job, run, batch_id)
        if topics is not None and job.save_topic and counts["valid"]:
            stored_columns = [f.name for f in (stored(job.schema) if job.with_id else job.schema).fields]

            def copies() -> DataFrame:
                return to_envelope(_partition(spark, job.table, run, batch_id).select(*stored_columns))

            if outbox is None:
                topics.publish(copies(), job.save_topic)
            else:
                outbox.publish(batch_id, copies, job.save_topic, repeatable=True)
    finally:
        parsed.unpersist()
    log.info("%s batch %d: %s", job.table, batch_id, counts)
    return counts


def _partition(spark: SparkSession, table: str, run: str, batch_id: int) -> DataFrame:
    """The rows that a batch has written."""
    return spark.read.table(table).filter((F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) == batch_id))


def _reconciled(
    spark: SparkSession, ingested: Ingested, seen: dict[str, int], job: IngestJob, run: str, batch_id: int
) -> dict[str, int]:
    """The numbers seen on the way to the tables, counted again if the tables hold others.

    A task that ran twice is seen twice but writes once. Files know how many rows they
    have, so the comparison reads none.
    """
    valid = _partition(spark, job.table, run, batch_id).count()
    invalid = _partition(spark, job.error_table, run, batch_id).count() if seen["invalid"] else 0
    if (valid, invalid) == (seen["valid"], seen["invalid"]):
        return seen
    log.warning("%s batch %d: seen %s, stored %d and %d", job.table, batch_id, seen, valid, invalid)
    return ingested.stats().first().asDict()


def start_ingest(
    spark: SparkSession,
    topics: Topics,
    job: IngestJob,
    checkpoint: str,
    interval: str | None = None,
    available_now: bool = False,
    **source_options: str,
) -> StreamingQuery:
    """Keep a table up to date with a topic."""
    run = run_name(spark, checkpoint)
    outbox = Outbox(spark, topics, f"{checkpoint.rstrip('/')}/outbox")
    return start_batches(
        topics.stream(spark, job.topic, **source_options),
        lambda batch, batch_id: ingest_batch(batch, batch_id, job, topics, run, outbox),
        checkpoint,
        interval=interval,
        available_now=available_now,
    )
