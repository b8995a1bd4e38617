"""Registrations that keep e-mails unique."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from palabre.operators.accounts import email_key, register_unique
from palabre.operators.ingest import ingest_json
from palabre.schemas import USER, stored
from palabre.sources.tables import (
    BATCH_COLUMN,
    BATCH_PARTITIONS,
    RUN_COLUMN,
    ensure_table,
    quarantine,
    visible_rows,
    write_batch,
)
from palabre.sources.topics import Topics
from palabre.streaming.queries import run_name, start_batches

log = logging.getLogger(__name__)


def register_batch(
    batch: DataFrame,
    batch_id: int,
    table: str,
    order_by: Sequence[str] = ("date_inscription", "id"),
    buckets: int | None = None,
    location: str | None = None,
    error_table: str | None = None,
    error_location: str | None = None,
    run: str = "main",
) -> dict[str, int]:
    """Store the registrations of a micro-batch whose e-mail is new.

    The table is the state: known e-mails are those of other runs and of earlier batches
    of this one, so a replay of the batch decides alike and replaces what it wrote. With
    ``buckets`` the table is bucketed by e-mail and is not shuffled for the decision.
    That is checkpointed because Spark does not overwrite a table that the plan reads.
    Records that are no registration go to ``error_table`` (by default ``<table>_errors``).
    Returns the numbers of records.
    """
    spark = batch.sparkSession
    ensure_table(
        spark,
        table,
        stored(USER),
        bucket_by="email",
        buckets=buckets,
        partition_by=BATCH_PARTITIONS,
        location=location,
    )
    ingested = ingest_json(batch, USER, unwrap=True)
    parsed = ingested.parsed.persist(StorageLevel.MEMORY_AND_DISK)
    ingested = replace(ingested, parsed=parsed)
    try:
        counts = ingested.stats().first().asDict()
        own = (F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) >= batch_id)
        known = visible_rows(spark, table).filter(~own).select("email")
        accepted = register_unique(ingested.valid, known, order_by).checkpoint()
        write_batch(accepted, table, batch_id, cluster_by="email" if buckets else None, run=run)
        if counts["invalid"]:
            quarantine(ingested.invalid, error_table or f"{table}_errors", batch_id, error_location, run)
    finally:
        parsed.unpersist()
    log.info("%s batch %d: %s", table, batch_id, counts)
    return counts


#: The state store that keeps more keys than fit in memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EMAIL, _SHARE = "_email", "_share"
#: E-mails are dealt to so many shares, which have one state each: asking for a state costs far more
#: than reading some e-mails. Fixed with a checkpoint.
SHARES = 1 << 16


def _shared(emails: DataFrame) -> DataFrame:
    return emails.withColumn(_SHARE, F.pmod(F.xxhash64(_EMAIL), F.lit(SHARES)).cast("int"))


class FirstOfEmail(StatefulProcessor):
    """Lets the first registration of each e-mail of a share pass; the state is which are taken."""

    def __init__(self, order_by: Sequence[str]) -> None:
        self._order_by = tuple(order_by)

    def init(self, handle: StatefulProcessorHandle) -> None:
        # An entry for each batch that had new ones.
        self._taken = handle.getListState("taken", "emails array<string>")

    def _rank(self, row: Row) -> tuple:
        return tuple((row[c] is not None, row[c]) for c in self._order_by)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[str, Row] = {}
        for row in rows:
            before = first.get(row[_EMAIL])
            if before is None or self._rank(row) < self._rank(before):
                first[row[_EMAIL]] = row
        for (emails,) in self._taken.get():
            for email in emails:
                first.pop(email, None)
        if first:
            self._taken.appendValue((list(first),))
        yield from first.values()

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self._taken.appendValue((list(initialState["emails"]),))

    def close(self) -> None:
        pass


def _first_in_chunk(order_by: Sequence[str]):
    """Of each Arrow batch the first row of each e-mail: what a hot one sends to its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pc.sort_indices(
                batch, sort_keys=[(c, "ascending") for c in order_by], null_placement="at_start"
            ).to_numpy()
            emails = batch.column(_EMAIL).dictionary_encode().indices.to_numpy()
            _, first = np.unique(emails[order], return_index=True)
            yield batch.take(pa.array(np.sort(order[first])))

    return run


def start_stateful_registration(
    spark: SparkSession,
    topics: Topics,
    topic: str,
    table: str,
    checkpoint: str,
    known: Sequence[str] = (),
    order_by: Sequence[str] = ("date_inscription", "id"),
    interval: str | None = None,
    available_now: bool = False,
    location: str | None = None,
    buckets: int | None = None,
    error_table: str | None = None,
    error_location: str | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Keep a table of users with unique e-mails up to date, by a state for each share of the e-mails.

    Of a batch's e-mails the shares are read (``SHARES`` in all, by a hash). The state begins with the e-mails of ``table`` and of the ``known`` tables (of those that
    exist) and lives with the checkpoint: after the first batch no table is read, however
    many users there are. State and table move on together, batch by batch, and a batch that
    is run again writes the same rows. So only this query may add users; e-mails that come
    to the tables by other ways afterwards are not seen. ``spark.sql.shuffle.partitions`` is
    fixed with the checkpoint: choose it for the number of e-mails.
    """
    run = run_name(spark, checkpoint)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ensure_table(
        spark, table, stored(USER), bucket_by="email", buckets=buckets, partition_by=BATCH_PARTITIONS, location=location
    )
    ingested = ingest_json(topics.stream(spark, topic, **source_options), USER, unwrap=True)
    names = [f.name for f in stored(USER).fields]
    offered = _shared(ingested.valid.select(*names, email_key().alias(_EMAIL)))
    fewer = offered.mapInArrow(_first_in_chunk(order_by), offered.schema)
    taken = None
    for name in (table, *known):
        if not spark.catalog.tableExists(name):
            continue
        rows = visible_rows(spark, name)
        if name == table:
            rows = rows.filter(F.col(RUN_COLUMN) != run)
        emails = rows.select(email_key().alias(_EMAIL))
        taken = emails if taken is None else taken.unionByName(emails)
    known_by_share = _shared(taken.distinct()).groupBy(_SHARE).agg(F.collect_list(_EMAIL).alias("emails"))
    accepted = fewer.groupBy(_SHARE).transformWithState(
        statefulProcessor=FirstOfEmail(order_by),
        outputStructType=offered.schema,
        outputMode="Append",
        timeMode="None",
        initialState=known_by_share.groupBy(_SHARE),
    )
    rejected = ingested.invalid.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in stored(USER).fields], "corrupt_record", "processed_time"
    )
    both = accepted.drop(_EMAIL, _SHARE).unionByName(rejected, allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = rows.filter(F.col("corrupt_record").isNull()).select(*names)
            write_batch(good, table, batch_id, cluster_by="email" if buckets else None, run=run)
            bad = rows.filter(F.col("corrupt_record").isNotNull())
            if not bad.isEmpty():
                quarantine(bad, error_table or f"{table}_errors", batch_id, error_location, run)
        finally:
            rows.unpersist()

    # A look whether a batch is empty would run the stateful operator an extra time.
    return start_batches(
        both, write, checkpoint, interval=interval, available_now=available_now, empty_too=True
    )


def start_registration(
    spark: SparkSession,
    topics: Topics,
    topic: str,
    table: str,
    checkpoint: str,
    interval: str | None = None,
    available_now: bool = False,
    location: str | None = None,
    buckets: int | None = None,
    error_table: str | None = None,
    error_location: str | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Keep a table of users with unique e-mails up to date with a topic."""
    run = run_name(spark, checkpoint)
    return start_batches(
        topics.stream(spark, topic, **source_options),
        lambda batch, batch_id: register_batch(
            batch,
            batch_id,
            table,
            buckets=buckets,
            location=location,
            error_table=error_table,
            error_location=error_location,
            run=run,
        ),
        checkpoint,
        interval=interval,
        available_now=available_now,
    )
