"""Topic to topic: classification and routing of messages on their way."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palabre.functions.records import decode_value
from palabre.operators.ingest import ingest_json
from palabre.operators.messages import route
from palabre.schemas import IA_MESSAGE, ROUTES, SEND_MESSAGE, SENT_MESSAGE
from palabre.sources.manifests import Manifest
from palabre.sources.tables import quarantine
from palabre.sources.topics import Topics
from palabre.streaming.outbox import Outbox
from palabre.streaming.queries import run_name, start_batches

log = logging.getLogger(__name__)


def start_classifier(
    spark: SparkSession,
    topics: Topics,
    classify: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    source_topic: str = SEND_MESSAGE,
    target_topic: str = IA_MESSAGE,
    interval: str | None = None,
    available_now: bool = False,
    error_table: str = "send_message_errors",
    error_location: str | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Label the messages of one topic and publish them to the next, each under its key and once.

    ``classify`` is called for each batch: that of a ``ModelStore`` follows promotions. Records that are no message with a text go to ``error_table`` as they came.
    """
    run = run_name(spark, checkpoint)
    outbox = Outbox(spark, topics, f"{checkpoint.rstrip('/')}/outbox")

    def relay(batch: DataFrame, batch_id: int) -> None:
        records = decode_value(batch, keep_key=True, unwrap=True).withColumnRenamed("key", "_key")
        ingested = ingest_json(records, SENT_MESSAGE, key="message", with_id=False, keep=["_key"])
        parsed = ingested.parsed.persist(StorageLevel.MEMORY_AND_DISK)
        ingested = replace(ingested, parsed=parsed)
        try:
            sent = parsed.filter(ingested.is_valid).select("_key", *SENT_MESSAGE.names)
            labelled = classify(sent)
            fields = [F.col(c) for c in labelled.columns if c != "_key"]
            value = F.to_json(F.struct(*fields)).alias("value")
            outbox.publish(batch_id, lambda: labelled.select(F.col("_key").alias("key"), value), target_topic)
            if not ingested.invalid.isEmpty():
                quarantine(ingested.invalid, error_table, batch_id, error_location, run)
        finally:
            parsed.unpersist()

    return start_batches(
        topics.stream(spark, source_topic, **source_options),
        relay,
        checkpoint,
        interval=interval,
        available_now=available_now,
    )


Routes = Mapping[str, Sequence[str]]


class RouteTable:
    """A routing table that can be changed while routers run.

    It is a manifest in a folder. A router that is given the table asks for it before each
    batch, so a change takes effect from the next batch on.
    """

    def __init__(self, spark: SparkSession, path: str, start: Routes | None = None) -> None:
        self._manifest = Manifest(spark, path)
        if start is not None and not self._manifest.read()[0]:
            self.change({topic: list(readers) for topic, readers in start.items()})

    def __call__(self) -> dict[str, list[str]]:
        return self._manifest.read()[1].get("routes", {})

    def change(self, readers: Mapping[str, Sequence[str] | None]) -> None:
        """Set the readers of some topics; None takes a topic out."""
        version, document = self._manifest.read()
        routes = {**document.get("routes", {}), **{t: list(r) if r is not None else None for t, r in readers.items()}}
        self._manifest.replace({"routes": {t: r for t, r in routes.items() if r is not None}}, version)


def route_batch(
    batch: DataFrame, batch_id: int, routes: Routes | None, outbox: Outbox, changing: bool = False
) -> dict[str, int]:
    """Send each record of a batch to a topic per reader, once; the numbers of records.

    Records without a reader are counted as ``unrouted`` and left. ``changing`` says that the
    routes may be others when the batch is run again, so what is sent is stored first.
    """
    table = {t: r for t, r in (ROUTES if routes is None else routes).items() if r}
    reached = F.col("topic").isin(*table) if table else F.lit(False)
    numbers = batch.agg(F.count(F.lit(1)).alias("records"), F.count_if(~reached).alias("unrouted")).first().asDict()
    if numbers["unrouted"] < numbers["records"]:
        routed = route(batch.filter(reached), table)
        addressed = routed.select("key", "value", F.col("destination").alias("topic"))
        outbox.publish(batch_id, lambda: addressed, repeatable=not changing)
    if numbers["unrouted"]:
        log.warning("%d of %d records have no reader", numbers["unrouted"], numbers["records"])
    return numbers


def start_router(
    spark: SparkSession,
    topics: Topics,
    source_topic: str,
    checkpoint: str,
    routes: Routes | Callable[[], Routes] | None = None,
    interval: str | None = None,
    available_now: bool = False,
    counted: Callable[[dict[str, int]], None] | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Copy each record to a topic per reader, once; records without a reader are counted and left.

    ``routes`` may be a ``RouteTable`` (or any function that gives the routes): it is asked before
    each batch. ``counted`` gets each batch's numbers of records and unrouted ones.
    """
    run_name(spark, checkpoint)
    outbox = Outbox(spark, topics, f"{checkpoint.rstrip('/')}/outbox")

    def relay(batch: DataFrame, batch_id: int) -> None:
        now = routes() if callable(routes) else routes
        numbers = route_batch(batch, batch_id, now, outbox, changing=callable(routes))
        if counted is not None:
            counted(numbers)

    return start_batches(
        topics.stream(spark, source_topic, **source_options),
        relay,
        checkpoint,
        interval=interval,
        available_now=available_now,
    )
