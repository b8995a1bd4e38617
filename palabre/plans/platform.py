"""The chat and retail jobs, wired to their topics and tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palabre import schemas
from palabre.operators.status import KeptStatus
from palabre.sources.topics import Topics
from palabre.streaming import (
    IngestJob,
    kept_messages_reply,
    messages_reply,
    start_classifier,
    start_ingest,
    start_responder,
    start_router,
    start_stateful_registration,
    start_status,
    users_reply,
)
from palabre.streaming.relay import Routes

USERS = IngestJob(
    schemas.REGISTER,
    schemas.USER,
    "users",
    "users_errors",
    bucket_by="email",
    save_topic="users_save",
)
MESSAGES = IngestJob(
    schemas.IA_MESSAGE,
    schemas.MESSAGE,
    "messages",
    "messages_errors",
    aliases={"Created_At": ["created_at"]},
    keep_id=True,
    unwrap=True,
    save_topic="messages_save",
)
METADATA = IngestJob(
    schemas.CHECK_MESSAGE,
    schemas.MESSAGE_METADATA,
    "message_metadata",
    "metadata_errors",
    bucket_by="id_message",
    save_topic="message_metadata_save",
)
PRODUCTS = IngestJob(
    schemas.PRODUCTS_TOPIC,
    schemas.PRODUIT,
    "produits2",
    "produits_errors",
    key="produit_id",
    with_id=False,
)
PURCHASES = IngestJob(
    schemas.PURCHASES_TOPIC,
    schemas.ACHAT,
    "achats",
    "achats_errors",
    key="achat_id",
    with_id=False,
)
RETAIL_USERS = IngestJob(
    schemas.PURCHASES_TOPIC,
    schemas.RETAIL_USER,
    "retail_users",
    "retail_users_errors",
    key="user_id",
    with_id=False,
    by_date=True,
)


def _placed(job: IngestJob, warehouse: str | None, prefix: str = "") -> IngestJob:
    """The job with its tables under a folder of their own, each at its own place."""
    job = replace(job, table=prefix + job.table, error_table=prefix + job.error_table)
    if warehouse is None:
        return job
    return replace(
        job,
        location=f"{warehouse}/{job.table}",
        error_location=f"{warehouse}/{job.error_table}",
    )


def start_chat(
    spark: SparkSession,
    topics: Topics,
    checkpoints: str,
    warehouse: str | None = None,
    interval: str | None = schemas.TRIGGER_INTERVAL,
    available_now: bool = False,
    buckets: int | None = None,
    classify: Callable[[DataFrame], DataFrame] | None = None,
    unique_users: bool = False,
    reply_interval: str | None = None,
    prefix: str = "",
    keep_status: bool = False,
    routed: Sequence[str] = (),
    routes: Routes | Callable[[], Routes] | None = None,
    **source_options: str,
) -> list[StreamingQuery]:
    """Ingest users, messages and verdicts, and answer requests for users and messages.

    ``checkpoints`` is the folder for the queries' progress. ``buckets`` is the number for
    the tables' join keys: messages by id, verdicts by the message's id, users by e-mail;
    choose it for the size that they will reach. With ``classify`` sent messages are
    labelled on their way (that of a ``ModelStore`` follows promotions); with ``unique_users`` an
    e-mail registers once, by a state for each. With ``keep_status`` the messages' status is
    kept up to date and replies need no join. The records of ``routed`` topics are copied to
    their readers by ``routes`` (which a ``RouteTable`` may change while it runs).
    ``reply_interval`` bounds how often requests are answered (default: ``interval``).
    ``prefix`` goes before the tables' names, for instance a database and a dot.
    """
    ingests = [
        start_ingest(
            spark,
            topics,
            replace(_placed(job, warehouse, prefix), buckets=buckets),
            f"{checkpoints}/{job.table}",
            interval=interval,
            available_now=available_now,
            **source_options,
        )
        for job in ((MESSAGES, METADATA) if unique_users else (USERS, MESSAGES, METADATA))
    ]
    if unique_users:
        users = _placed(USERS, warehouse, prefix)
        ingests.append(
            start_stateful_registration(
                spark,
                topics,
                users.topic,
                users.table,
                f"{checkpoints}/{USERS.table}",
                interval=interval,
                available_now=available_now,
                location=users.location,
                buckets=buckets,
                error_table=users.error_table,
                error_location=users.error_location,
                **source_options,
            )
        )
    if classify is not None:
        ingests.insert(
            0,
            start_classifier(
                spark,
                topics,
                classify,
                f"{checkpoints}/classifier",
                interval=interval,
                available_now=available_now,
                error_table=f"{prefix}send_message_errors",
                error_location=f"{warehouse}/send_message_errors" if warehouse else None,
                **source_options,
            ),
        )
    all_messages = messages_reply(prefix + MESSAGES.table, prefix + METADATA.table)
    if keep_status:
        kept = KeptStatus(spark, f"{warehouse or checkpoints}/{prefix}message_status", buckets or 64)
        all_messages = kept_messages_reply(kept)
        ingests.append(
            start_status(
                spark,
                topics,
                kept,
                f"{checkpoints}/message_status",
                interval=interval,
                available_now=available_now,
                **source_options,
            )
        )
    ingests += [
        start_router(
            spark,
            topics,
            topic,
            f"{checkpoints}/router_{topic}",
            routes,
            interval=interval,
            available_now=available_now,
            **source_options,
        )
        for topic in routed
    ]
    replies = {
        (schemas.SEND_USERS, schemas.GET_USERS): users_reply(prefix + USERS.table),
        (schemas.SEND_ALL_MESSAGES, schemas.GET_ALL_MESSAGES): all_messages,
    }
    responders = [
        start_responder(
            spark,
            topics,
            request,
            reply,
            build,
            f"{checkpoints}/{reply}",
            interval=reply_interval or interval,
            available_now=available_now,
            **source_options,
        )
        for (request, reply), build in replies.items()
    ]
    return ingests + responders


def start_retail(
    spark: SparkSession,
    topics: Topics,
    checkpoints: str,
    warehouse: str | None = None,
    jobs: tuple[IngestJob, ...] = (PRODUCTS, PURCHASES),
    interval: str | None = schemas.TRIGGER_INTERVAL,
    available_now: bool = False,
    **source_options: str,
) -> list[StreamingQuery]:
    """Ingest products and purchases (and whatever other jobs are named)."""
    return [
        start_ingest(
            spark,
            topics,
            _placed(job, warehouse),
            f"{checkpoints}/{job.table}",
            interval=interval,
            available_now=available_now,
            **source_options,
        )
        for job in jobs
    ]
