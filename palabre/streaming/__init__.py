"""Structured Streaming jobs over topics and tables."""

from palabre.streaming.ingest import IngestJob, ingest_batch, start_ingest
from palabre.streaming.outbox import Outbox
from palabre.streaming.queries import run_all, start_batches, stop_all
from palabre.streaming.registration import (
    register_batch,
    start_registration,
    start_stateful_registration,
)
from palabre.streaming.relay import RouteTable, route_batch, start_classifier, start_router
from palabre.streaming.responder import (
    answer_requests,
    kept_messages_reply,
    messages_reply,
    start_responder,
    table_reply,
    users_reply,
)
from palabre.streaming.status import merge_batch, start_status

__all__ = [
    "IngestJob",
    "Outbox",
    "RouteTable",
    "answer_requests",
    "ingest_batch",
    "kept_messages_reply",
    "merge_batch",
    "messages_reply",
    "register_batch",
    "route_batch",
    "run_all",
    "start_batches",
    "start_classifier",
    "start_ingest",
    "start_registration",
    "start_responder",
    "start_router",
    "start_stateful_registration",
    "start_status",
    "stop_all",
    "table_reply",
    "users_reply",
]
