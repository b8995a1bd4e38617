"""Request topic to reply topic."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palabre.functions.records import decode_value
from palabre.operators.accounts import judge_logins
from palabre.operators.replies import (
    json_reply,
    reply_all_users,
    reply_messages,
    reply_users,
    table_as_json,
)
from palabre.operators.status import KeptStatus, kept_status_counts
from palabre.schemas import EMPTY_REPLY, MESSAGE_WITH_STATUS, REPLY, USER_LOGIN, USER_NOT_FOUND
from palabre.session import scratch, store
from palabre.sources.tables import read_table, table_exists
from palabre.sources.topics import Topics
from palabre.streaming.outbox import Outbox
from palabre.streaming.queries import run_name, start_batches

ReplyBuilder = Callable[[DataFrame, str | None], DataFrame]


def empty_reply(spark: SparkSession, request_key: str | None = None) -> DataFrame:
    return spark.createDataFrame([(request_key, EMPTY_REPLY)], REPLY)


def _missing(spark: SparkSession, *tables: str) -> bool:
    return not all(table_exists(spark, table) for table in tables)


def _fresh(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now: another stream may have rewritten a partition since."""
    spark.catalog.refreshTable(table)
    return read_table(spark, table)


def messages_reply(messages: str, metadata: str, **options) -> ReplyBuilder:
    """Replies with all messages and their status; ``[]`` while a table is missing."""

    def build(requests: DataFrame, request_key: str | None) -> DataFrame:
        spark = requests.sparkSession
        if _missing(spark, messages, metadata):
            return empty_reply(spark, request_key)
        return reply_messages(
            _fresh(spark, messages),
            _fresh(spark, metadata),
            request_key=request_key,
            **options,
        )

    return build


def kept_messages_reply(kept: KeptStatus, include_id: bool = False, **options) -> ReplyBuilder:
    """Replies with all messages and their status as it is kept: nothing is joined for a reply."""

    def build(requests: DataFrame, request_key: str | None) -> DataFrame:
        if not kept.exists():
            return empty_reply(requests.sparkSession, request_key)
        columns = (["message_id"] if include_id else []) + MESSAGE_WITH_STATUS.names
        rows = kept_status_counts(kept.read())
        return json_reply(rows, copies="copies", columns=columns, request_key=request_key, **options)

    return build


def parse_credentials(requests: DataFrame) -> DataFrame:
    records = decode_value(requests)
    return records.select(F.from_json("raw_data", USER_LOGIN).alias("data")).select("data.*")


@dataclass(frozen=True)
class UsersReply:
    """Replies with all users to requesters with right credentials, with an error to others.

    Called like any builder it judges a batch of requests as one; ``judge`` tells its
    requesters apart, and ``answer_requests`` gives each its own answer by that.
    """

    users: str
    options: dict[str, Any]

    def __call__(self, requests: DataFrame, request_key: str | None) -> DataFrame:
        spark = requests.sparkSession
        if _missing(spark, self.users):
            return empty_reply(spark, request_key)
        credentials = parse_credentials(requests).dropna()
        return reply_users(_fresh(spark, self.users), credentials, request_key=request_key, **self.options)

    def judge(self, requests: DataFrame) -> DataFrame | None:
        """``key, right`` for each requester; None while there is no table."""
        spark = requests.sparkSession
        if _missing(spark, self.users):
            return None
        records = decode_value(requests, keep_key=True)
        login = records.select("key", F.from_json("raw_data", USER_LOGIN).alias("data")).select("key", "data.*")
        return judge_logins(login, _fresh(spark, self.users))

    def all_users(self, spark: SparkSession, request_key: str | None) -> DataFrame:
        return reply_all_users(_fresh(spark, self.users), request_key=request_key, **self.options)


def users_reply(users: str, **options) -> UsersReply:
    """Replies with all users to requests with right credentials, else with an error."""
    return UsersReply(users, options)


def table_reply(table: str, **options) -> ReplyBuilder:
    """Replies with a whole table; ``[]`` while it is missing."""

    def build(requests: DataFrame, request_key: str | None) -> DataFrame:
        spark = requests.sparkSession
        if _missing(spark, table):
            return empty_reply(spark, request_key)
        return table_as_json(_fresh(spark, table), request_key=request_key, **options)

    return build


def _pointers(keys: DataFrame, name: str) -> DataFrame:
    """For each key a message that says where the reply is."""
    pointer = F.to_json(F.struct(F.lit(name).alias("reply"))).alias("value")
    return keys.filter(F.col("key").isNotNull()).select("key", pointer)


@contextmanager
def answer_requests(requests: DataFrame, build: ReplyBuilder, name: str) -> Iterator[DataFrame]:
    """The replies to the requests of a batch, each requester under its own key.

    What all may see is made once. If one requester gets it, it has that one's key. Else
    it has the key ``name``, and each requester gets a message that points to it:
    ``{"reply": name}``. Where requests carry credentials (``UsersReply``), only requesters
    with right ones get the users or the pointer, each of the others an error. The replies
    are there within the context only: what is stored for them goes with it.
    """
    key = F.col("key").cast("string").alias("key")
    judged = build.judge(requests) if isinstance(build, UsersReply) else None
    spark = requests.sparkSession
    with scratch(spark, "reply"):
        if judged is None:
            keys = requests.select(key).distinct()
            first = keys.limit(2).collect()
            if len(first) == 1:
                yield build(requests, first[0]["key"])
            else:
                yield build(requests, name).unionByName(_pointers(keys, name))
            return
        # One row for each requester.
        judged = store(judged, "judged")
        wrong = judged.filter(~F.col("right")).select("key", F.lit(USER_NOT_FOUND).alias("value"))
        keys = judged.filter("right").select("key")
        first = keys.limit(2).collect()
        if not first:
            yield wrong
        elif len(first) == 1:
            yield build.all_users(spark, first[0]["key"]).unionByName(wrong)
        else:
            yield build.all_users(spark, name).unionByName(_pointers(keys, name)).unionByName(wrong)


def start_responder(
    spark: SparkSession,
    topics: Topics,
    request_topic: str,
    reply_topic: str,
    build: ReplyBuilder,
    checkpoint: str,
    interval: str | None = None,
    available_now: bool = False,
    **source_options: str,
) -> StreamingQuery:
    """Answer each non-empty batch of requests; a batch that is run again is answered once."""

    run = run_name(spark, checkpoint)
    outbox = Outbox(spark, topics, f"{checkpoint.rstrip('/')}/outbox")

    def answer(batch: DataFrame, batch_id: int) -> None:
        requests = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with answer_requests(requests, build, f"{run}-{batch_id}") as replies:
                outbox.publish(batch_id, lambda: replies, reply_topic)
        finally:
            requests.unpersist()

    return start_batches(
        topics.stream(spark, request_topic, **source_options),
        answer,
        checkpoint,
        interval=interval,
        available_now=available_now,
    )
