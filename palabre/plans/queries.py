"""One checked query per operator, over whole test tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palabre import operators as ops
from palabre import schemas
from palabre.functions import assign_id, decode_value, format_time, parse_time, to_envelope
from palabre.plans import fixtures as fx
from palabre.session import shared_dir, store
from palabre.sources import (
    FileTopics,
    append_partitioned_by_date,
    append_table,
    compact_batches,
    compaction,
    ensure_table,
    overwrite_table,
    read_json_records,
    read_table,
    spread,
    write_batch,
)
from palabre.plans.platform import MESSAGES, METADATA, start_chat
from palabre.sources.tables import BATCH_PARTITIONS, DATE_COLUMNS
from palabre.streaming import (
    IngestJob,
    Outbox,
    RouteTable,
    ingest_batch,
    messages_reply,
    start_classifier,
    start_ingest,
    start_registration,
    start_responder,
    start_router,
    start_stateful_registration,
    start_status,
    table_reply,
    users_reply,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query; it runs in UTC, like the jobs."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _time_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: format_time(F.col(c)) for c in columns})


def _new_table(spark: SparkSession) -> tuple[str, str]:
    """A table name not in use, and its place in the shared folder."""
    return f"palabre_{uuid.uuid4().hex}", shared_dir(spark, "table")


def _contract(
    reply: DataFrame, request_key: str | None = None, max_rows: int = 10_000, max_bytes: int = 900_000
) -> DataFrame:
    """What a client gets of a reply: each record with its copies, and a word on the messages.

    Right are: one message under the bare key, or several under keys of their own with a
    closing message that tells their number; none too large, but for a single record.
    """
    closing = F.concat_ws("/", F.lit(request_key), F.lit("parts"))
    is_closing = F.coalesce(F.col("key") == closing, F.lit(False))
    parts = F.get_json_object("value", "$.parts").cast("long")
    told = reply.select("key", "value", is_closing.alias("closing"))
    items = F.from_json("value", "array<string>")
    records = told.filter(~F.col("closing")).select(F.explode(items).alias("record"))
    records = records.groupBy("record").agg(F.count("*").alias("copies"))
    checked = told.select("key", "closing", parts.alias("parts"), F.size(items).alias("n"), F.octet_length("value").alias("bytes"))
    fits = (F.col("n") <= max_rows) & ((F.col("bytes") <= max_bytes) | (F.col("n") == 1))
    message = ~F.col("closing")
    all_ = checked.agg(
        F.count_if(message).alias("messages"),
        F.count_if(message & ~fits).alias("large"),
        F.count_distinct(F.when(message, F.col("key"))).alias("keys"),
        F.count_if(message & F.col("key").eqNullSafe(F.lit(request_key))).alias("bare"),
        F.max("parts").alias("parts"),
    )
    one = (F.col("messages") == 1) & (F.col("bare") == 1) & F.col("parts").isNull()
    many = (F.col("parts") == F.col("messages")) & (F.col("keys") == F.col("messages")) & (F.col("bare") == 0)
    right = (F.col("large") == 0) & (one | F.coalesce(many, F.lit(False)))
    verdict = all_.select(
        F.when(right, "keys and sizes are right").otherwise("keys or sizes are wrong").alias("record"),
        F.lit(1).cast("long").alias("copies"),
    )
    return records.unionByName(verdict)


# Messages and their moderation status.


@query
def messages_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.messages_with_status(fx.messages(spark, sf_dir), fx.verdicts(spark, sf_dir))
    return _time_as_text(df, "Created_At")


@query
def messages_with_many_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, verdicts = fx.order_messages(spark, sf_dir), fx.line_verdicts(spark, sf_dir)
    return _time_as_text(ops.messages_with_status(messages, verdicts), "Created_At")


@query
def messages_with_latest_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest verdict of each message; the labels name a message once."""
    messages, verdicts = fx.messages(spark, sf_dir), fx.verdicts(spark, sf_dir)
    df = ops.messages_with_status(messages, verdicts, latest_only=True)
    return _time_as_text(df, "Created_At")


@query
def messages_raw_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.messages_left_join(fx.messages(spark, sf_dir), fx.verdicts(spark, sf_dir))
    return _time_as_text(df, "Created_At", "metadata_date")


@query
def message_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, verdicts = fx.order_messages(spark, sf_dir), fx.line_verdicts(spark, sf_dir)
    return ops.status_counts(messages, verdicts).select("message_id", "valide", "copies")


@query
def reply_messages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = ops.reply_messages(
        fx.messages(spark, sf_dir), fx.verdicts(spark, sf_dir), include_id=True, max_rows=200
    )
    return _contract(reply, max_rows=200)


@query
def reply_cut_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose bytes cut the reply long before their number does."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return _contract(ops.table_as_json(docs, request_key="r", max_bytes=60_000), "r", max_bytes=60_000)


@query
def reply_nameless_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as messages without an id: nothing but their record tells them apart."""
    turns = fx.table(spark, sf_dir, "conversations").select(
        F.lit(None).cast("string").alias("id"),
        F.col("text").alias("message"),
        F.timestamp_seconds(F.col("turn") + fx.EPOCH).alias("Created_At"),
        F.col("role").alias("user_id"),
        F.col("conv_id").cast("string").alias("chat_id"),
        F.lit("").alias("type"),
    )
    reply = ops.reply_messages(turns, fx.verdicts(spark, sf_dir), request_key="r", max_rows=20)
    return _contract(reply, "r", max_rows=20)


@query
def reply_messages_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of one or two records, so that a message's copies are spread."""
    reply = ops.reply_messages(
        fx.order_messages(spark, sf_dir),
        fx.line_verdicts(spark, sf_dir),
        request_key="request",
        max_rows=2,
    )
    return _contract(reply, "request", max_rows=2)


@query
def normalize_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = fx.table(spark, sf_dir, "conversations").withColumns(
        {"message": F.col("text"), "user_id": F.nullif(F.col("role"), F.lit("system"))}
    )
    now = F.lit("2024-05-06 07:08:09").cast("timestamp")
    return ops.normalize_message(sent, ["conv_id", "turn"], now)


@query
def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = F.create_map(
        *[
            F.lit(v)
            for v in (
                "signup", schemas.REGISTER,
                "view", schemas.IA_MESSAGE,
                "click", schemas.SEND_MESSAGE,
                "error", schemas.GET_USERS,
            )
        ]
    )
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", F.try_element_at(topics, F.col("event_type")).alias("topic")
    )
    return ops.route(events)


def punctuation_scores(message: Column) -> Column:
    def count(mark: str) -> Column:
        without = F.replace(message, F.lit(mark), F.lit(""))
        return (F.length(message) - F.length(without)).cast("double")

    return F.array(count("."), count(","))


@query
def classify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.classify_messages(fx.messages(spark, sf_dir), punctuation_scores)
    return df.select("id", "message", "type")


@query
def classify_with_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on all orders with labels by a rule that a bag of words can learn, label them."""
    messages = spread(fx.order_messages(spark, sf_dir))
    urgent = F.col("message").contains("URGENT") | F.col("message").contains("HIGH")
    ruled = F.when(urgent, schemas.MESSAGE_LABELS[0]).otherwise(schemas.MESSAGE_LABELS[1])
    model = ops.train_classifier(messages.withColumn("type", ruled))
    labelled = ops.classify_with_model(messages, model)
    return labelled.select(
        "id",
        F.col("type").isin(*schemas.MESSAGE_LABELS).alias("known_label"),
        (F.col("type") == ruled).alias("agrees_with_rule"),
    )


def _load_mark_counter() -> Callable[[pd.Series], pd.Series]:
    return lambda texts: pd.Series([[float(t.count(".")), float(t.count(","))] for t in texts])


@query
def classify_with_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels as ``classify_messages``, by a vectorised model."""
    scorer = ops.pandas_scorer(_load_mark_counter)
    df = ops.classify_messages(fx.messages(spark, sf_dir), scorer)
    return df.select("id", "message", "type")


# Users.


@query
def users_if_authenticated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.users_if_authenticated(fx.users(spark, sf_dir), fx.credentials(spark, sf_dir))
    return _time_as_text(df, "date_inscription")


@query
def login_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.login_matches(fx.users(spark, sf_dir), fx.credentials(spark, sf_dir))
    return df.select("nom", "email")


@query
def reply_users_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = ops.reply_users(
        fx.users(spark, sf_dir), fx.credentials(spark, sf_dir), max_rows=400, max_bytes=20_000
    )
    return _contract(reply, max_rows=400, max_bytes=20_000)


@query
def users_auth_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.reply_users(fx.users(spark, sf_dir), fx.credentials(spark, sf_dir, word="wrong"))


@query
def register_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.register_unique(
        fx.registrations(spark, sf_dir),
        fx.known_users(spark, sf_dir),
        order_by=["date_inscription", "request"],
    )
    return _time_as_text(df, "date_inscription")


# Whole tables as JSON.


@query
def table_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer")
    return _contract(ops.table_as_json(customers, encoding="object", max_rows=500), max_rows=500)


@query
def table_as_json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = ops.table_as_json(fx.table(spark, sf_dir, "supplier"), encoding="string", max_rows=30)
    return _contract(reply, max_rows=30)


@query
def repeated_rows_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in which few records repeat very often."""
    flags = fx.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    return _contract(ops.table_as_json(flags, encoding="object", max_rows=1000), max_rows=1000)


@query
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_envelope(fx.table(spark, sf_dir, "customer"))


@query
def assign_record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    return assign_id(events, "event_type", "user_id", "event_id")


@query
def decode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers encoded twice by their producer, unwrapped."""
    twice = to_envelope(fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    quoted = twice.select(
        "key",
        F.concat(F.lit('"'), F.replace("value", F.lit('"'), F.lit('\\"')), F.lit('"'))
        .cast("binary")
        .alias("value"),
    )
    return decode_value(quoted, keep_key=True, unwrap=True)


@query
def producer_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local times of a producer without daylight saving, as UTC."""
    local = fx.table(spark, sf_dir, "events").select(
        "event_id", parse_time(format_time(F.col("ts")), "Asia/Tokyo").alias("utc")
    )
    return _time_as_text(local, "utc")


# Ingest.


@query
def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.message_records(spark, sf_dir)
    valid = ops.ingest_json(records, schemas.MESSAGE).valid.drop("processed_time")
    return _time_as_text(valid, "Created_At")


@query
def ingest_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.message_records(spark, sf_dir)
    return ops.ingest_json(records, schemas.MESSAGE).invalid.drop("processed_time")


@query
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ingest_json(fx.message_records(spark, sf_dir), schemas.MESSAGE).stats()


@query
def ingest_aliases_and_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accept both spellings of the time, and insist on it."""
    ingested = ops.ingest_json(
        fx.message_records(spark, sf_dir),
        schemas.MESSAGE,
        required=["Created_At"],
        aliases={"Created_At": ["created_at"]},
        with_id=False,
    )
    return _time_as_text(ingested.valid.drop("processed_time"), "Created_At")


@query
def ingest_keyed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.product_records(spark, sf_dir)
    ingested = ops.ingest_json(records, schemas.PRODUIT, key="produit_id", with_id=False)
    return ingested.valid.drop("processed_time")


@query
def ingest_rejected_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.product_records(spark, sf_dir)
    ingested = ops.ingest_json(records, schemas.PRODUIT, key="produit_id", with_id=False)
    return ingested.invalid.select(
        F.get_json_object("corrupt_record", "$.produit_id").alias("produit_id")
    )


@query
def ingest_keyed_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.purchase_records(spark, sf_dir)
    ingested = ops.ingest_json(records, schemas.ACHAT, key="achat_id", with_id=False)
    return ingested.valid.drop("processed_time")


@query
def ingest_purchases_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.purchase_records(spark, sf_dir)
    return ops.ingest_json(records, schemas.ACHAT, key="achat_id", with_id=False).stats()


@query
def ingest_dated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid users, through a table partitioned by the time they were seen."""
    name, location = _new_table(spark)
    users = ops.ingest_json(
        fx.user_records(spark, sf_dir),
        schemas.RETAIL_USER,
        key="user_id",
        with_id=False,
        processed_time=F.col("timestamp"),
    ).valid
    ensure_table(
        spark,
        name,
        schemas.RETAIL_USER,
        file_format="parquet",
        partition_by=DATE_COLUMNS,
        location=location,
    )
    append_partitioned_by_date(users, name)
    return _time_as_text(read_table(spark, name), "date_inscription")


# Retail.


@query
def enrich_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ops.enrich_purchases(fx.purchases(spark, sf_dir), fx.products(spark, sf_dir))
    details = [F.col(f"produit_details.{c}").alias(c) for c in ("nom", "categorie", "prix")]
    return df.select(*[c for c in df.columns if c != "produit_details"], *details)


@query
def purchase_amount_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.amount_mismatches(fx.purchases(spark, sf_dir), fx.products(spark, sf_dir))


@query
def products_min_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.filter_min_price(fx.products(spark, sf_dir), 950.0)


@query
def branch_on_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.branch_on_match(fx.products(spark, sf_dir), F.col("prix") >= 950.0)


@query
def branch_on_no_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.branch_on_match(
        fx.products(spark, sf_dir), F.col("prix") >= schemas.EXPENSIVE_PRICE
    )


@query
def preview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preview_table(fx.products(spark, sf_dir), ["produit_id"], 10)


# Tables and files.


@query
def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers appended twice, the second time with the columns the other way round."""
    name, location = _new_table(spark)
    customers = fx.table(spark, sf_dir, "customer")
    ensure_table(spark, name, customers.schema, location=location)
    append_table(customers, name)
    append_table(customers.select(*reversed(customers.columns)), name)
    return read_table(spark, name)


@query
def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products, then users in the same table."""
    name, location = _new_table(spark)
    overwrite_table(fx.products(spark, sf_dir), name, location=location)
    people = fx.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nom"),
        F.col("c_mktsegment").alias("prenom"),
        F.col("c_nationkey").cast("int").alias("age"),
        F.col("c_acctbal").alias("ca"),
    )
    overwrite_table(people, name, location=location)
    return read_table(spark, name)


@query
def bucketed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and verdicts bucketed alike on their ids, joined without a shuffle."""
    stored, verdicts = _new_table(spark), _new_table(spark)
    for (name, location), rows, column in (
        (stored, fx.order_messages(spark, sf_dir), "id"),
        (verdicts, fx.line_verdicts(spark, sf_dir), "id_message"),
    ):
        ensure_table(
            spark, name, rows.schema, bucket_by=column, buckets=8, location=location
        )
        append_table(rows.repartition(8, column), name)
    df = ops.messages_with_status(read_table(spark, stored[0]), read_table(spark, verdicts[0]))
    return _time_as_text(df, "Created_At")


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = _new_table(spark)
    rows = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("id"),
        F.col("o_orderpriority").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("load_ts"),
    )
    ensure_table(spark, name, schemas.ROBUST_TEST, file_format="parquet", location=location)
    append_table(rows, name)
    return _time_as_text(read_table(spark, name), "load_ts")


@query
def external_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outlive an external table and are there when it is created again."""
    name, location = _new_table(spark)
    ensure_table(spark, name, schemas.PRODUIT, location=location)
    append_table(fx.products(spark, sf_dir), name)
    spark.sql(f"DROP TABLE {name}")
    ensure_table(spark, name, schemas.PRODUIT, location=location)
    return read_table(spark, name)


@query
def read_json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "json")
    customers = fx.table(spark, sf_dir, "customer")
    customers.write.json(path)
    return read_json_records(spark, path, customers.schema)


@query
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = FileTopics(shared_dir(spark, "topics"))
    topics.publish(to_envelope(fx.table(spark, sf_dir, "supplier")), "suppliers")
    return decode_value(topics.read(spark, "suppliers")).select("topic", "raw_data")


# Streams. Each works off a topic of staged records and ends.


def _staged_messages(spark: SparkSession, sf_dir: str) -> tuple[FileTopics, str]:
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    topics.publish(fx.message_records(spark, sf_dir), schemas.IA_MESSAGE)
    return topics, root


def _ingest_messages(spark: SparkSession, sf_dir: str) -> IngestJob:
    topics, root = _staged_messages(spark, sf_dir)
    name, _ = _new_table(spark)
    job = IngestJob(
        schemas.IA_MESSAGE,
        schemas.MESSAGE,
        table=name,
        error_table=f"{name}_errors",
        save_topic="messages_save",
        buckets=8,
        location=f"{root}/messages",
        error_location=f"{root}/messages_errors",
    )
    start_ingest(spark, topics, job, f"{root}/checkpoint", available_now=True).awaitTermination()
    return job


def _whole(df: DataFrame) -> DataFrame:
    """The stored messages and whether each has an id of its own."""
    alone = F.count("*").over(Window.partitionBy("id")) == 1
    return _time_as_text(df.withColumn("distinct_ids", alone).drop("id"), "Created_At")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _ingest_messages(spark, sf_dir)
    return _whole(read_table(spark, job.table))


@query
def stream_ingest_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the records, each by a run with a checkpoint of its own, one table."""
    root = shared_dir(spark, "stream")
    name, _ = _new_table(spark)
    records = fx.message_records(spark, sf_dir)
    for half in (0, 1):
        topics = FileTopics(f"{root}/topics{half}")
        topics.publish(records.filter(F.col("offset") % 2 == half), schemas.IA_MESSAGE)
        job = IngestJob(
            schemas.IA_MESSAGE,
            schemas.MESSAGE,
            table=name,
            error_table=f"{name}_errors",
            location=f"{root}/messages",
            error_location=f"{root}/messages_errors",
        )
        start_ingest(spark, topics, job, f"{root}/checkpoint{half}", available_now=True).awaitTermination()
    return _whole(read_table(spark, name))


@query
def compacted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in a batch for each market segment, the closed ones made into one."""
    name, location = _new_table(spark)
    customers = fx.table(spark, sf_dir, "customer")
    ensure_table(spark, name, customers.schema, partition_by=BATCH_PARTITIONS, location=location)
    segment = F.array_position(
        F.array(*map(F.lit, ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])), F.col("c_mktsegment")
    )
    for batch_id in range(6):
        write_batch(customers.filter(segment == batch_id), name, batch_id)
    compact_batches(spark, name, "main", 5)
    return read_table(spark, name)


@query
def table_reply_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table with a column whose name starts as the engine's own do."""
    name, location = _new_table(spark)
    nations = fx.table(spark, sf_dir, "nation").withColumnRenamed("n_name", "_n")
    overwrite_table(nations.select("n_nationkey", "_n"), name, location=location)
    request = spark.createDataFrame([("r", "x")], schemas.REPLY)
    return _contract(table_reply(name)(request, "r"), "r")


@query
def stream_messages_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and verdicts through the chat's own jobs; the reply's records."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    messages = _time_as_text(fx.messages(spark, sf_dir), "Created_At")
    topics.publish(to_envelope(messages), schemas.IA_MESSAGE)
    verdicts = _time_as_text(fx.verdicts(spark, sf_dir), "date")
    topics.publish(to_envelope(verdicts), schemas.CHECK_MESSAGE)
    jobs = [
        replace(job, table=f"{name}", error_table=f"{name}_errors", location=f"{root}/{place}", buckets=8)
        for job, name, place in (
            (MESSAGES, _new_table(spark)[0], "messages"),
            (METADATA, _new_table(spark)[0], "metadata"),
        )
    ]
    for job in jobs:
        job = replace(job, error_location=f"{job.location}_errors")
        start_ingest(spark, topics, job, f"{job.location}_checkpoint", available_now=True).awaitTermination()
    request = spark.createDataFrame([("r", "{}")], schemas.REPLY)
    build = messages_reply(jobs[0].table, jobs[1].table, include_id=True, max_rows=300)
    return _contract(build(request, "r"), "r", max_rows=300)


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _ingest_messages(spark, sf_dir)
    return read_table(spark, job.error_table).drop("processed_time")


@query
def stream_responder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins as requests; the reply's records, taken out of its messages."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    name, location = _new_table(spark)
    overwrite_table(fx.users(spark, sf_dir), name, location=location)
    topics.publish(to_envelope(fx.credentials(spark, sf_dir)), schemas.SEND_USERS)
    build = users_reply(name, max_rows=500)
    start_responder(
        spark,
        topics,
        schemas.SEND_USERS,
        schemas.GET_USERS,
        build,
        f"{root}/checkpoint",
        available_now=True,
    ).awaitTermination()
    reply = topics.read(spark, schemas.GET_USERS).select(F.col("value").cast("string").alias("value"))
    user = F.from_json("value", "array<struct<nom:string,email:string>>")
    return reply.filter(F.startswith("value", F.lit("["))).select(F.inline(user))


@query
def stream_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    name, _ = _new_table(spark)
    records = _time_as_text(fx.registrations(spark, sf_dir), "date_inscription")
    topics.publish(to_envelope(records), schemas.REGISTER)
    start_registration(
        spark,
        topics,
        schemas.REGISTER,
        name,
        f"{root}/checkpoint",
        available_now=True,
        location=f"{root}/users",
    ).awaitTermination()
    return _time_as_text(read_table(spark, name), "date_inscription").select(
        "email", "date_inscription"
    )


@query
def stream_registration_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders register their customers in two runs; no e-mail is taken twice."""
    root = shared_dir(spark, "stream")
    name, _ = _new_table(spark)
    records = fx.registrations(spark, sf_dir)
    for half in (0, 1):
        topics = FileTopics(f"{root}/topics{half}")
        part = records.filter(F.col("request") % 2 == half)
        topics.publish(to_envelope(_time_as_text(part, "date_inscription")), schemas.REGISTER)
        start_registration(
            spark,
            topics,
            schemas.REGISTER,
            name,
            f"{root}/checkpoint{half}",
            available_now=True,
            location=f"{root}/users",
            error_location=f"{root}/users_errors",
        ).awaitTermination()
    return read_table(spark, name).groupBy("email").agg(F.count("*").alias("times"))


@query
def stream_registration_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose record lacks the name are kept as they came."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    name, _ = _new_table(spark)
    records = fx.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit("cut {")).otherwise(
            F.concat(F.lit('{"email":"e'), F.col("user_id"), F.lit('"'), F.when(F.col("event_type") == "click", ',"nom":"c"').otherwise(""), F.lit("}"))
        ).alias("value"),
        F.lit(None).cast("string").alias("key"),
    )
    topics.publish(records, schemas.REGISTER)
    start_registration(
        spark, topics, schemas.REGISTER, name, f"{root}/checkpoint",
        available_now=True, location=f"{root}/users", error_location=f"{root}/users_errors",
    ).awaitTermination()
    return read_table(spark, f"{name}_errors").select("corrupt_record")


@query
def stream_classifier_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What isn't a message with a text is kept as it came, and isn't sent on."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    name, _ = _new_table(spark)
    topics.publish(fx.message_records(spark, sf_dir), schemas.SEND_MESSAGE)
    start_classifier(
        spark, topics, lambda df: ops.classify_messages(df, punctuation_scores), f"{root}/checkpoint",
        available_now=True, error_table=name, error_location=f"{root}/errors",
    ).awaitTermination()
    return read_table(spark, name).select("corrupt_record")


@query
def stream_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised messages, labelled on their way from topic to topic."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    sent = normalize_message(spark, sf_dir)
    topics.publish(to_envelope(sent), schemas.SEND_MESSAGE)
    start_classifier(
        spark,
        topics,
        lambda df: ops.classify_messages(df, punctuation_scores),
        f"{root}/checkpoint",
        available_now=True,
    ).awaitTermination()
    labelled = topics.read(spark, schemas.IA_MESSAGE)
    return ops.ingest_json(labelled, schemas.MESSAGE, keep_id=True).valid.select(
        "id", "message", "type"
    )


@query
def stream_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chat: turns are sent, labelled, stored and replied to a request."""
    root, prefix = shared_dir(spark, "chat"), f"chat_{uuid.uuid4().hex}_"
    topics = FileTopics(f"{root}/topics")
    verdicts = _time_as_text(fx.verdicts(spark, sf_dir), "date")
    registrations = _time_as_text(fx.registrations(spark, sf_dir), "date_inscription")
    for rows, topic in (
        (to_envelope(normalize_message(spark, sf_dir)), schemas.SEND_MESSAGE),
        (to_envelope(verdicts), schemas.CHECK_MESSAGE),
        (to_envelope(registrations), schemas.REGISTER),
        (to_envelope(fx.credentials(spark, sf_dir)), schemas.SEND_USERS),
    ):
        topics.publish(rows, topic)

    def run() -> None:
        started = start_chat(
            spark,
            topics,
            f"{root}/checkpoints",
            f"{root}/tables",
            available_now=True,
            buckets=4,
            classify=lambda df: ops.classify_messages(df, punctuation_scores),
            unique_users=True,
            prefix=prefix,
        )
        for each in started:
            each.awaitTermination()

    # Labelled in the first run, stored in the second, asked for in the third.
    topics.publish(spark.createDataFrame([("early", "{}")], schemas.REPLY), schemas.SEND_ALL_MESSAGES)
    topics.publish(spark.createDataFrame([], schemas.REPLY), schemas.IA_MESSAGE)
    run()
    run()
    topics.publish(spark.createDataFrame([("r", "{}")], schemas.REPLY), schemas.SEND_ALL_MESSAGES)
    run()
    reply = decode_value(topics.read(spark, schemas.GET_ALL_MESSAGES), keep_key=True)
    reply = reply.select("key", F.col("raw_data").alias("value")).filter(F.startswith("key", F.lit("r")))
    return _contract(reply, "r")


@query
def compacted_while_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader sees after each step of two compactions."""
    name, location = _new_table(spark)
    customers = fx.table(spark, sf_dir, "customer")
    ensure_table(spark, name, customers.schema, partition_by=BATCH_PARTITIONS, location=location)
    for batch_id in range(6):
        write_batch(customers.filter(F.col("c_nationkey") % 6 == batch_id), name, batch_id)
    seen = None
    for before, drop in ((3, False), (6, True)):
        for step in compaction(spark, name, "main", before, drop=drop):
            now = read_table(spark, name).groupBy("c_mktsegment").agg(
                F.count("*").alias("rows"), F.count_distinct("c_custkey").alias("customers")
            )
            now = store(now.select(F.lit(before).alias("before"), F.lit(step).alias("step"), "*"), "seen")
            seen = now if seen is None else seen.unionByName(now)
    return seen


class _BreakingTopics(FileTopics):
    """Breaks off in the middle of a publication."""

    def publish(self, df: DataFrame, topic: str | None = None) -> None:
        super().publish(df.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == 0), topic)
        raise ConnectionError("broken off")


@query
def publish_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies of a batch whose publication broke off half way, and which is run twice more."""
    topics, root = _staged_messages(spark, sf_dir)
    name, _ = _new_table(spark)
    job = IngestJob(
        schemas.IA_MESSAGE,
        schemas.MESSAGE,
        table=name,
        error_table=f"{name}_errors",
        save_topic="messages_save",
        location=f"{root}/messages",
        error_location=f"{root}/messages_errors",
    )
    batch = topics.read(spark, schemas.IA_MESSAGE)
    for place in (_BreakingTopics(topics.root), topics, topics):
        try:
            ingest_batch(batch, 0, job, place, "run", Outbox(spark, place, f"{root}/outbox"))
        except ConnectionError:
            continue
    value = F.from_json(F.col("value").cast("string"), schemas.stored(schemas.MESSAGE))
    return _whole(topics.read(spark, "messages_save").select(value.alias("v")).select("v.*"))


@query
def stream_responder_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins under the customers' own keys, right and wrong ones in one batch; each one's answer."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    name, location = _new_table(spark)
    overwrite_table(fx.users(spark, sf_dir), name, location=location)
    topics.publish(to_envelope(fx.credentials(spark, sf_dir), F.col("email")), schemas.SEND_USERS)
    start_responder(
        spark, topics, schemas.SEND_USERS, schemas.GET_USERS, users_reply(name), f"{root}/checkpoint", available_now=True
    ).awaitTermination()
    answers = decode_value(topics.read(spark, schemas.GET_USERS), keep_key=True)
    points = F.get_json_object("raw_data", "$.reply").isNotNull()
    return answers.filter(F.startswith("key", F.lit("customer."))).select(
        "key", F.when(points, "users").otherwise(F.col("raw_data")).alias("answer")
    )


@query
def stream_registration_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders register their customers in two batches, next to a table of known ones."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    (name, _), (known, known_location) = _new_table(spark), _new_table(spark)
    overwrite_table(fx.known_users(spark, sf_dir), known, location=known_location)
    records = fx.registrations(spark, sf_dir)
    for half in (0, 1):
        part = records.filter(F.col("request") % 2 == half)
        topics.publish(to_envelope(_time_as_text(part, "date_inscription")), schemas.REGISTER)
        start_stateful_registration(
            spark,
            topics,
            schemas.REGISTER,
            name,
            f"{root}/checkpoint",
            known=[known] if half == 0 else [],
            available_now=True,
            location=f"{root}/users",
            error_location=f"{root}/users_errors",
        ).awaitTermination()
    return _time_as_text(read_table(spark, name), "date_inscription").select("email", "date_inscription")


@query
def stream_kept_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some verdicts, then the messages, then the other verdicts, each in a batch of its own."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    messages = to_envelope(_time_as_text(fx.order_messages(spark, sf_dir), "Created_At"))
    verdicts = _time_as_text(fx.line_verdicts(spark, sf_dir), "date")
    early = F.pmod(F.xxhash64("id_message", "date", "valide"), F.lit(3)) == 0
    kept = ops.KeptStatus(spark, f"{root}/status", buckets=16)
    topics.publish(spark.createDataFrame([], schemas.REPLY), schemas.IA_MESSAGE)
    for rows, topic in (
        (to_envelope(verdicts.filter(early)), schemas.CHECK_MESSAGE),
        (messages, schemas.IA_MESSAGE),
        (to_envelope(verdicts.filter(~early)), schemas.CHECK_MESSAGE),
    ):
        topics.publish(rows, topic)
        start_status(spark, topics, kept, f"{root}/checkpoint", available_now=True).awaitTermination()
    return ops.kept_status_counts(kept.read()).select("message_id", "valide", "copies")


@query
def stream_classifier_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running job's labels before and after another model has been promoted."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    messages = spread(fx.order_messages(spark, sf_dir))
    urgent = F.col("message").contains("URGENT") | F.col("message").contains("HIGH")
    bad, good = schemas.MESSAGE_LABELS
    models = ops.ModelStore(spark, f"{root}/models")
    sent = to_envelope(_time_as_text(messages, "Created_At"))
    parity = F.get_json_object("value", "$.id").cast("long") % 2
    topics.publish(sent.limit(0), schemas.SEND_MESSAGE)
    models.train(messages.withColumn("type", F.when(urgent, bad).otherwise(good)))
    running = start_classifier(spark, topics, models.classify, f"{root}/checkpoint", error_table=_new_table(spark)[0])
    try:
        topics.publish(sent.filter(parity == 0), schemas.SEND_MESSAGE)
        running.processAllAvailable()
        models.train(messages.withColumn("type", F.when(urgent, good).otherwise(bad)))
        topics.publish(sent.filter(parity == 1), schemas.SEND_MESSAGE)
        running.processAllAvailable()
    finally:
        running.stop()
    labelled = ops.ingest_json(topics.read(spark, schemas.IA_MESSAGE), schemas.MESSAGE, keep_id=True).valid
    return labelled.select("id", urgent.alias("urgent"), "type")


@query
def stream_router_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events routed by a table that changes twice while the router runs, counted by reader."""
    root = shared_dir(spark, "stream")
    topics = FileTopics(f"{root}/topics")
    events = to_envelope(fx.table(spark, sf_dir, "events").select("event_id"))
    third = F.get_json_object("value", "$.event_id").cast("long") % 3
    routes = RouteTable(spark, f"{root}/routes", {schemas.CHECK_MESSAGE: ["spark"]})
    left: list[dict[str, int]] = []
    topics.publish(events.limit(0), schemas.CHECK_MESSAGE)
    running = start_router(
        spark, topics, schemas.CHECK_MESSAGE, f"{root}/checkpoint", routes, counted=left.append
    )
    try:
        for part, readers in enumerate((["spark"], ["spark", "backend"], None)):
            routes.change({schemas.CHECK_MESSAGE: readers})
            topics.publish(events.filter(third == part), schemas.CHECK_MESSAGE)
            running.processAllAvailable()
    finally:
        running.stop()
    unrouted = spark.createDataFrame([(sum(n["unrouted"] for n in left),)], "records long")
    counts = unrouted.select(F.lit("nobody").alias("reader"), "records")
    for reader in ("spark", "backend"):
        read = topics.read(spark, reader).agg(F.count("*").alias("records"))
        counts = counts.unionByName(read.select(F.lit(reader).alias("reader"), "records"))
    return counts
