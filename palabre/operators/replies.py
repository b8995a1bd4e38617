"""Results as JSON reply messages of bounded size."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palabre.functions.values import bucket_of
from palabre.operators.accounts import login_matches, visible_columns
from palabre.operators.messages import status_counts
from palabre.schemas import EMPTY_REPLY, MESSAGE_WITH_STATUS, USER_NOT_FOUND
from palabre.session import store

MAX_ROWS = 10_000
MAX_BYTES = 900_000
#: Bytes of records that a task makes messages of.
TASK_BYTES = 32_000_000


def _one_message(rows: DataFrame, key: str | None, value: str) -> DataFrame:
    one = rows.sparkSession.range(0, 1, 1, 1)
    return one.select(F.lit(key).cast("string").alias("key"), F.lit(value).alias("value"))


def _between(first: Column, last: Column, of: Callable[[Column], Column]) -> Column:
    """What ``of`` gives for each number from ``first`` to ``last``; nothing if that is smaller."""
    none = F.array().cast("array<bigint>")
    return F.when(last >= first, F.transform(F.sequence(first, last), of)).otherwise(none)


def json_reply(
    rows: DataFrame,
    copies: str | None = None,
    columns: Sequence[str] | None = None,
    encoding: str = "object",
    request_key: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    empty: str | None = EMPTY_REPLY,
) -> DataFrame:
    """Rows as ``(key, value)`` messages, each a JSON array of records.

    A result that fits is one message with the request's key. A larger one is several,
    of at most ``max_rows`` records and ``max_bytes`` bytes (one longer record is a message by
    itself). Their keys add the message's place to the request's key, and a closing
    message ``<key>/parts`` holds ``{"parts": n}``, so a client knows when it has all.
    ``encoding='string'`` makes the elements JSON texts instead of objects.

    Equal records are counted before the shuffle and their copies dealt out, by a digest
    of the record and the copy's number, to buckets of about ``max_rows``; each bucket is
    numbered and cut on its own, in tasks of about ``TASK_BYTES``. Copies are a number until
    their message is written. ``copies`` names a column that already holds counts.
    Counted records and cut messages are stored in the shared folder on the way, so ``rows``
    are made once, when this is called. The cut depends on the data only.
    """
    if encoding not in ("object", "string"):
        raise ValueError(f"encoding must be 'object' or 'string', not {encoding!r}")
    shown = list(columns) if columns else [c for c in rows.columns if c != copies]
    count = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in shown]))
    equal = (
        rows.select(record.alias("record"), count.alias("copies"))
        .groupBy("record")
        .agg(F.sum("copies").alias("copies"))
    )
    records = store(equal, "records")
    sizes = records.agg(
        F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.octet_length("record")).alias("bytes")
    ).first()
    total = sizes["copies"] or 0
    if not total:
        nothing = _one_message(rows, request_key, empty or "")
        return nothing if empty is not None else nothing.limit(0)
    n_buckets = -(-total // max_rows)

    # A record with more copies than fit one message goes to several buckets.
    last_piece = F.expr(f"(copies - 1) div {max_rows}")
    pieces = records.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)))
    place_name = F.concat_ws(":", "record", "piece")
    placed = pieces.withColumn("bucket", bucket_of(place_name, F.lit(n_buckets)))
    # As many tasks as the messages' bytes need: rows with many copies are few until they are written.
    placed = placed.repartition(min(n_buckets, -(-sizes["bytes"] // TASK_BYTES)), "bucket")
    in_piece = F.least(F.lit(max_rows), F.col("copies") - F.col("piece") * max_rows)
    if encoding == "object":
        element = F.col("record")
    else:
        listed = F.to_json(F.array("record"))
        element = F.substr(listed, F.lit(2), F.length(listed) - 2)
    # The copies of a piece stay one row, from here on with the number of rows and bytes before it.
    # Elements that start within the same half of a message's bytes, and are no longer than
    # that, fit in one; longer ones are messages of their own.
    half = max(1, (max_bytes - 2) // 2)
    order = Window.partitionBy("bucket").orderBy("element")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = placed.select("bucket", element.alias("element"), in_piece.alias("n"))
    size = F.octet_length("element") + 1
    runs = runs.withColumn("long", size > half)
    runs = runs.withColumn("own", F.when(F.col("long"), 0).otherwise(size).cast("long"))
    numbered = runs.withColumns(
        {
            "row": F.sum("n").over(upto) - F.col("n"),
            "start": F.sum(F.col("n") * F.col("own")).over(upto) - F.col("n") * F.col("own"),
        }
    )
    # The copies that begin another message, by rows or by bytes.
    by_rows = _between(
        F.expr(f"row div {max_rows} + 1"),
        F.expr(f"(row + n - 1) div {max_rows}"),
        lambda k: k * max_rows - F.col("row"),
    )
    by_bytes = _between(
        F.expr(f"start div {half} + 1"),
        F.expr(f"(start + (n - 1) * own) div {half}"),
        lambda k: F.call_function("div", k * half - F.col("start") + F.col("own") - 1, F.col("own")),
    )
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), by_rows, by_bytes)))
    each = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    begins = numbered.withColumn("begins", F.when(F.col("long"), each).otherwise(cuts))
    within = F.transform(
        "begins",
        lambda at, i: F.struct(at.alias("at"), (F.coalesce(F.get("begins", i + 1), F.col("n")) - at).alias("times")),
    )
    split = begins.select("bucket", "element", "long", "own", "row", "start", F.inline(within))
    cut = split.select(
        "bucket",
        (F.col("row") + F.col("at") + 1).alias("row"),
        "element",
        F.col("times").cast("int").alias("times"),
        F.when(F.col("long"), F.expr("row + at + 1")).otherwise(F.expr(f"(row + at) div {max_rows}")).alias("row_cut"),
        F.when(F.col("long"), F.lit("l"))
        .otherwise(F.expr(f"cast((start + at * own) div {half} as string)"))
        .alias("byte_cut"),
    )
    messages = cut.groupBy("bucket", "row_cut", "byte_cut").agg(
        F.array_sort(F.collect_list(F.struct("row", "element", "times"))).alias("rows")
    )
    texts = F.transform("rows", lambda item: F.array_join(F.array_repeat(item["element"], item["times"]), ","))
    value = F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    place = F.concat_ws("-", "bucket", "row_cut", "byte_cut")
    stored = store(messages.select(place.alias("place"), value.alias("value")), "messages")
    parts = stored.count()
    request = F.lit(request_key).cast("string")
    if parts == 1:
        return stored.select(request.alias("key"), "value")
    reply = stored.select(F.concat_ws("/", request, "place").alias("key"), "value")
    closing = "parts" if request_key is None else f"{request_key}/parts"
    return reply.unionByName(_one_message(rows, closing, json.dumps({"parts": parts}, separators=(",", ":"))))


def reply_messages(
    messages: DataFrame,
    metadata: DataFrame,
    include_id: bool = False,
    request_key: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """All messages with their status as JSON messages, ``[]`` if there are none."""
    columns = (["message_id"] if include_id else []) + MESSAGE_WITH_STATUS.names
    return json_reply(
        status_counts(messages, metadata),
        copies="copies",
        columns=columns,
        request_key=request_key,
        max_rows=max_rows,
        max_bytes=max_bytes,
    )


def reply_users(
    users: DataFrame,
    credentials: DataFrame,
    columns: Sequence[str] | None = None,
    request_key: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """All users as JSON messages if any credential is right, else an error object."""
    if login_matches(users, credentials).isEmpty():
        return _one_message(users, request_key, USER_NOT_FOUND)
    return reply_all_users(users, columns, request_key, max_rows, max_bytes)


def reply_all_users(
    users: DataFrame,
    columns: Sequence[str] | None = None,
    request_key: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """All users as JSON messages, for requesters that are known to be right."""
    return json_reply(
        users,
        columns=visible_columns(users, columns),
        request_key=request_key,
        max_rows=max_rows,
        max_bytes=max_bytes,
    )


def table_as_json(
    df: DataFrame,
    encoding: str = "string",
    request_key: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Any table as JSON messages, ``[]`` if it has no rows."""
    return json_reply(
        df,
        encoding=encoding,
        request_key=request_key,
        max_rows=max_rows,
        max_bytes=max_bytes,
    )
