"""Chat messages: moderation status, normalisation and routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palabre.functions.ids import record_id
from palabre.functions.values import format_time
from palabre.operators.joins import left_join
from palabre.schemas import DEFAULT_VERDICT, MESSAGE, ROUTES

# Rows that one row may turn into within a task.
MANY_VERDICTS = 100_000


def _message_columns(messages: DataFrame) -> list[Column]:
    return [F.col("id").alias("message_id"), *[F.col(f"`{c}`") for c in MESSAGE.names]]


def _counted(messages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Messages that have an id, with the number of each kind of verdict in ``copies``."""
    verdicts = (
        metadata.filter(F.col("id_message").isNotNull())
        .groupBy("id_message", F.col("valide").cast("string").alias("valide"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    named = messages.filter(F.col("id").isNotNull()).select(*_message_columns(messages))
    joined = named.join(verdicts, F.col("message_id") == F.col("id_message"), "left")
    return joined.select(
        *named.columns,
        F.coalesce("valide", F.lit(DEFAULT_VERDICT)).alias("valide"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )


def _nameless(messages: DataFrame) -> DataFrame:
    """Messages without an id: they have no verdict and need no shuffle."""
    return messages.filter(F.col("id").isNull()).select(
        *_message_columns(messages), F.lit(DEFAULT_VERDICT).alias("valide")
    )


def status_counts(messages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every message and verdict, equal ones counted in ``copies``.

    Verdicts are counted per message before the join, on the map side, so a
    message with very many of them is one row per kind of verdict.
    """
    one = F.lit(1).cast("long").alias("copies")
    return _counted(messages, metadata).unionByName(_nameless(messages).select("*", one))


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    numbered = df.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_n"))
    return numbered.drop("_n")


def messages_with_status(
    messages: DataFrame,
    metadata: DataFrame,
    latest_only: bool = False,
    many: int = MANY_VERDICTS,
) -> DataFrame:
    """Every message with each of its moderation verdicts, ``'false'`` if it has none.

    A message with several verdicts gives several rows; ``latest_only`` keeps the
    newest one. Equal rows are joined once and repeated afterwards; those of a
    message with more than ``many`` equal verdicts are written by several tasks.
    """
    if latest_only:
        newest = (
            metadata.filter(F.col("id_message").isNotNull())
            .groupBy("id_message")
            .agg(F.max(F.struct("date", "valide")).alias("last"))
            .select("id_message", F.col("last.valide").cast("string").alias("valide"))
        )
        named = messages.filter(F.col("id").isNotNull())
        joined = named.join(newest, F.col("id") == F.col("id_message"), "left")
        judged = joined.select(
            *_message_columns(messages),
            F.coalesce("valide", F.lit(DEFAULT_VERDICT)).alias("valide"),
        )
        return judged.unionByName(_nameless(messages))

    counted = _counted(messages, metadata)
    copies = F.col("copies")
    few = _repeat(counted.filter(copies <= many), copies).drop("copies")
    last_part = F.expr(f"(copies - 1) div {many}")
    parts = (
        counted.filter(copies > many)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), last_part)).alias("_part"))
        .repartition("message_id", "_part")
    )
    in_part = F.least(F.lit(many), copies - F.col("_part") * many)
    spread = _repeat(parts, in_part).drop("copies", "_part")
    return few.unionByName(spread).unionByName(_nameless(messages))


def messages_left_join(
    messages: DataFrame, metadata: DataFrame, prefix: str = "metadata_"
) -> DataFrame:
    """All columns of both tables, NULLs where a message has no verdict.

    The metadata columns get a prefix, so no name occurs twice.
    """
    right = metadata.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in metadata.columns])
    return left_join(messages, right, "id", f"{prefix}id_message")


def normalize_message(
    df: DataFrame, id_columns: Sequence[str], now: Column | None = None
) -> DataFrame:
    """A message as the gateway sends it on.

    Missing texts become ``''``; type and chat are not known yet (``''`` and
    ``'0'``); the time is stamped. The id is a digest of ``id_columns``.
    """

    def text(name: str) -> Column:
        value = F.col(name).cast("string") if name in df.columns else F.lit(None)
        return F.coalesce(value, F.lit("")).alias(name)

    stamp = F.current_timestamp() if now is None else now
    return df.select(
        record_id(*id_columns).alias("id"),
        text("user_id"),
        text("message"),
        F.lit("").alias("type"),
        F.lit("0").alias("chat_id"),
        format_time(stamp).alias("Created_At"),
    )


def route(
    df: DataFrame,
    routes: Mapping[str, Sequence[str]] | None = None,
    topic: str = "topic",
    target: str = "destination",
) -> DataFrame:
    """One row per record and reader of its topic; ``target`` is NULL if it has none.

    The routing table is a literal of the plan, so nothing is joined or shuffled.
    """
    table = routes or ROUTES
    entries = [
        item
        for name, readers in table.items()
        for item in (F.lit(name), F.array(*[F.lit(reader) for reader in readers]))
    ]
    readers = F.try_element_at(F.create_map(*entries), F.col(topic))
    return df.select("*", F.explode_outer(readers).alias(target))
