"""Decoding and encoding of topic records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unwrap_json(raw: Column) -> Column:
    """Undo one level of JSON encoding where the record is a JSON string literal."""
    return F.when(F.ltrim(raw).startswith('"'), F.get_json_object(raw, "$")).otherwise(raw)


def decode_value(df: DataFrame, keep_key: bool = False, unwrap: bool = False) -> DataFrame:
    """Replace the binary value of a topic record by its text ``raw_data``.

    The position columns stay, the key only if asked for (as text). ``unwrap``
    accepts records that a producer encoded twice.
    """
    raw = F.col("value").cast("string")
    kept = [F.col(c) for c in df.columns if c not in ("key", "value")]
    key = [F.col("key").cast("string").alias("key")] if keep_key else []
    return df.select(*key, (unwrap_json(raw) if unwrap else raw).alias("raw_data"), *kept)


def mark_corrupt(required: Sequence[str], raw: str = "raw_data") -> Column:
    """The raw text of a record that lacks one of the required fields, else NULL."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"`{name}`").isNull()
    return F.when(missing, F.col(raw))


def to_envelope(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Each row as a topic message: a key (NULL by default) and the row as JSON text.

    NULL fields are left out of the JSON object.
    """
    message_key = F.lit(None) if key is None else key
    return df.select(
        message_key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
