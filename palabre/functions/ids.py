"""Row ids that stay the same when a batch is replayed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITION = ("topic", "partition", "offset")


def record_id(*columns: str) -> Column:
    """Hex digest of the columns that name a record, by default its topic position."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns or POSITION]))


def assign_id(df: DataFrame, *columns: str, name: str = "id", random: bool = False) -> DataFrame:
    """Put an id column in front.

    The default id is a digest of ``columns`` (the topic position when none are
    given), so every action and every replay sees the same id. ``random`` gives
    a UUID instead.
    """
    value = F.uuid() if random else record_id(*columns)
    return df.select(value.alias(name), *[F.col(c) for c in df.columns if c != name])
