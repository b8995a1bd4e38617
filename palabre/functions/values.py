"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from palabre.schemas import TIME_FORMAT


def amount(price: Column, quantity: Column) -> Column:
    """Price times quantity, rounded to cents."""
    return F.round(price * quantity, 2)


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def parse_time(text: Column, source_tz: str = "UTC") -> Column:
    """A producer's local time text as an instant; NULL if it is not a time."""
    local = F.try_to_timestamp(text, F.lit(TIME_FORMAT))
    return F.to_utc_timestamp(local, source_tz)


def date_parts(ts: Column) -> list[Column]:
    """The ``year``, ``month`` and ``day`` columns of a date-partitioned table."""
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day")]


def label_of(scores: Column, labels: Sequence[str]) -> Column:
    """The label with the highest score; the first one on a tie."""
    names = F.array(*[F.lit(label) for label in labels])
    return F.try_element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def bucket_of(text: Column, buckets: Column) -> Column:
    """A bucket number in ``[0, buckets)`` that depends on the text alone (60 bits of it)."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % buckets
