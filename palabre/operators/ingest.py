"""Validated ingest of JSON records: parse, name, and split good from bad."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palabre.functions.ids import POSITION, record_id
from palabre.functions.records import decode_value, mark_corrupt


@dataclass(frozen=True)
class Ingested:
    """Parsed records and the views of them.

    ``parsed`` has ``id`` (if asked for), the schema's columns, ``raw_data``,
    ``corrupt_record`` and ``processed_time``.
    """

    parsed: DataFrame
    schema: StructType
    with_id: bool

    @property
    def columns(self) -> list[str]:
        return (["id"] if self.with_id else []) + self.schema.names

    @property
    def is_valid(self) -> Column:
        return F.col("raw_data").isNotNull() & F.col("corrupt_record").isNull()

    @property
    def is_invalid(self) -> Column:
        return F.col("corrupt_record").isNotNull()

    @property
    def valid(self) -> DataFrame:
        """Records that have every required field."""
        names = [F.col(f"`{c}`") for c in [*self.columns, "processed_time"]]
        return self.parsed.filter(self.is_valid).select(*names)

    @property
    def invalid(self) -> DataFrame:
        """The raw text of the other records."""
        return self.parsed.filter(self.is_invalid).select("corrupt_record", "processed_time")

    def counts(self) -> list[Column]:
        """Aggregates for the numbers of valid, invalid, empty and all records."""
        return [
            F.count_if(self.is_valid).alias("valid"),
            F.count_if(self.is_invalid).alias("invalid"),
            F.count_if(F.col("raw_data").isNull()).alias("tombstones"),
            F.count(F.lit(1)).alias("total"),
        ]

    def stats(self) -> DataFrame:
        """Those numbers in one row, from one pass."""
        return self.parsed.agg(*self.counts())


def ingest_json(
    df: DataFrame,
    schema: StructType,
    key: str | None = None,
    required: Sequence[str] = (),
    aliases: Mapping[str, Sequence[str]] | None = None,
    unwrap: bool = False,
    with_id: bool = True,
    keep_id: bool = False,
    id_columns: Sequence[str] = POSITION,
    processed_time: Column | None = None,
    keep: Sequence[str] = (),
) -> Ingested:
    """Parse topic records (or a frame with ``raw_data``) against a schema.

    A record is valid when ``key`` (by default the schema's first field) and all
    ``required`` fields are there. A record without a value is neither valid nor
    invalid: it is counted and left out. ``aliases`` gives other spellings of a
    field's name, tried when the field is missing. The id is a digest of
    ``id_columns``; with ``keep_id`` a record's own ``id`` comes first. ``keep`` names
    further columns of ``df`` that stay in ``parsed``.
    """
    records = df if "raw_data" in df.columns else decode_value(df, unwrap=unwrap)
    seen = F.current_timestamp() if processed_time is None else processed_time
    # All spellings are in one schema, so that a record is parsed once.
    # Names that differ in case only are told apart by their place.
    wire, places = StructType([*schema.fields]), {n: [n] for n in schema.names}
    for name in schema.names:
        for other in (aliases or {}).get(name, ()):
            wire = wire.add(other, schema[name].dataType)
            places[name].append(f"_spelling_{len(wire)}")
    names = [*schema.names, *[p for own in places.values() for p in own[1:]]]
    if keep_id and "id" not in wire.names:
        wire, names = wire.add("id", "string"), [*names, "id"]
    derived = [record_id(*id_columns).alias("_derived_id")] if with_id else []
    # inline() parses each record once: filters on its output are not pushed below it.
    rows = records.select(
        *derived,
        *[F.col(f"`{c}`") for c in keep],
        "raw_data",
        seen.alias("processed_time"),
        F.inline(F.array(F.from_json("raw_data", wire, {"mode": "PERMISSIVE"}))),
    )
    own_names = [*(["_derived_id"] if with_id else []), *keep, "raw_data", "processed_time"]
    rows = rows.toDF(*own_names, *names)

    def column(name: str) -> Column:
        return F.coalesce(*[F.col(f"`{p}`") for p in places[name]]).alias(name)

    own_id = F.col("id") if keep_id or "id" in schema.names else F.lit(None)
    id_column = [F.coalesce(own_id, F.col("_derived_id")).alias("id")] if with_id else []
    fields = rows.select(
        *id_column,
        *[column(name) for name in schema.names],
        *[F.col(f"`{c}`") for c in keep],
        "raw_data",
        "processed_time",
    )
    needed = dict.fromkeys([key or schema.names[0], *required])
    parsed = fields.withColumn("corrupt_record", mark_corrupt(list(needed)))
    return Ingested(parsed, schema, with_id)
