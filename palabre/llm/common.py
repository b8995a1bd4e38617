"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.session import shared_dir

#: Rows of whole texts that are in a Python worker at once.
BATCH_ROWS = 256


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small, so that long texts fit in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    This cuts the lineage: what was written survives lost executors, is made once
    however often it is used, and has a size that Spark knows when it plans joins.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_texts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the id and the text as ``doc_id`` and ``text``; a missing text is empty."""
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


class MaybeIn:
    """Tells values that are surely not in a set from those that may be, by a bitmap."""

    def __init__(self, shared, bits: int) -> None:
        self._shared, self._bits = shared, bits

    def __call__(self, values: np.ndarray) -> np.ndarray:
        """For a worker: which of the 64-bit values may be in the set."""
        at = values & (self._bits - 1)
        return (self._shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def column(self, value: Column) -> Column:
        """The same for a column."""

        @F.pandas_udf("boolean")
        def maybe(values: pd.Series) -> pd.Series:
            return pd.Series(self(values.to_numpy(np.int64)))

        return maybe(value)


def maybe_in(stored: DataFrame, value: Column | str, most_bits: int = 1 << 25, bits_each: int = 16) -> MaybeIn:
    """A bitmap of the well-mixed 64-bit ``value`` of all rows, of a fixed size at most.

    With more rows than it can tell apart it only holds fewer values off.
    """
    spark = stored.sparkSession
    bits = int(min(most_bits, 1 << max(12, (bits_each * stored.count()).bit_length())))
    place = F.pmod(F.col(value) if isinstance(value, str) else value, F.lit(bits))
    words = (
        stored.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
        .toArrow()  # at most one row for 64 bits
    )
    bitmap = np.zeros(bits // 64, dtype=np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return MaybeIn(spark.sparkContext.broadcast(bitmap.view(np.uint64)), bits)


def only_ids(docs: DataFrame, ids: DataFrame, most_bits: int = 1 << 25) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is in the stored, distinct ``ids``.

    A bitmap of hashed ids drops most other rows before the join that decides.
    """
    mixed = F.xxhash64("doc_id")
    likely = docs.filter(maybe_in(ids, mixed, most_bits).column(mixed))
    return likely.join(ids, "doc_id", "left_semi")


def keep_ids(docs: DataFrame, ids: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows whose id is in ``ids``, repeated ones (same id and text) once.

    Rows without an id all stay.
    """
    named = docs.filter(F.col(f"`{id_column}`").isNotNull())
    wanted = ids.select(F.col("doc_id").alias(id_column))
    kept = named.join(wanted, id_column, "left_semi").dropDuplicates([id_column, "text"])
    return kept.unionByName(docs.filter(F.col(f"`{id_column}`").isNull()))
