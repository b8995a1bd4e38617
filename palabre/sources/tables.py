"""Catalog tables: definition, appends, overwrites and replay-safe batch writes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palabre.functions.values import date_parts
from palabre.schemas import QUARANTINE
from palabre.sources.manifests import Manifest, delete_folder

#: Name the micro-batch that wrote a row: the run it belongs to and its number in it.
RUN_COLUMN = "_batch_run"
BATCH_COLUMN = "_batch_id"
BATCH_PARTITIONS = {RUN_COLUMN: "STRING", BATCH_COLUMN: "BIGINT"}
DATE_COLUMNS = {"year": "INT", "month": "INT", "day": "INT"}


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    file_format: str = "orc",
    bucket_by: str | None = None,
    buckets: int | None = None,
    partition_by: dict[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Create the table if it is missing.

    ``partition_by`` maps further columns to their SQL types. A ``location``
    makes the table external. With ``buckets``, chosen for the size the table will
    reach, it is bucketed by ``bucket_by``; two tables bucketed alike on their join key
    join without a shuffle.
    """
    partitions = partition_by or {}
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    columns += [f"`{name}` {kind}" for name, kind in partitions.items()]
    ddl = [f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING {file_format}"]
    if partitions:
        ddl.append(f"PARTITIONED BY ({', '.join(f'`{name}`' for name in partitions)})")
    if bucket_by and buckets:
        ddl.append(f"CLUSTERED BY (`{bucket_by}`) INTO {buckets} BUCKETS")
    if location:
        ddl.append(f"LOCATION '{location}'")
    spark.sql(" ".join(ddl))


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def _snapshot(spark: SparkSession, table: str) -> Manifest:
    """What of the table's batches is hidden; its folder's name keeps it out of the table's own files."""
    return Manifest(spark, f"{table_location(spark, table)}/_snapshot")


#: Above every batch number: hides all of a run.
_ALL = (1 << 63) - 1


def visible_rows(spark: SparkSession, table: str) -> DataFrame:
    """All columns of the table's valid rows: those that no snapshot hides.

    A snapshot names runs and the batch below which they are hidden, because their rows
    are in another partition or not yet all there. It is replaced in one step.
    """
    df = spark.read.table(table)
    if RUN_COLUMN not in df.columns:
        return df
    for run, below in _snapshot(spark, table).read()[1].items():
        df = df.filter(~((F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) < below)))
    return df


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table's own columns; the two that only serve replay are left out."""
    df = visible_rows(spark, table)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in BATCH_PARTITIONS])


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """The frame's columns in the table's order, matched by name."""
    columns = df.sparkSession.read.table(table).columns
    return df.select(*[F.col(f"`{c}`") for c in columns])


def append_table(df: DataFrame, table: str) -> None:
    """Append rows; columns are matched by name and others are left out."""
    _aligned(df, table).write.insertInto(table)


def overwrite_table(
    df: DataFrame, table: str, file_format: str = "orc", location: str | None = None
) -> None:
    """Replace the table by the frame."""
    writer = df.write.format(file_format).mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def quarantine(
    invalid: DataFrame,
    table: str,
    batch_id: int | None = None,
    location: str | None = None,
    run: str = "main",
) -> None:
    """Keep rejected records with the time they were seen."""
    partitions = None if batch_id is None else BATCH_PARTITIONS
    ensure_table(
        invalid.sparkSession, table, QUARANTINE, partition_by=partitions, location=location
    )
    rows = invalid.select(*QUARANTINE.names)
    if batch_id is None:
        append_table(rows, table)
    else:
        write_batch(rows, table, batch_id, run=run)


def append_partitioned_by_date(
    df: DataFrame, table: str, time_column: str = "processed_time"
) -> None:
    """Append rows to the ``year/month/day`` partitions of ``time_column``.

    Rows of a day are brought together, and a large day split, so that the number
    of files follows the size of the data.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in DATE_COLUMNS]
    dated = df.select(*kept, *date_parts(F.col(time_column)))
    append_table(dated.hint("rebalance", *[F.col(c) for c in DATE_COLUMNS]), table)


def write_batch(
    df: DataFrame,
    table: str,
    batch_id: int,
    cluster_by: str | None = None,
    run: str = "main",
) -> None:
    """Write a micro-batch so that a replay replaces it instead of adding to it.

    The batch owns the partition of its run and number, which must be the first
    partition columns. Batches of other runs (another job, or a job that began anew)
    have numbers of their own and stay. For a table bucketed by ``cluster_by`` rows are
    brought together first, in tasks sized by adaptive execution, so that not
    every task writes a file per bucket.
    """
    _insert(df, table, batch_id, cluster_by, run, "OVERWRITE")


def _insert(df: DataFrame, table: str, batch_id: int, cluster_by: str | None, run: str, how: str) -> None:
    spark = df.sparkSession
    columns = spark.read.table(table).columns
    dynamic = columns[columns.index(BATCH_COLUMN) + 1 :]
    rows = df.select(*[F.col(f"`{c}`") for c in columns if c not in BATCH_PARTITIONS])
    if cluster_by:
        rows = rows.repartition(cluster_by)
    owned = [f"`{RUN_COLUMN}` = '{run}'", f"`{BATCH_COLUMN}` = {int(batch_id)}"]
    partition = ", ".join([*owned, *[f"`{c}`" for c in dynamic]])
    spark.sql(f"INSERT {how} TABLE {table} PARTITION ({partition}) SELECT * FROM {{rows}}", rows=rows)


def compaction(
    spark: SparkSession, table: str, run: str, before: int, cluster_by: str | None = None, drop: bool = True
) -> Iterator[str]:
    """``compact_batches`` as its steps, each done when its name comes.

    Whatever step it breaks off after, readers see each row once; the next compaction drops
    what this one left behind.
    """
    spark.catalog.refreshTable(table)
    snapshot = _snapshot(spark, table)
    version, hidden = snapshot.read()
    made = f"{run}.compacted."
    family = (F.col(RUN_COLUMN) == run) | F.startswith(RUN_COLUMN, F.lit(made))
    whole = spark.read.table(table)
    parts = whole.filter(family).select(RUN_COLUMN, BATCH_COLUMN).distinct().collect()  # a row for each partition
    gone = [(r, b) for r, b in parts if b < hidden.get(r, -1)]
    for name, batch in gone:
        _drop_batch(spark, table, name, batch)
    yield "leftovers dropped"
    closed = sorted((b, r) for r, b in parts if b < before and (r, b) not in set(map(tuple, gone)))
    if len(closed) < 2:
        return
    # Runs that this and earlier compactions made and that are dropped need no entry any more.
    hidden = {r: b for r, b in hidden.items() if not r.startswith(made) or (r, b) in closed}
    target, last = f"{made}{uuid.uuid4().hex[:12]}", closed[-1][0]
    version = snapshot.replace({**hidden, target: _ALL}, version)
    yield "target hidden"
    of_closed = family & (F.col(BATCH_COLUMN) < before)
    rows = visible_rows(spark, table).filter(of_closed)
    _insert(rows, table, last, cluster_by, target, "INTO")
    yield "rows copied"
    earlier = {r: _ALL for _, r in closed if r != run}
    snapshot.replace({**hidden, **earlier, run: before}, version)
    yield "swapped"
    if drop:
        for batch, name in closed:
            _drop_batch(spark, table, name, batch)
        yield "old batches dropped"
    spark.catalog.refreshTable(table)


def _drop_batch(spark: SparkSession, table: str, run: str, batch: int) -> None:
    spark.sql(
        f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{RUN_COLUMN}` = '{run}', `{BATCH_COLUMN}` = {int(batch)})"
    )
    # An external table's partition leaves its files.
    delete_folder(spark, f"{table_location(spark, table)}/{RUN_COLUMN}={run}/{BATCH_COLUMN}={int(batch)}")


def compact_batches(
    spark: SparkSession, table: str, run: str, before: int, cluster_by: str | None = None, drop: bool = True
) -> None:
    """Make the batches of a run below ``before`` one partition, of a run with a name of its own.

    They must be closed: the run's query has gone on and runs none of them again. The
    partition is written while the table's snapshot hides it, then a new snapshot hides the
    old ones instead, in one step: a reader sees each row once at any time. With
    ``cluster_by`` rows of a bucketed table are brought together first. Without ``drop`` the old
    partitions stay for readers under way until the next compaction. One compaction of a
    table runs at a time; a second one fails and changes nothing.
    """
    for _ in compaction(spark, table, run, before, cluster_by, drop):
        pass
