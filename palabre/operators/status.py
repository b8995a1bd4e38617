"""The moderation status of messages, kept up to date bucket by bucket."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.schemas import DEFAULT_VERDICT, MESSAGE
from palabre.sources.manifests import Manifest, delete_folder

_MESSAGE = ["id", *MESSAGE.names]
#: A row for each different message with its number and its verdicts, counted by value; and one with
#: ``n`` 0 for verdicts whose message hasn't come yet.
_FIELDS = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in MESSAGE.fields)
KEPT = f"id string, {_FIELDS}, n long, verdicts map<string,bigint>"
#: Kept rows, messages and verdicts that are merged in a task.
TASK_ROWS = 200_000


def _counted_verdicts(verdicts: DataFrame) -> DataFrame:
    """``id, valide, k``, counted on the map side."""
    value = F.coalesce(F.col("valide").cast("string"), F.lit(DEFAULT_VERDICT)).alias("valide")
    named = verdicts.filter(F.col("id_message").isNotNull())
    return named.groupBy(F.col("id_message").alias("id"), value).agg(F.count(F.lit(1)).alias("k"))


def _dealt(rows: DataFrame, tasks: int | None, *columns: str) -> DataFrame:
    return rows.repartition(tasks, *columns) if tasks else rows.repartition(*columns)


def merge_status(old: DataFrame, messages: DataFrame, verdicts: DataFrame, tasks: int | None = None) -> DataFrame:
    """Kept rows with further messages and verdicts, in any order of their arrival.

    Numbers are sums, so what is merged first makes no difference. Messages and verdicts are
    counted on the map side, then dealt by id, so all further steps are within ``tasks`` tasks (by
    default as many as adaptive execution finds); their rows decide on a task's memory.
    """
    new = messages.select(*_MESSAGE).groupBy(*_MESSAGE).agg(F.count(F.lit(1)).alias("n"))
    all_messages = old.filter("n > 0").select(*_MESSAGE, "n").unionByName(new)
    named = _dealt(all_messages.filter(F.col("id").isNotNull()), tasks, "id")
    named = named.groupBy(*_MESSAGE).agg(F.sum("n").alias("n"))
    # Nothing is known of messages without an id: their content spreads them.
    nameless = _dealt(all_messages.filter(F.col("id").isNull()), tasks, *MESSAGE.names)
    nameless = nameless.groupBy(*_MESSAGE).agg(F.sum("n").alias("n"))
    # All rows of an id have the same verdicts: the largest number is that of each.
    none = F.lit(None).cast("long")
    before = old.filter(F.col("id").isNotNull()).select("id", F.explode("verdicts").alias("valide", "before"))
    counts = before.withColumn("k", none).unionByName(_counted_verdicts(verdicts).withColumn("before", none))
    zero = F.lit(0).cast("long")
    by_value = _dealt(counts, tasks, "id").groupBy("id", "valide").agg(
        (F.coalesce(F.max("before"), zero) + F.coalesce(F.sum("k"), zero)).alias("k")
    )
    # As many entries as there are different verdicts.
    by_id = by_value.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("valide", "k"))).alias("verdicts")
    )
    nothing = F.create_map().cast("map<string,bigint>")
    judged = named.join(by_id, "id", "full").select(
        *_MESSAGE, F.coalesce("n", zero).alias("n"), F.coalesce("verdicts", nothing).alias("verdicts")
    )
    return judged.unionByName(nameless.withColumn("verdicts", nothing))


def kept_status_counts(kept: DataFrame) -> DataFrame:
    """Every message and verdict, equal ones counted in ``copies``; a message without any has ``'false'``."""
    one = F.create_map(F.lit(DEFAULT_VERDICT), F.lit(1).cast("long"))
    shown = F.when(F.size("verdicts") > 0, F.col("verdicts")).otherwise(one)
    exploded = kept.filter("n > 0").select(
        F.col("id").alias("message_id"), *MESSAGE.names, "n", F.explode(shown).alias("valide", "k")
    )
    return exploded.select("message_id", *MESSAGE.names, "valide", (F.col("n") * F.col("k")).alias("copies"))


@dataclass(frozen=True)
class KeptStatus:
    """Messages with their verdicts in a folder, in ``buckets`` by the message's id.

    A batch of messages and verdicts rewrites the buckets that it has rows for, as a new
    version; a manifest says which version of each bucket is valid and which batch of each
    run was merged last, and is replaced in one step. So a batch that is run again is merged
    once, a reader sees whole batches only, and what was replaced stays for readers under
    way until the next batch. One job at a time may merge. ``buckets`` is chosen for the
    size that the messages will reach and stays.
    """

    spark: SparkSession
    location: str
    buckets: int = 64

    @property
    def _manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.location}/_current")

    def _bucket(self, id_: Column) -> Column:
        # Messages without an id need no partner: their content spreads them.
        spread = F.coalesce(id_, F.concat_ws(":", *[F.col(c).cast("string") for c in MESSAGE.names]))
        return F.pmod(F.xxhash64(spread), F.lit(self.buckets)).cast("int")

    def _rows(self, valid: dict[str, int], only: list[int] | None = None) -> DataFrame:
        wanted = valid if only is None else {b: valid[b] for b in map(str, only) if b in valid}
        paths = [f"{self.location}/version={v}/bucket={b}" for b, v in wanted.items()]
        if not paths:
            return self.spark.createDataFrame([], KEPT)
        return self.spark.read.schema(KEPT).parquet(*paths)

    def read(self) -> DataFrame:
        """All kept rows; see ``kept_status_counts``."""
        return self._rows(self._manifest.read()[1].get("valid", {}))

    def exists(self) -> bool:
        return self._manifest.read()[0] > 0

    def merge(self, messages: DataFrame, verdicts: DataFrame, run: str = "main", batch_id: int | None = None) -> list[int]:
        """Merge a batch and return the buckets that were written; none if it was merged before.

        ``messages`` has the id and the message's columns, ``verdicts`` ``id_message`` and
        ``valide``. Both are read twice.
        """
        version, state = self._manifest.read()
        state = state or {"buckets": self.buckets, "valid": {}, "merged": {}, "replaced": []}
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.location} has {state['buckets']} buckets, not {self.buckets}")
        if batch_id is not None and state["merged"].get(run, -1) >= batch_id:
            return []
        touched = (
            messages.select(self._bucket(F.col("id")).alias("bucket"))
            .unionByName(
                verdicts.filter(F.col("id_message").isNotNull()).select(
                    F.pmod(F.xxhash64("id_message"), F.lit(self.buckets)).cast("int").alias("bucket")
                )
            )
            .groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("rows"))
            .collect()  # at most one row for each bucket
        )
        buckets = sorted(r["bucket"] for r in touched)
        replaced = [[b, state["valid"][str(b)]] for b in buckets if str(b) in state["valid"]]
        if buckets:
            kept = self._rows(state["valid"], buckets)
            tasks = -(-(kept.count() + sum(r["rows"] for r in touched)) // TASK_ROWS)
            merged = merge_status(kept, messages, verdicts, tasks)
            placed = merged.withColumn("bucket", self._bucket(F.col("id"))).hint("rebalance", F.col("bucket"))
            placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.location}/version={version + 1}")
        valid = {**state["valid"], **{str(b): version + 1 for b in buckets}}
        merged_batches = state["merged"] if batch_id is None else {**state["merged"], run: batch_id}
        self._manifest.replace({**state, "valid": valid, "merged": merged_batches, "replaced": replaced}, version)
        for bucket, old in state["replaced"]:
            delete_folder(self.spark, f"{self.location}/version={old}/bucket={bucket}")
        return buckets
