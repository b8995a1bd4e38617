"""Publishing a batch's records once, whatever step a run breaks off after."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.sources.manifests import Manifest, delete_folder
from palabre.sources.topics import Topics

#: How far the clocks of the driver and of the topics' machines may be apart.
CLOCK_SECONDS = 600


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """Equal messages once, with their number; texts and bytes are the same."""
    key, value = F.col("key").cast("string"), F.col("value").cast("string")
    topic = F.col("topic")
    return rows.groupBy(topic.alias("topic"), key.alias("key"), value.alias("value")).agg(
        F.count(F.lit(1)).alias(name)
    )


@dataclass(frozen=True)
class Outbox:
    """What a run of a query sends to topics, batch by batch.

    Before a batch's messages are sent they are fixed (stored, or made from what is stored) and
    the ledger notes that sending has begun; after it, that it is done. Batches that are
    done are not sent again. If a run breaks off in between, its next start compares the
    topic's records since then with the batch's messages and sends those that are missing.
    """

    spark: SparkSession
    topics: Topics
    path: str

    def _ledger(self, place: str) -> Manifest:
        return Manifest(self.spark, f"{self.path}/{place}/_ledger")

    def publish(
        self, batch_id: int, rows: Callable[[], DataFrame], topic: str | None = None, repeatable: bool = False
    ) -> None:
        """Send ``key, value`` rows (and ``topic``, without a topic) of a batch once.

        ``rows`` is asked for them once if they are to be stored. ``repeatable`` says that it
        gives the same rows whenever it is asked, because they come from a partition that
        is written already: then they are not stored.
        """
        place = topic or "several"
        ledger = self._ledger(place)
        version, last = ledger.read()
        if last and (last["batch"] > batch_id or (last["batch"] == batch_id and last["sent"])):
            return
        begun = bool(last) and last["batch"] == batch_id
        if repeatable:
            fixed = self._addressed(rows(), topic)
        else:
            stored = f"{self.path}/{place}/batch={batch_id}"
            if not begun:
                self._addressed(rows(), topic).write.mode("overwrite").parquet(stored)
                if last:
                    delete_folder(self.spark, f"{self.path}/{place}/batch={last['batch']}")
            fixed = self.spark.read.schema("topic string, key string, value string").parquet(stored)
        if begun:
            fixed = self._missing(fixed, last["since"])
        else:
            version = ledger.replace({"batch": batch_id, "sent": False, "since": time.time()}, version)
        self.topics.publish(fixed)
        ledger.replace({"batch": batch_id, "sent": True}, version)

    @staticmethod
    def _addressed(rows: DataFrame, topic: str | None) -> DataFrame:
        target = F.col("topic") if topic is None else F.lit(topic)
        return rows.select(
            target.alias("topic"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
        )

    def _missing(self, fixed: DataFrame, since: float) -> DataFrame:
        """The messages that are not on their topics yet, as often as they lack."""
        wanted = _counted(fixed, "wanted")
        names = [r[0] for r in fixed.select("topic").distinct().collect()]  # the topics of one query
        sent = None
        for name in names:
            one = _counted(self.topics.read_since(self.spark, name, since - CLOCK_SECONDS), "sent")
            sent = one if sent is None else sent.unionByName(one)
        if sent is None:
            return fixed
        there = sent.select(
            F.col("topic").alias("t"), F.col("key").alias("k"), F.col("value").alias("v"), "sent"
        )
        same = (F.col("topic") == F.col("t")) & F.col("key").eqNullSafe(F.col("k")) & F.col("value").eqNullSafe(F.col("v"))
        lacking = F.col("wanted") - F.coalesce("sent", F.lit(0))
        left = wanted.join(there, same, "left").withColumn("lacking", lacking).filter("lacking > 0")
        return left.select(
            "topic", "key", "value", F.explode(F.sequence(F.lit(1).cast("long"), "lacking")).alias("copy")
        ).drop("copy")
