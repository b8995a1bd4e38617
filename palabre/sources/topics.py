"""Topics of JSON records, on Kafka or on files, with one common envelope."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palabre.schemas import ENVELOPE

_FILE_SCHEMA = StructType([ENVELOPE["key"], ENVELOPE["value"], ENVELOPE["timestamp"]])


class Topics(Protocol):
    """A place that holds topics."""

    def stream(self, spark: SparkSession, topic: str, **options: str) -> DataFrame:
        """The unbounded table of the topic's records."""

    def read(self, spark: SparkSession, topic: str, **options: str) -> DataFrame:
        """The topic's records up to now."""

    def read_since(self, spark: SparkSession, topic: str, seconds: float) -> DataFrame:
        """The topic's records from a time (in seconds since 1970) on."""

    def publish(self, df: DataFrame, topic: str | None = None) -> None:
        """Append ``key, value`` rows to a topic, or to each row's own ``topic``."""


def _message(df: DataFrame, topic: str | None) -> DataFrame:
    target = F.col("topic") if topic is None else F.lit(topic)
    return df.select(F.col("key"), F.col("value"), target.alias("topic"))


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster.

    ``min_partitions`` splits the offset range of a busy topic partition over
    several tasks; it defaults to the session's parallelism. Other settings of
    the connector go into ``options`` (with their Kafka names).
    """

    bootstrap_servers: str
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def source_options(self, spark: SparkSession, topic: str, **options: str) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            "minPartitions": str(self.min_partitions or spark.sparkContext.defaultParallelism),
            **self.options,
            **options,
        }

    def stream(self, spark: SparkSession, topic: str, **options: str) -> DataFrame:
        settings = self.source_options(spark, topic, **options)
        return spark.readStream.format("kafka").options(**settings).load()

    def read(self, spark: SparkSession, topic: str, **options: str) -> DataFrame:
        settings = {**self.source_options(spark, topic), "startingOffsets": "earliest", **options}
        return spark.read.format("kafka").options(**settings).load()

    def read_since(self, spark: SparkSession, topic: str, seconds: float) -> DataFrame:
        return self.read(
            spark,
            topic,
            startingTimestamp=str(int(seconds * 1000)),
            startingOffsetsByTimestampStrategy="latest",
        )

    def sink_options(self) -> dict[str, str]:
        """The connector's settings for writing: all that are meant for Kafka itself."""
        own = {k: v for k, v in self.options.items() if k.startswith("kafka.")}
        return {"kafka.bootstrap.servers": self.bootstrap_servers, **own}

    def publish(self, df: DataFrame, topic: str | None = None) -> None:
        _message(df, topic).write.format("kafka").options(**self.sink_options()).save()


@dataclass(frozen=True)
class FileTopics:
    """Topics kept as Parquet files.

    Each publication has a folder of its own, so that several may run at once,
    and in it a folder per topic. A record's position is its file and its row in
    that file, so it stays the same on every read.
    """

    root: str

    def _columns(self, df: DataFrame, topic: str) -> DataFrame:
        file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        return df.select(
            "key",
            "value",
            F.lit(topic).alias("topic"),
            F.hash(file).alias("partition"),
            F.xxhash64(file, row).alias("offset"),
            "timestamp",
            F.lit(0).alias("timestampType"),
        )

    def _path(self, topic: str) -> str:
        return f"{self.root}/publication=*/topic={topic}"

    def stream(self, spark: SparkSession, topic: str, **options: str) -> DataFrame:
        reader = spark.readStream.schema(_FILE_SCHEMA).options(**options)
        return self._columns(reader.parquet(self._path(topic)), topic)

    def read(self, spark: SparkSession, topic: str, **options: str) -> DataFrame:
        reader = spark.read.schema(_FILE_SCHEMA).options(**options)
        return self._columns(reader.parquet(self._path(topic)), topic)

    def read_since(self, spark: SparkSession, topic: str, seconds: float) -> DataFrame:
        try:
            records = self.read(spark, topic)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], ENVELOPE)  # nothing was published there yet
        return records.filter(F.col("timestamp") >= F.timestamp_seconds(F.lit(seconds)))

    def publish(self, df: DataFrame, topic: str | None = None) -> None:
        (
            _message(df, topic)
            .select(
                F.col("key").cast("binary").alias("key"),
                F.col("value").cast("binary").alias("value"),
                F.current_timestamp().alias("timestamp"),
                "topic",
            )
            .write.partitionBy("topic")
            .parquet(f"{self.root}/publication={uuid.uuid4().hex}")
        )
